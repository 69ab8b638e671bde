"""Column expressions: everything here is a plain Spark ``Column``, no Python on the workers."""
