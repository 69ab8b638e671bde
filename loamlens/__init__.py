"""loamlens: observational tables in, leakage-safe regression data and diagnostics out, on Spark."""
