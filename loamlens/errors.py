"""Typed failures, raised instead of continuing with an empty frame."""


class LoamlensError(Exception):
    """Base class of the errors raised by this package."""


class EmptyInputError(LoamlensError):
    """A required input has no rows."""


class AllMissingError(LoamlensError):
    """A statistic cannot be fitted because its column has no value at all."""


class TooFewGroupsError(LoamlensError):
    """Fewer groups than folds."""


class GroupLeakError(LoamlensError):
    """A group appears on both sides of a split."""
