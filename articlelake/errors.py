"""Errors raised when data breaks a stage contract."""


class IntegrityError(AssertionError):
    """A guard found violations; nothing was published."""
