"""Errors raised on the driver."""


class DataValidationError(ValueError):
    """A table failed its validation rules."""


class DriftDataError(ValueError):
    """Two tables cannot be compared for drift."""


class MissingTargetError(KeyError):
    """The target column is absent."""


class ScoringError(RuntimeError):
    """A model does not give a usable probability of class 1."""
