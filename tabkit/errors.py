"""Typed errors, so that callers can tell bad input from bad data."""


class TabkitError(Exception):
    """Base of every error raised on purpose by this package."""


class DatasetError(TabkitError):
    """The input table cannot be used."""


class InvalidCSVError(DatasetError):
    """The input could not be parsed, or has no columns."""


class EmptyDatasetError(DatasetError):
    """The input has no rows (or a filter chain left none)."""


class DatasetTooLargeError(DatasetError):
    """The input has more rows or bytes than the caller allowed."""


class OperatorError(TabkitError):
    """An operator could not produce a result."""


class InvalidArgumentsError(OperatorError):
    """An operator was called with arguments it cannot use."""


class SQLValidationError(OperatorError):
    """A SQL text is not a single read-only query over the dataset view."""


class ModelTrainingError(OperatorError):
    """No model could be fitted on this data."""


class InsufficientDataError(OperatorError):
    """There are too few usable rows or columns."""
