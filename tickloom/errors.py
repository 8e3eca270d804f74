"""Errors raised by the library."""


class ConfigError(ValueError):
    """A job parameter is out of range."""


class SchemaError(ValueError):
    """An input table lacks required columns or repeats a name."""


class QualityError(ValueError):
    """The fail policy met rows it must not pass."""


class OutputError(ValueError):
    """A written table does not reconcile with its source."""
