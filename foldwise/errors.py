"""Errors raised by the package."""


class ConfigError(ValueError):
    """The declarative feature or run configuration is invalid."""


class DataError(ValueError):
    """The input table breaks a rule the configuration relies on."""


class StoreError(RuntimeError):
    """A saved model cannot be written or read."""
