"""Errors a user can act on."""


class ConfigError(ValueError):
    """Configuration that must be repaired before anything is trained or written."""


class TrainingError(RuntimeError):
    """A geo could not be fitted."""


class QualityError(ValueError):
    """The data of a month can't be used."""
