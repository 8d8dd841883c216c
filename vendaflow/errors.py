"""Failures a load or a source can raise."""


class SalesError(Exception):
    """Base of every failure raised by this package."""


class SourceError(SalesError):
    """The source cannot be found or lacks what the load needs."""


class LoadError(SalesError):
    """The data breaks a rule of the warehouse; nothing was published."""


class Overtaken(LoadError):
    """Another load was published, or is being published, in the place meant for this one."""
