"""One error class per layer."""

from __future__ import annotations


class EngineError(Exception):
    """Base of all errors this engine raises on purpose."""


class SettingsError(EngineError):
    pass


class RegistryError(EngineError):
    pass


class LandingError(EngineError):
    pass


class IntegrityError(LandingError):
    """Bytes that don't match what was promised; worth one retry."""


class CleaningError(EngineError):
    pass


class AssemblyError(EngineError):
    pass


class PolicyError(EngineError):
    pass


class PublishError(EngineError):
    pass


class QualityError(EngineError):
    """A report with failures; the message joins them."""

    def __init__(self, report) -> None:
        self.report = report
        super().__init__("; ".join(f"{i.check}: {i.message}" for i in report.issues))
