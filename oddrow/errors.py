"""Error classes of the engine; everything raised on purpose derives from one base."""


class AnomalyError(Exception):
    """Base class."""


class DataLoadError(AnomalyError):
    """The input cannot be read, is empty, or holds too few usable rows."""


class SchemaValidationError(AnomalyError):
    """Required columns are missing or hold values of the wrong kind."""


class ConfigurationError(AnomalyError):
    """A job parameter is missing or out of range."""


class InferenceError(AnomalyError):
    """Scoring was asked for in a state that cannot score."""


class ArtifactLoadError(AnomalyError):
    """A stored artefact exists but cannot be understood."""


class ArtifactNotFoundError(AnomalyError):
    """A stored artefact is absent."""


class ArtifactWriteError(AnomalyError):
    """An artefact cannot be written to its destination."""
