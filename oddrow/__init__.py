"""oddrow: unsupervised anomaly detection on tables, as Spark jobs."""

from oddrow.errors import (
    AnomalyError,
    ArtifactLoadError,
    ArtifactNotFoundError,
    ArtifactWriteError,
    ConfigurationError,
    DataLoadError,
    InferenceError,
    SchemaValidationError,
)
from oddrow.params import JobParams, load_params
from oddrow.profiles import Profile, get_profile, register_profile

__all__ = [
    "AnomalyError",
    "ArtifactLoadError",
    "ArtifactNotFoundError",
    "ArtifactWriteError",
    "ConfigurationError",
    "DataLoadError",
    "InferenceError",
    "JobParams",
    "Profile",
    "SchemaValidationError",
    "get_profile",
    "load_params",
    "register_profile",
]
