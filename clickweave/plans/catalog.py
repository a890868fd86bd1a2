"""Imports every query module so that the registry is complete."""

from clickweave.plans import (  # noqa: F401
    q_clean, q_clusters, q_extra, q_fitted, q_io, q_labels, q_models, q_online, q_sessions, q_windows,
)
from clickweave.plans.registry import REGISTRY

__all__ = ["REGISTRY"]
