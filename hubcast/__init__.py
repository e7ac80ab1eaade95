"""Forecast-hub analytics on Spark: criteria, ensembles, scoring, pairwise summaries."""

from .config import HubConfig
from .session import build_session

__all__ = ["HubConfig", "build_session"]
