"""Continuous ingest: the batch operators on files as they arrive, and a keyed state that survives restarts."""

from .ingest import latest, latest_by_key, running_counts, windowed_counts  # noqa: F401
