"""Registered queries, the views they read, and composite verbs."""

from . import artifact_queries, clinical_queries, io_queries, release_queries, run_queries  # noqa: F401  (they register their queries)
from .queries import QUERIES, SQL  # noqa: F401
