"""Named queries over the driver's tables (render-then-extract where needed)."""

from rulelake.plans import (  # noqa: F401
    q_groups,
    q_identity,
    q_latest,
    q_profile,
    q_projects,
    q_pseudonym,
    q_references,
    q_resume,
    q_rules,
    q_sources,
    q_streams,
)
from rulelake.plans.registry import all_queries, all_sql

FLAGSHIP = "rule_groups"

__all__ = ["FLAGSHIP", "all_queries", "all_sql"]
