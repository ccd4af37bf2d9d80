"""Composed queries. Importing this package registers every query."""

from panelkit.plans import registry  # noqa: F401
from panelkit.plans import (  # noqa: F401
    q_panel,
    q_weekly,
    q_windows,
    q_basic,
    q_aggs,
    q_scalar,
    q_enrich,
    q_model,
    q_fair,
    q_stream,
    q_scans,
    q_boost,
    q_given,
)
from panelkit.plans.registry import ORACLES, QUERIES  # noqa: F401
