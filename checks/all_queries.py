"""Every registered query, by name."""

from checks import q_ledger, q_profile, q_models, q_planning, q_risk, q_jobs  # noqa: F401
from checks.registry import QUERIES  # noqa: F401
