"""All registered queries (importing the modules registers them)."""

from aerocast.plans import q_features, q_model, q_quality, q_reports, q_store  # noqa: F401
from aerocast.plans.registry import ORACLES, QUERIES  # noqa: F401
