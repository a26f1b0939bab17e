"""Registered queries over the test tables and the statements that check them."""

from . import boosting_queries, dataset_queries, diagnose_queries, feature_queries, model_queries, report_queries  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
