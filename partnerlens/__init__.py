"""Spark-native partner and sales-pipeline analytics.

The package lands CRM objects as typed tables, attributes contacts and deals
to partners, and builds the partner marts, report queries, forecast, merges,
checks and publish diffs as Spark DataFrame plans.
"""

from partnerlens.config import EngineConfig
from partnerlens.session import get_session, prepare_session

__all__ = ["EngineConfig", "get_session", "prepare_session"]
