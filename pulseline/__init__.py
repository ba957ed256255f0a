"""pulseline: sensor-record analytics on Spark DataFrames and Structured Streaming.

Lines of delimited device records are filtered, parsed into typed trial
records, keyed by trial/patient/visit and summarised (running and final
count, sum, min, max, average).  Text streams get seeded cumulative word
counts, and competing sources for one target can be reconciled by rule.
"""

from pulseline.config import SensorConfig
from pulseline.session import checkpoint_root, get_session

__all__ = ["SensorConfig", "checkpoint_root", "get_session"]
