"""eventide — a Spark-native engine for user-event quality, windowed activity
counts, enrichment and anomaly detection.

Every transform is ``DataFrame -> DataFrame`` and runs unchanged on batch and
streaming input, so each one can be checked against plain SQL.
"""

from eventide.config import EngineConfig

__all__ = ["EngineConfig"]
__version__ = "0.1.0"
