"""tabspark: Spark-native data contracts, cleaning, splitting, features,
training, evaluation, gating, run ledgers and request telemetry.

Every public operator takes and returns DataFrames; the driver only sees
schemas, a handful of counts and small vocabularies.
"""

from tabspark.session import checkpoint_dir, get_session

__all__ = ["get_session", "checkpoint_dir"]
