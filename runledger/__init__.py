"""runledger: PySpark operators for workflow telemetry, configuration and documents.

Every operator takes and returns DataFrames (or Columns); planning and execution stay
with Catalyst, Tungsten and AQE.
"""

from runledger.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
