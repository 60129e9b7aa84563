"""quantbeam: a Spark-native market-data analytics engine.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
``pyspark.sql.functions``; Catalyst and AQE choose the physical plan.
"""

from quantbeam.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
