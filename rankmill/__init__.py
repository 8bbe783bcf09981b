"""rankmill — Spark-native analytics for grouped search-ranking logs.

Every operator is a plain ``DataFrame -> DataFrame`` function built from
Spark SQL expressions, so a plan stays inside Catalyst and runs the same on
``local[*]`` and on a cluster.
"""

from rankmill.session import checkpoint_dir, get_spark

__all__ = ["get_spark", "checkpoint_dir"]
