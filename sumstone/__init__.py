"""Analytics building blocks for Apache Spark.

Every public function takes DataFrames (or paths) and returns a DataFrame; Catalyst does the
planning.  See ``README.md`` for the map from task to function.
"""

from sumstone.session import build_session, scratch_path

__all__ = ["build_session", "scratch_path"]
