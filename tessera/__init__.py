"""tessera: reusable Spark DataFrame operators for analytics jobs.

Every operator takes Spark DataFrames and returns a DataFrame (or a fitted
object exposing ``transform``).  Work is expressed with built-in column
functions, Spark SQL and ``pyspark.ml`` so Catalyst plans it; Python runs
inside tasks only where a per-group numeric routine is unavoidable.
"""

from tessera.session import get_session, ensure_checkpoint_dir

__all__ = ["get_session", "ensure_checkpoint_dir"]
