"""loadlens — server-load and access-log analytics on Spark DataFrames.

Every operator takes and returns a :class:`pyspark.sql.DataFrame`; the heavy
work runs on executors as Catalyst plans.  See ``README.md`` for the map of
operators and ``loadlens.plans.registry`` for the named queries.
"""

from loadlens.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
