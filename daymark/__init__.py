"""daymark — daily commerce metrics as Spark DataFrame jobs.

Raw order / event / user files are read with declared schemas, the six
daily metric tables are plain DataFrame functions, data-quality rules are
declarative and evaluated on executors, and sinks write partitioned files
with dynamic overwrite or refresh warehouse tables.
"""

from daymark.session import build_session, shared_dir

__all__ = ["build_session", "shared_dir"]
