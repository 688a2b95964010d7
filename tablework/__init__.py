"""tablework: timetable and delay analytics as Spark DataFrame operators.

Every public operator takes DataFrames (and plain parameters) and returns a
DataFrame.  Nothing here collects rows to the driver except a few bounded
scalars (quantile search bins, ML metadata) that are documented where used.
"""

from tablework.session import build_session, shared_scratch

__all__ = ["build_session", "shared_scratch"]
