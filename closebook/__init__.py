"""Closebook: month-end management-control analytics on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark's built-in operators (joins, aggregations, windows). Nothing in the
library collects data to the driver.
"""

from closebook.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
