"""Polar raster analytics as Spark DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the task, so executors need no copy of the
# package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from floegrid.session import configure, get_session  # noqa: E402

__all__ = ["configure", "get_session"]
