"""Stream and table analytics written as Spark DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

from tidemark.session import build_session, configure

# functions that run in Python workers travel with the job, so executors need no copy of the package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["build_session", "configure"]
