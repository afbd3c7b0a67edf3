"""Instruction-tuning data preparation, scoring and telemetry as Spark DataFrame jobs."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Ship functions to executors by value, so they need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
