"""Cohort abundance analytics as Spark DataFrame operators.

Every operator takes and returns DataFrames in one sparse long model,
``(sample_name, feature, value)``, in which an absent row means zero.
"""

__version__ = "0.1.0"

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Executors need no installed copy: functions of this package travel by value.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
