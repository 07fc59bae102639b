"""Operators of a training-data pipeline; nothing else in the package imports them."""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel with the job, as do the objects they use (see ``common.Shipped``), so
# executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
