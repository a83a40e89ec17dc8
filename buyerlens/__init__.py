"""User portraits and comment moderation as Spark DataFrame transformations."""

import sys

from pyspark import cloudpickle

# Python workers get the few functions they run by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
