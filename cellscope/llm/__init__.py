"""Operators for preparing large text corpora; nothing else in the library imports this folder."""

import sys

from pyspark import cloudpickle

# functions of this folder travel to the executors whole: these need not have the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])
