"""Operators of a training-data pipeline: text, tokens and vectors.

Functions of this package travel to the executors by value, so that these need
only the public libraries, not the package itself.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
