"""Operators of a training-data pipeline: search, language, dedup, secrets, toxicity, mixing, tokens.

Functions of this package that run in tasks travel by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
