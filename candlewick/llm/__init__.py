"""Operators of a training-data pipeline: archives, tokens, mixing, shards, scans and near duplicates.

Nothing outside this package imports it, so it can be left out of an installation.
"""

import sys

from pyspark import cloudpickle

# Tasks carry the functions they call, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
