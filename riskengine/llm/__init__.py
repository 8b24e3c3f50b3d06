"""Operators for training-data pipelines: near-dedup, filters, scoring, mixing, archives, search.

Nothing else in the library imports this package.  Its task-side functions are pickled by
value, so executors need numpy, pyarrow and xxhash but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
