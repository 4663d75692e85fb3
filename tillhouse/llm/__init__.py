"""Operators of a training-data pipeline: one module per operator, queries in ``queries``.

Nothing outside this package and ``corpus_pipeline.py`` imports it.  Functions
that run in tasks travel by value, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
