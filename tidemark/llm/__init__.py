"""Operators for building training corpora, and the queries that apply them.

Nothing outside this folder, ``tests/llm`` and ``corpus_pipeline.py`` imports from here.
Functions of this folder travel to the executors by value, so the package need not be
installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
