"""Operators for preparing language-model training text.

Nothing outside this package (and ``corpus_pipeline.py``) imports it. Functions that run inside tasks are
pickled by value, so executors need the public libraries but no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
