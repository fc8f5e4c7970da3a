"""Operators for preparing training data: language, secrets, near-duplicates,
subword ids, URL rules, packing, quality, vector search, licences, toxicity.

Nothing outside this package imports it; its queries are in ``queries.py``.
"""

import sys

from pyspark import cloudpickle

# Task code is shipped by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
