"""Training-data operators: scoring, encoding, sharding, packing, joins, dedup and archives.

Nothing else in the library imports this subpackage; ``queries.py`` holds the
registered queries and their SQL.
"""

import sys

from pyspark import cloudpickle

# Task functions travel by value: executors need numpy and Arrow, not this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
