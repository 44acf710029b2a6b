"""Training-data operators: near-duplicates, filters, mixing, sharding and scans as Spark jobs.

Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it. Every
operator selects the columns it needs under internal names first, so extra
input columns, also with clashing names, are never touched.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job; executors need no installed package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
