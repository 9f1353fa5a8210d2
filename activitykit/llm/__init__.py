"""Operators of a training-data pipeline: cleaning, near-duplicates, scoring, mixing, packing.

The functions that run inside tasks are sent along with the job, so executors need no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
