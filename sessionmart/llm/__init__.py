"""Operators for preparing training data: de-duplication, filters, formatting, packing, sharding.

Each module holds one operator with a general interface; ``registry`` lists the
queries. Task code of this package travels with the functions (pickled by
value), so executors need no copy of the repository on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
