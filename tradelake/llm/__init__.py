"""Training-data pipeline operators.

Nothing outside this package imports it.  Functions that run in tasks are
pickled by value, so workers need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
