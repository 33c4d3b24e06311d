"""Training-data operators: scoring, extraction, packing, archives, near-duplicates, mixing.

Nothing else in the library imports this subpackage.  Functions that run on executors are pickled by value, so
a cluster needs the libraries they import but no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
