"""Operators for large-scale training-data preparation.

Nothing else in the library imports this subpackage.  Functions that run in
Python workers are pickled by value, so a cluster needs no copy of the
package on its executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
