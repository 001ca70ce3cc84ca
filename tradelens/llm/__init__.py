"""Operators of a large-scale training-data pipeline.

Nothing else in the library imports this subpackage.  Functions that run in
Spark's Python workers are pickled by value, so executors need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
