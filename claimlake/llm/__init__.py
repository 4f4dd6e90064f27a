"""Operators for large-scale training-data preparation; nothing else in the library imports this.

Python functions that run in tasks are sent to the executors by value, so a cluster needs this
package on the driver only.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
