"""Operators for preparing training data, and their queries.

Functions of this package travel to the executors with their tasks, so the
package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
