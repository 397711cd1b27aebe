"""Operators for preparing training data. Nothing else in the package imports this one.

Functions of this subpackage travel to the executors with the tasks that call them, so executors need
Python with numpy and pyarrow but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
