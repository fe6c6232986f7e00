"""Operators for preparing training text at scale.

Each module holds one operator with a general interface; ``queries`` binds
them to the test tables. Nothing outside this folder imports it.

Functions that run in tasks are sent by value, so executors need no copy of
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
