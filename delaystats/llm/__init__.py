"""Operators of a training-data pipeline over text, pages and conversations.

Nothing outside this subpackage imports it.  Functions that run in Python
workers are pickled by value, so that workers need not import the package.
"""

import pyspark.cloudpickle as _cloudpickle

import delaystats as _package

_cloudpickle.register_pickle_by_value(_package)
