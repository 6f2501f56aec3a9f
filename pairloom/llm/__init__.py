"""Operators for preparing language-model training data.

Functions that run in Python workers travel with the job, so executors need the libraries
they use but not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
