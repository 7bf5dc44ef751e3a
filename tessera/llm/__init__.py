"""Operators for preparing training text (one module each) and their queries.

Functions that run in tasks travel with their code: executors need not have
this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
