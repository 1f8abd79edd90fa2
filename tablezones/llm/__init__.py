"""Operators for preparing training text. Nothing else in the library imports this."""

import sys

from pyspark import cloudpickle

# Worker-side code ships by value, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
