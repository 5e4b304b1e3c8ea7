"""Operators for preparing training data, their queries, and the SQL of those that SQL can express.

Nothing else in the library imports this folder. Each module is one operator with a general
interface; `queries` derives the registered queries from them.
"""

import sys

from pyspark import cloudpickle

# The code of Python tasks travels with them, so executors need not have this folder installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
