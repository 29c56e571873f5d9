"""Operators for preparing training text at scale.

One module per operator.  Each operator takes a DataFrame and column names,
reads only those columns (extra columns, whatever their names, are ignored)
and defines its result for NULL, empty and very long texts, ties, repeated
rows and empty tables in its docstring.  Nothing else in the library imports
this subpackage.
"""

import sys

from pyspark import cloudpickle

# Executors need not have this package installed: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
