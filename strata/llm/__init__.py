"""Training-data operators: search, token files, packing, filters, PII, HTML, joins.

The subpackage stands alone: nothing else in the library imports it. Its
functions run inside Python tasks, so the package is pickled by value and
executors need no copy of it.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
