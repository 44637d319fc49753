"""Training-data operators over documents, pages and embeddings.

Every operator takes DataFrames, selects only the columns it needs (so extra
or clashing columns never reach it) and returns a DataFrame.  The functions
that run inside Python tasks are shipped with the task (pickled by value), so
executors need no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
