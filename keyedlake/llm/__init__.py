"""Training-data operators: ten text operators and the corpus pipeline built from them.

Nothing else in the library imports this subpackage.  Functions that run inside
tasks are pickled by value, so executors need the Python dependencies but no
installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
