"""Training-data operators: thirteen corpus operators and their registered queries.

Nothing else in the package imports this folder; ``queries.py`` holds the
registered queries. ``wordhash.py`` is the shared numpy helper for word and
n-gram hashes over Arrow string buffers.

Task functions of this folder travel to the executors by value, so a cluster
needs no copy of the package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
