"""Training-data operators for very large corpora.

One module per operator, ``queries`` with the thin contract queries, and the
helpers ``common`` (materialised intermediates) and ``words`` (vectorised
tokenising and hashing). Nothing else in the library imports this package.

Functions that run inside Python workers are shipped by value, so executors
need no installed copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
