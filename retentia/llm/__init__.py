"""Training-data operators over ``documents``: language, duplicates, mixing, quality, personal data, packing.

Task code is shipped to the executors by value, so they need not have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
