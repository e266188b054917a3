"""Training-data operators: mixing, filters, classifiers, near-duplicates, token output."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the query, so no executor needs the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
