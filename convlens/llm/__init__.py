"""Operators for building language-model training data. Nothing else in the library imports this package."""

import sys

from pyspark import cloudpickle

# functions of this package travel to the workers with the job: nothing has to be installed on the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])
