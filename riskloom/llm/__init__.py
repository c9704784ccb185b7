"""Operations of a training-data pipeline: one module per operator, each a Spark job over whole tables."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with the job, which then need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
