"""Operators of a training-data pipeline, one module each, with their queries in ``queries``.

Nothing else in the library imports this subpackage.
"""

import sys

from pyspark import cloudpickle

# Functions of this subpackage travel to the executors with the job, so a
# cluster needs the package on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
