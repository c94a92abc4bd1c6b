"""Map-document analytics as composable Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Executors needn't have this package installed: its functions travel to them whole.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
