"""Payment-event analytics on Spark."""

import sys

from pyspark import cloudpickle

# Executors needn't have this package installed: functions sent to Python workers carry what they use of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
