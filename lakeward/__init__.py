"""Health-data tables on Spark: conform, consolidate, merge revisions, rebuild
months, detect change, enrich and catalogue, all as DataFrame operators.

Every function takes and returns DataFrames or Columns unless its docstring
says that it writes.
"""

import sys

from pyspark import cloudpickle

# The few functions that run inside Python tasks travel with the task, so the
# package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
