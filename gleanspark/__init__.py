"""gleanspark: collect, classify, deduplicate and triage announced items on Spark.

Every operator is a function from Column to Column or from DataFrame to
DataFrame; none of them holds a session of its own.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
