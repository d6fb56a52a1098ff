"""Gristmill: data preparation, retrieval evaluation and tabular model
selection as Spark jobs.

Every operator takes and returns DataFrames.  Work that touches table rows is
done by Spark; the driver only sees configuration and bounded summaries.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to Python workers as code, so workers need
# neither an installed copy nor the driver's working directory.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
