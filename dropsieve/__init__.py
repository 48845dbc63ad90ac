"""Quality control of single-cell count data as Spark DataFrame operators.

Every operator takes DataFrames and parameters and returns a DataFrame. All of
them work on many samples at once; the cell key is ``(sample_id, barcode)``.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with their code, so the package
# need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
