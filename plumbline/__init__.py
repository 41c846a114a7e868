"""Quality audit, profiling and modelling of wide sensor-test tables on Spark.

Every public function takes DataFrames and column names and returns a DataFrame, a Column or a
fitted model. Rows stay on the executors; the driver only sees results whose size depends on the
number of columns, folds, thresholds or candidate models.
"""
import sys

from pyspark import cloudpickle

from plumbline.roles import Roles

# functions that run inside tasks travel with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Roles"]
