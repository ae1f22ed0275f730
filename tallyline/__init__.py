"""tallyline: text, graph, star-schema and classifier analytics as Spark jobs.

Every operator is a function from DataFrames to a DataFrame.  Nothing here
holds a session, prints, or collects rows; loops materialise their state in
the cluster's shared checkpoint folder.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

from . import functions, operators, plans, sources

# Functions that run in Python workers travel with the job: an executor needs no copy of this package.
register_pickle_by_value(sys.modules[__name__])

__all__ = ["functions", "operators", "plans", "sources"]
