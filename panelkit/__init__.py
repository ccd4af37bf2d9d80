"""panelkit: panel and time-series feature engineering as Spark DataFrame jobs.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions. Sub-packages:

* ``sources``   -- CSV/Parquet readers and writers, the
                   mapping of the driver tables onto panel roles
* ``functions`` -- column-level helpers (calendar, strings, math)
* ``operators`` -- grid, window, aggregate, join, reshape, cleaning,
                   split, evaluation, model, fairness and matching operators
* ``plans``     -- composed queries, each registered with a DuckDB oracle
* ``streaming`` -- the weekly fact as a Structured Streaming job

Functions that run on executors are shipped by value: a worker needs the
third-party libraries only, not this package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
