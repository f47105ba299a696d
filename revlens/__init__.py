"""revlens — review and text analytics as Spark DataFrame operators.

Every public operator takes and returns a ``pyspark.sql.DataFrame`` (or a
``Column`` for scalar functions) and is built from Spark SQL expressions,
joins, aggregations and windows, so Catalyst plans it and the work is
distributed.  Rule lists and thresholds are parameters; the defaults in
``revlens.params`` are the values used for Korean review data.
"""

__version__ = "0.1.0"
