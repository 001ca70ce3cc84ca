"""tradelens — periodic trade statistics as Spark DataFrame jobs.

Every operator takes and returns a ``pyspark.sql.DataFrame`` and carries a
list of *series* key columns, so thousands of trade series (strategy, item,
source file, customer, ...) are processed in one distributed job.

Sub-packages:

- ``functions``  pure Column expressions (period parsing, rates, rounding)
- ``operators``  DataFrame -> DataFrame operators (aggregation, windows,
                 calendar, dashboard, validation, selection, page extraction)
- ``sources``    report-export readers, strategy configs, fact builders, sinks
- ``plans``      user verbs (report, dashboard, full) and contract queries
- ``streaming``  incremental runner of the batch verbs over arriving files
"""

from tradelens.session import get_spark

__all__ = ["get_spark"]
