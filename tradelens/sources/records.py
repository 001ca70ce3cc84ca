"""In-memory records -> DataFrame with an explicit schema.

The schema is required, so an empty list still yields the full column list
(the reference returns an empty frame for ``[]``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def records_to_dataframe(spark: SparkSession, records: list[dict], schema: StructType | str) -> DataFrame:
    """For small driver-side inputs only (configs, fixtures); data at scale
    is read with ``spark.read``."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    rows = [tuple(r.get(f.name) for f in schema.fields) for r in records]
    return spark.createDataFrame(rows, schema)
