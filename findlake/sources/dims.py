"""Small tables that come from the job's configuration, never from data."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema


def dimension(spark: SparkSession, rows: Sequence[tuple], ddl: str) -> DataFrame:
    """A local relation: the planner knows its exact size and broadcasts it only if it is small."""
    schema = T.StructType.fromDDL(ddl)
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    arrow = to_arrow_schema(schema)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow), schema)
