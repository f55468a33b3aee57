"""Tables laid out in buckets of a key, so that joins on it, and aggregates on
it and anything more, need no shuffle.

Spark knows a layout by a catalog entry only; the entries here are made for
the write or the read and dropped again, the files stay under their path.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _name() -> str:
    return f"adlake_{uuid.uuid4().hex}"


def write_buckets(df: DataFrame, path: str, by: Sequence[str], n: int) -> None:
    """Write ``df`` as ``n`` buckets of the columns ``by``, one file each,
    sorted by them: one shuffle, now, for all later readers."""
    spark, name = df.sparkSession, _name()
    (df.repartition(n, *[F.col(c) for c in by]).write.format("parquet").bucketBy(n, *by).sortBy(*by)
       .option("path", path).option("compression", "zstd").saveAsTable(name))
    spark.sql(f"DROP TABLE {name}")


def read_buckets(spark: SparkSession, path: str, schema: T.StructType, by: Sequence[str], n: int) -> DataFrame:
    """The table that ``write_buckets`` left at ``path``, with its layout."""
    name = _name()
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{c}`" for c in by)
    spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {n} BUCKETS LOCATION '{path}'")
    df = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the frame keeps what it needs; an external table's files stay
    return df
