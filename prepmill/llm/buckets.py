"""A stored table whose rows already lie by a key, so that grouping by it moves nothing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from prepmill.sources.storage import scratch_path


def bucketed(df: DataFrame, label: str, key: str, buckets: int) -> DataFrame:
    """``df`` stored in ``buckets`` buckets of ``key`` below the shared folder. The catalog entry goes at once, the files
    stay with the other working storage."""
    spark, name = df.sparkSession, f"{label.replace('-', '_')}_{uuid.uuid4().hex}"
    path = scratch_path(spark, label)
    df.write.format("parquet").bucketBy(buckets, key).option("path", path).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored
