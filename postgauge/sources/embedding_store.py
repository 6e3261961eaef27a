"""The table of stored embeddings, on shelves by the hash of the key.

Files lie below ``generation=N/shelf=S``. A lookup reads only the shelves of its requests. Vectors
are appended to the newest generation; compaction writes one row per key to the next one, which
counts once its success mark is there, so a broken compaction changes nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgauge.operators.embeddings import CACHE_KEY, CACHE_SCHEMA, check_vectors
from postgauge.sources.generations import newest_generation, next_generation
from postgauge.sources.results import path_exists

#: Shelves of a store; its files tell nothing else apart, so the number must not change.
SHELVES = 256
_SHELVED = T.StructType([*CACHE_SCHEMA.fields, T.StructField("shelf", T.IntegerType())])


def shelf() -> Column:
    """Shelf of a row, from its key."""
    return F.pmod(F.xxhash64(*(F.col(c).cast("string") for c in CACHE_KEY)), F.lit(SHELVES)).cast("int")


def read_store(spark: SparkSession, path: str, requests: DataFrame | None = None) -> DataFrame:
    """Stored vectors, or none yet; with ``requests`` only those on the shelves they touch.

    A key that was appended twice is still there twice until compaction.
    """
    newest = newest_generation(spark, path)
    if newest is None and not path_exists(spark, f"{path}/part-*"):
        return spark.createDataFrame([], CACHE_SCHEMA)
    if newest is None:
        return check_vectors(spark.read.schema(CACHE_SCHEMA).parquet(path))
    stored = spark.read.schema(_SHELVED).parquet(newest)
    if requests is not None:
        touched = [row[0] for row in requests.select(shelf()).distinct().collect()]
        stored = stored.where(F.col("shelf").isin(touched))
    return check_vectors(stored).drop("shelf")


def _write(rows: DataFrame, folder: str, mode: str) -> None:
    shelved = rows.select(*CACHE_SCHEMA.fieldNames()).withColumn("shelf", shelf())
    # One file of a shelf per task would be many small ones; salted, a shelf has a few.
    dealt = shelved.repartition("shelf", F.pmod(F.xxhash64(*CACHE_KEY, F.lit(1)), F.lit(4)))
    dealt.write.mode(mode).partitionBy("shelf").parquet(folder)


def append_store(fresh: DataFrame, path: str) -> None:
    """Only vectors that were missing are added."""
    spark = fresh.sparkSession
    _write(fresh, newest_generation(spark, path) or next_generation(spark, path), "append")


def compact_store(spark: SparkSession, path: str) -> None:
    """Write one row per key as a new generation; older ones may be deleted afterwards."""
    if newest_generation(spark, path) is None:
        return
    rows = read_store(spark, path).groupBy(*CACHE_KEY).agg(F.max("embedding").alias("embedding"))
    _write(rows, next_generation(spark, path), "overwrite")
