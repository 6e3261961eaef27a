"""A run summary that reads every run record once.

The summary is stored with the folder and the times of the records each row came from. An
update lists the records, which opens none of them, reads those of new or changed runs only,
and writes all rows as a new generation. A generation counts once its success mark is there, so a
reader never sees half of one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.operators.tracking import SUMMARY_COLUMNS, run_summary
from postgauge.session import settle
from postgauge.sources.generations import newest_generation, next_generation
from postgauge.sources.results import (
    METADATA_FILE,
    METADATA_SCHEMA,
    METRICS_FILE,
    METRICS_SCHEMA,
    read_run_summary,
)

_SEEN = ("run_dir", "metadata_time", "metrics_time")


def _folder(path: Column) -> Column:
    """Name of the run's folder; a record may itself be a folder with one part."""
    return F.regexp_extract(path, r"([^/]+)/[^/]+(/part-[^/]*)?$", 1)


def _listed(spark: SparkSession, base: str, name: str, time: str) -> DataFrame:
    """Folder, path and time of every record of a kind."""
    files = []
    for pattern in (f"{base}/*/{name}", f"{base}/*/{name}/part-*"):
        target = spark._jvm.org.apache.hadoop.fs.Path(pattern)
        found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
        files += [(str(s.getPath()), s.getModificationTime()) for s in found if not s.isDirectory()]
    rows = spark.createDataFrame(files, "path string, millis long")
    return rows.select(
        _folder(F.col("path")).alias("run_dir"),
        F.col("path").alias(f"{time}_path"),
        F.timestamp_millis("millis").alias(f"{time}_time"),
    )


def _read(spark: SparkSession, paths: list[str], schema) -> DataFrame:
    rows = spark.read.schema(schema).option("multiLine", True).json(paths) if paths else spark.createDataFrame([], schema)
    place = F.col("_metadata.file_path") if paths else F.lit("")
    return rows.withColumn("run_dir", _folder(place))


def update_run_summary(spark: SparkSession, base: str, path: str) -> tuple[DataFrame, int]:
    """The summary of all runs below ``base``, and how many runs had to be read.

    Runs whose folder is gone leave the summary.
    """
    listed = settle(
        _listed(spark, base, METADATA_FILE, "metadata").join(
            _listed(spark, base, METRICS_FILE, "metrics"), "run_dir", "left"
        )
    )
    newest = newest_generation(spark, path)
    if newest is None:
        empty = read_run_summary(spark, f"{path}/no-runs")
        stamps = [F.lit(None).cast("timestamp").alias(c) for c in _SEEN[1:]]
        known = empty.select(F.lit("").alias("run_dir"), *stamps, *SUMMARY_COLUMNS)
    else:
        known = spark.read.parquet(newest)
    same = [F.col(f"l.{c}").eqNullSafe(F.col(f"k.{c}")) for c in _SEEN]
    unchanged = known.alias("k").join(listed.alias("l"), same, "left_semi")
    fresh = settle(listed.alias("l").join(known.alias("k"), same, "left_anti"))
    files = fresh.select("metadata_path", "metrics_path").collect()
    metadata = _read(spark, [r["metadata_path"] for r in files], METADATA_SCHEMA)
    metrics = _read(spark, [r["metrics_path"] for r in files if r["metrics_path"]], METRICS_SCHEMA)
    rows = run_summary(metadata, metrics, "run_dir", keep=("run_dir",))
    added = rows.join(fresh.select(*_SEEN), "run_dir").select(*_SEEN, *SUMMARY_COLUMNS)
    whole = unchanged.select(*_SEEN, *SUMMARY_COLUMNS).unionByName(added)
    target = next_generation(spark, path)
    whole.write.mode("overwrite").parquet(target)
    return spark.read.parquet(target).select(*SUMMARY_COLUMNS), len(files)


def stored_run_summary(spark: SparkSession, path: str) -> DataFrame:
    """The summary as last updated; no record is opened."""
    newest = newest_generation(spark, path)
    if newest is None:
        return read_run_summary(spark, f"{path}/no-runs")
    return spark.read.parquet(newest).select(*SUMMARY_COLUMNS)
