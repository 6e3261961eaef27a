"""Writers for result tables and readers for stored runs, metrics and summaries."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgauge.operators.metrics import COUNTS, METRICS
from postgauge.operators.selection import ranking_order
from postgauge.operators.tracking import (
    METADATA_COLUMNS,
    PAIR,
    RUN_METRICS,
    SUMMARY_COLUMNS,
    run_summary,
)

CONFUSION_SCHEMA = T.StructType(
    [
        T.StructField("labels", T.ArrayType(T.StringType())),
        *(T.StructField(name, T.LongType()) for name in COUNTS),
    ]
)
METRICS_SCHEMA = T.StructType(
    [
        *(T.StructField(name, T.DoubleType()) for name in METRICS),
        T.StructField("confusion_matrix", CONFUSION_SCHEMA),
    ]
)
_NUMBERS = {
    "duration_seconds": T.DoubleType(),
    "validation_size": T.DoubleType(),
    "random_state": T.LongType(),
}
# Further fields of a run record.
_EXTRA = (
    "input_path",
    "metrics_path",
    "predictions_path",
    "interpretability_path",
    "model_path",
    "error",
)
METADATA_SCHEMA = T.StructType(
    [
        T.StructField(name, _NUMBERS.get(name, T.StringType()))
        for name in (*METADATA_COLUMNS, *_EXTRA)
    ]
)
METADATA_FILE = "run_metadata.json"
METRICS_FILE = "metrics.json"


def write_table(frame: DataFrame, path: str, kind: str = "parquet", **options: str) -> None:
    """Write one result table; nested columns need parquet or JSON."""
    writer = frame.write.mode("overwrite").options(**options)
    if kind == "csv":
        writer.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    elif kind == "json":
        writer.option("ignoreNullFields", False).json(path)
    elif kind == "parquet":
        writer.parquet(path)
    else:
        raise ValueError(f"unknown table kind: {kind}")


def write_answers(answers: DataFrame, path: str) -> None:
    """Append raw answers as JSON lines, one folder per model and prompt mode."""
    answers.write.mode("append").partitionBy("model", "prompt_mode").json(path)


def read_answers(spark: SparkSession, path: str) -> DataFrame:
    """Stored answers; an answer that is not a text counts as empty.

    ``position`` is the place in the stored files, for logs without a run start or number.
    """
    schema = (
        "text_id string, user_id string, raw_response variant, error string, "
        "run_started timestamp, attempt bigint, seq bigint, model string, prompt_mode string"
    )
    stored = spark.read.schema(schema).json(path)
    place = F.struct(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("row"),
    )
    stored = stored.withColumn("position", place)
    text = F.when(
        F.schema_of_variant("raw_response") == "STRING",
        F.try_variant_get("raw_response", "$", "string"),
    )
    return stored.withColumn("raw_response", F.coalesce(text, F.lit("")))


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return bool(files)


def _records(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    """One JSON record per file with the run folder it came from."""
    read = spark.read.schema(schema).option("multiLine", True).json(pattern)
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)/[^/]+(/part-[^/]*)?$", 1)
    return read.withColumn("run_dir", folder)


def read_run_summary(spark: SparkSession, base: str) -> DataFrame:
    """Run records below a folder joined with their metrics."""
    metadata_glob, metrics_glob = f"{base}/*/{METADATA_FILE}", f"{base}/*/{METRICS_FILE}"
    if not path_exists(spark, metadata_glob):
        return spark.createDataFrame([], METADATA_SCHEMA).select(
            *METADATA_COLUMNS,
            *(F.lit(None).cast("double").alias(m) for m in RUN_METRICS),
            *(F.lit(None).cast("bigint").alias(c) for c in COUNTS),
        )
    metadata = _records(spark, metadata_glob, METADATA_SCHEMA)
    if path_exists(spark, metrics_glob):
        metrics = _records(spark, metrics_glob, METRICS_SCHEMA)
    else:
        empty = T.StructType([*METRICS_SCHEMA.fields, T.StructField("run_dir", T.StringType())])
        metrics = spark.createDataFrame([], empty)
    return run_summary(metadata, metrics, "run_dir")


def read_method_metrics(spark: SparkSession, path: str, allow_missing: bool) -> DataFrame | None:
    """One method's metrics record; None when it may be missing and is."""
    if not path_exists(spark, path):
        if allow_missing:
            return None
        raise FileNotFoundError(f"no metrics at {path}")
    read = spark.read.option("wholetext", True).text(path)
    document = F.try_parse_json("value")
    kinds = read.select(F.schema_of_variant(document).alias("kind")).collect()
    if any(row["kind"] is None or not row["kind"].startswith("OBJECT") for row in kinds):
        raise ValueError(f"invalid metrics file: {path}")
    return spark.read.schema(METRICS_SCHEMA).option("multiLine", True).json(path)


def read_summary_csv(spark: SparkSession, path: str, allow_missing: bool = True) -> DataFrame | None:
    """An optional summary table; None when missing or empty."""
    if not path_exists(spark, path):
        if allow_missing:
            return None
        raise FileNotFoundError(f"no summary at {path}")
    read = spark.read.option("header", True).option("escape", '"').csv(path)
    if read.isEmpty():
        return None
    numbers = {*METRICS, *COUNTS, "error_count"}
    return read.select(
        *(F.col(c).try_cast("double").alias(c) if c in numbers else F.col(c) for c in read.columns)
    )


def _checked(frame: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(frame.columns))
    if missing:
        raise ValueError(f"summary lacks required columns: {', '.join(missing)}")
    return frame


def coerce_cv_summary(summary: DataFrame) -> DataFrame:
    """Numeric columns read as numbers, rows without a mean dropped, ranked."""
    _checked(summary, (*PAIR, "mean_protocol_auc", "std_protocol_auc", "mean_roc_auc", "mean_f1"))

    def numeric(name: str) -> bool:
        return name.startswith(("mean_", "std_")) or name in ("n_splits", "folds_completed")

    read = summary.select(
        *(
            F.col(c).cast("string").try_cast("double").alias(c) if numeric(c) else F.col(c)
            for c in summary.columns
        )
    )
    return read.where(F.col("mean_protocol_auc").isNotNull()).orderBy(*ranking_order())


def coerce_run_summary(summary: DataFrame) -> DataFrame:
    """Metrics read as numbers and the start time as a time; what cannot be read is null."""
    _checked(summary, SUMMARY_COLUMNS)
    metrics = {m: F.col(m).cast("string").try_cast("double") for m in RUN_METRICS}
    start = F.col("started_at").cast("string").try_cast("timestamp")
    return summary.withColumns({**metrics, "started_at_sort": start})
