"""Posts tables: reading, column checks, missing values and label decoding."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postgauge.config import LABEL, TARGET, TEXT, TEXT_ID, TITLE, USER
from postgauge.functions.labels import decode_label
from postgauge.sources.split_csv import csv_records

# CSV cells that mean "missing".
MISSING_CELLS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
SHOWN_BAD_LABELS = 20
BEYOND = "_beyond_header"


def require_columns(frame: DataFrame, require_label: bool = True) -> None:
    wanted = [USER, TEXT_ID, TITLE, TEXT, *([LABEL] if require_label else [])]
    missing = [name for name in wanted if name not in frame.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def fill_text(frame: DataFrame) -> DataFrame:
    """Missing titles and bodies become empty, so no row is lost."""
    present = [name for name in (TITLE, TEXT) if name in frame.columns]
    return frame.withColumns({name: F.coalesce(name, F.lit("")) for name in present})


def target_column(frame: DataFrame) -> Column:
    """0/1 from label text or a numeric label; null when it is neither."""
    if isinstance(frame.schema[LABEL].dataType, T.StringType):
        return decode_label(F.col(LABEL))
    number = F.col(LABEL).cast("double")
    return F.when(number == 1.0, 1).when(number == 0.0, 0).cast("int")


def decode_labels(frame: DataFrame, check: bool = True) -> DataFrame:
    """Add the target column; unknown labels are an error that counts them and names some.

    Without a label column the frame passes through.
    """
    if LABEL not in frame.columns:
        return frame
    decoded = frame.withColumn(TARGET, target_column(frame))
    if check:
        bad = decoded.where(F.col(TARGET).isNull()).select(F.col(LABEL).cast("string")).distinct()
        found = bad.count()
        if found:
            shown = sorted(str(row[0]) for row in bad.limit(SHOWN_BAD_LABELS).collect())
            raise ValueError(f"{found} labels not recognised: {', '.join(shown)}")
    return decoded


def prepare_posts(frame: DataFrame, require_label: bool = True, check: bool = True) -> DataFrame:
    """Column check, empty text for missing text, decoded labels."""
    require_columns(frame, require_label)
    return decode_labels(fill_text(frame), check)


_CSV = {"quote": '"', "escape": '"', "multiLine": "true"}


def read_csv_columns(
    spark: SparkSession, path: str, columns: Sequence[str] | None = None, split: bool = True
) -> DataFrame:
    """Quoted, multi-line CSV as text columns with missing cells as null.

    Columns are matched by the header; only the wanted ones are kept. A row with a cell
    beyond the header is an error. Files are read by byte range unless ``split`` is off: then
    a file is one task, and quotes inside unquoted cells are text.
    """
    whole_file = spark.read.options(**_CSV, header="true", encoding="UTF-8")
    if split:
        records, text = csv_records(spark, path)
        if not text:
            raise ValueError(f"no header in {path}")
        line = spark.createDataFrame([(text,)], "record string")
        width = text.count(",") + 1
        cells = line.select(F.from_csv("record", _row_schema(f"c{i}" for i in range(width)), _CSV).alias("r"))
        header = [c for c in cells.first()["r"] if c is not None]
        parsed = records.select(F.from_csv("record", _row_schema((*header, BEYOND)), _CSV).alias("r"))
        raw = parsed.select("r.*")
    else:
        header = whole_file.csv(path).columns
        fields = [T.StructField(name, T.StringType()) for name in (*header, BEYOND)]
        raw = whole_file.option("columnPruning", False).schema(T.StructType(fields)).csv(path)
    complete = raw.where(
        F.when(F.col(BEYOND).isNull(), True).otherwise(
            F.raise_error(F.lit(f"a row of {path} has more cells than the header"))
        )
    )
    names = [c for c in header if columns is None or c in columns]
    return complete.select(
        *(F.when(~F.col(f"`{c}`").isin(*MISSING_CELLS), F.col(f"`{c}`")).alias(c) for c in names)
    )


def _row_schema(names: Iterable[str]) -> str:
    return ", ".join(f"`{name}` string" for name in names)


def read_raw_posts(spark: SparkSession, path: str, with_id: bool = False) -> DataFrame:
    """User, title, body and label as stored, for counting missing values.

    ``with_id`` keeps the post id too, which a test fold needs.
    """
    return read_csv_columns(spark, path, (USER, *([TEXT_ID] if with_id else []), TITLE, TEXT, LABEL))


def read_posts_csv(spark: SparkSession, path: str, require_label: bool = True) -> DataFrame:
    return prepare_posts(read_csv_columns(spark, path), require_label)


def read_posts_parquet(spark: SparkSession, path: str, require_label: bool = True) -> DataFrame:
    """The columnar form; it needs no pass over the file to find the records."""
    return prepare_posts(spark.read.parquet(path), require_label)
