"""Tables that are replaced as a whole: the newest folder with a success mark is the table."""

from __future__ import annotations

import re

from pyspark.sql import SparkSession


def generations(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the finished generations, oldest first."""
    target = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/generation=*/_SUCCESS")
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target) or []
    names = (re.search(r"generation=(\d+)/_SUCCESS$", str(status.getPath())) for status in found)
    return sorted(int(name.group(1)) for name in names if name)


def newest_generation(spark: SparkSession, path: str) -> str | None:
    numbers = generations(spark, path)
    return f"{path}/generation={numbers[-1]}" if numbers else None


def next_generation(spark: SparkSession, path: str) -> str:
    """Where to write what replaces the table; an unfinished one there is overwritten."""
    return f"{path}/generation={(generations(spark, path) or [0])[-1] + 1}"
