"""Sharding by sampled splitters.

Rows are ordered by id. Keys are drawn with a chance in proportion to their size, the
quantiles of the draw become splitters, and rows are range-partitioned by them. A range that
holds more than twice its share of the bytes or of the rows is subdivided: by key where it has several keys, else by a
hash that differs between the rows of one key. Exact totals of the ranges then give every
row its place in the total order, and the shard follows from the place: shard s of n takes
the rows whose middle byte lies in the s-th n-th of all bytes, so shards differ by less
than one row's size at each end. Law ``rows`` does the same with every size taken as one.

The splitters only spread the work; they do not change which shard a row gets, except that
rows of one hot key stand in hash order.

Defined cases: a null text has no bytes (size 1); null ids come first; repeated rows get a
slot each; an empty table gives an empty result. Only the id and the text are read, and
``carry`` names further columns to keep beside the result.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postgauge.session import settle

#: Ranges at least, rows a range has about once there are more, and keys drawn per range.
RANGES = 256
RANGE_ROWS = 250_000
DRAWS = 32

_FIRST_KEY = -(1 << 63)


def splitters(keys: Sequence[int], weights: Sequence[float], ranges: int) -> list[int]:
    """Lower bounds of all ranges but the first, from a weighted sample.

    A key that covers several quantiles gets a range of its own.
    """
    if not len(keys):
        return []
    order = np.argsort(np.asarray(keys), kind="stable")
    drawn = np.asarray(keys)[order]
    reached = np.cumsum(np.asarray(weights, dtype=float)[order])
    at = np.searchsorted(reached, reached[-1] * np.arange(1, ranges) / ranges)
    chosen = [int(x) for x in drawn[at]]
    bounds = set(chosen)
    for before, after in zip(chosen, chosen[1:], strict=False):
        if before == after:
            bounds.add(after + 1)
    return sorted(bounds)


def _share(x: Column) -> Column:
    """A number from 0 up to 1 that depends on all columns hashed into ``x``."""
    return F.shiftrightunsigned(x, 11) / F.lit(float(1 << 53))


def _ranges(rows: DataFrame, total: int, count: int) -> tuple[DataFrame, int]:
    """Add ``zone``, the range a row's key falls into, by size-weighted sampling."""
    ranges = max(RANGES, -(-count // RANGE_ROWS))
    chance = F.col("weight") * F.lit(float(ranges * DRAWS)) / F.lit(float(total))
    drawn = (
        rows.filter(_share(F.xxhash64("mix", F.lit("draw"))) < chance)
        .select("key", F.greatest(chance, F.lit(1.0)).alias("stands_for"))
        .toPandas()
    )
    bounds = np.array(splitters(drawn["key"].tolist(), drawn["stands_for"].tolist(), ranges), np.int64)

    @F.pandas_udf("int")
    def zone(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(), side="right").astype(np.int32))

    return rows.withColumn("zone", zone("key")), ranges


def _subdivided(rows: DataFrame, total: int, ranges: int) -> DataFrame:
    """Add ``piece`` within ``zone``: 0, or a part of an overfull range."""
    share = total / ranges
    each = -(-rows.count() // ranges)
    crowded = (
        rows.groupBy("zone")
        .agg(
            F.sum("weight").alias("weight"),
            F.count("*").alias("n"),
            F.min("key").alias("low"),
            F.max("key").alias("high"),
        )
        .filter(((F.col("weight") > 2 * share) | (F.col("n") > 2 * each)) & (F.col("n") > 1))
        .collect()
    )
    cuts = {
        r["zone"]: (r["low"], r["high"], max(-(-r["weight"] // max(1, int(share))), -(-r["n"] // each)))
        for r in crowded
    }

    @F.pandas_udf("long")
    def piece(zone: pd.Series, key: pd.Series, mix: pd.Series) -> pd.Series:
        out = np.zeros(len(zone), dtype=np.int64)
        zones = zone.to_numpy()
        for z in set(zones.tolist()) & cuts.keys():
            low, high, parts = cuts[z]
            here = zones == z
            if low < high:
                place = (key.to_numpy()[here].astype(float) - low) / (float(high) - low)
            else:
                place = mix.to_numpy()[here].astype(float) / 2.0**64 + 0.5
            out[here] = np.minimum((place * parts).astype(np.int64), parts - 1)
        return pd.Series(out)

    return rows.withColumn("piece", piece("zone", "key", "mix"))


def assign_shards(
    docs: DataFrame,
    shards: int = 8,
    law: str = "bytes",
    id_column: str = "doc_id",
    text: str = "text",
    carry: Sequence[str] = (),
) -> DataFrame:
    """Per row: doc_id, size, text_crc32, shard, slot (and ``record``, a struct, with ``carry``).

    ``law`` is ``bytes`` (sizes near equal) or ``rows`` (counts at most one apart).
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"no law {law!r}")
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    size = F.octet_length(body).cast("long") + 1
    rows = settle(
        docs.select(
            F.col(id_column).cast("long").alias("doc_id"),
            F.coalesce(F.col(id_column).cast("long"), F.lit(_FIRST_KEY)).alias("key"),
            size.alias("size"),
            (size if law == "bytes" else F.lit(1).cast("long")).alias("weight"),
            F.crc32(body).alias("text_crc32"),
            F.xxhash64(F.col(id_column), body, F.monotonically_increasing_id()).alias("mix"),
            *([F.struct(*carry).alias("record")] if carry else []),
        )
    )
    whole = rows.agg(F.sum("weight").alias("weight"), F.count("*").alias("n")).first()
    total, count = whole["weight"] or 0, whole["n"]
    zoned, ranges = _ranges(rows, total, count)
    cut = _subdivided(zoned, total, ranges)

    inside = Window.partitionBy("zone", "piece").orderBy("key", "mix")
    placed = settle(
        cut.withColumn("place", F.row_number().over(inside).cast("long"))
        .withColumn("reached", F.sum("weight").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
        .drop("mix")
    )
    before = _totals_before(placed)
    rank = F.col("rows_before") + F.col("place") - 1
    reached = F.col("weight_before") + F.col("reached")
    middle = 2 * reached - F.col("weight")
    shard = F.least(F.expr(f"(middle * {shards}) div {2 * total or 1}"), F.lit(shards - 1))
    ranked = (
        placed.join(F.broadcast(before), ["zone", "piece"])
        .withColumn("middle", middle)
        .withColumn("rank", rank)
        .withColumn("shard", shard.cast("int"))
    )
    if law == "rows":
        ranked = ranked.withColumn("shard", F.expr(f"(rank * {shards}) div {max(count, 1)}").cast("int"))
    firsts = {r["shard"]: r["first"] for r in ranked.groupBy("shard").agg(F.min("rank").alias("first")).collect()}
    first = F.element_at(
        F.array(*(F.lit(firsts.get(s, 0)).cast("long") for s in range(shards))), F.col("shard") + 1
    )
    return ranked.select(
        "doc_id",
        "size",
        "text_crc32",
        "shard",
        (F.col("rank") - first).alias("slot"),
        *(["record"] if carry else []),
    )


def _totals_before(placed: DataFrame) -> DataFrame:
    """Rows and weight before each (zone, piece); a row per range, so it may be on the driver."""
    spark = placed.sparkSession
    totals = (
        placed.groupBy("zone", "piece")
        .agg(F.count("*").alias("n"), F.sum("weight").alias("weight"))
        .toPandas()
        .sort_values(["zone", "piece"])
    )
    totals["rows_before"] = totals["n"].cumsum() - totals["n"]
    totals["weight_before"] = totals["weight"].cumsum() - totals["weight"]
    rows = totals[["zone", "piece", "rows_before", "weight_before"]].astype("int64")
    return spark.createDataFrame(
        rows.values.tolist(), "zone int, piece long, rows_before long, weight_before long"
    )
