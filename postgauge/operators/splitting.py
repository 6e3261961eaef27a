"""User-disjoint splits, stratified folds, example sampling and leakage checks."""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postgauge.config import (
    NEGATIVE_LABEL,
    POSITIVE_LABEL,
    SPLIT,
    TARGET,
    TEXT_ID,
    TRAIN_SPLIT,
    USER,
    VALIDATION_SPLIT,
)
from postgauge.functions.keys import order_key
from postgauge.operators.terms import NORMALIZED
from postgauge.session import settle

PREFIX = 3
HOT_SHARE = 2_000


@dataclass(frozen=True)
class UserSplit:
    """Users whose order key is at most ``cut`` form the validation side.

    The cut is one value, so tagging posts is a filter: no user table is joined and a
    user with a third of all posts costs nothing extra.
    """

    seed: int
    cut: str
    n_users: int
    n_validation: int

    @property
    def is_validation(self) -> Column:
        return order_key(self.seed, F.col(USER)) <= F.lit(self.cut)

    def tag(self, posts: DataFrame) -> DataFrame:
        side = F.when(self.is_validation, VALIDATION_SPLIT).otherwise(TRAIN_SPLIT)
        return posts.withColumn(SPLIT, side)

    def train(self, posts: DataFrame) -> DataFrame:
        return posts.where(~self.is_validation)

    def validation(self, posts: DataFrame) -> DataFrame:
        return posts.where(self.is_validation)


def split_by_user(posts: DataFrame, validation_size: float = 0.2, seed: int = 42) -> UserSplit:
    """Exactly ``ceil(validation_size * users)`` users go to validation.

    One pass counts distinct users per key prefix, at most 4096 rows; the second reads
    only the users under the prefix that holds the cut.
    """
    require_users(posts)
    keys = posts.select(order_key(seed, F.col(USER)).alias("key"))
    prefix = F.substring("key", 1, PREFIX).alias("prefix")
    counted = keys.distinct().groupBy(prefix).count().collect()
    n_users = sum(row["count"] for row in counted)
    n_validation = math.ceil(validation_size * n_users)
    if not 0 < n_validation < n_users:
        raise ValueError(f"{n_users} users are too few for a validation share of {validation_size}")

    rank = n_validation
    for row in sorted(counted):
        if rank <= row["count"]:
            break
        rank -= row["count"]
    inside = keys.where(F.col("key").startswith(row["prefix"])).distinct()
    cut = inside.orderBy("key").offset(rank - 1).limit(1).first()["key"]
    return UserSplit(seed, cut, n_users, n_validation)


def shared_users(left: DataFrame, right: DataFrame) -> DataFrame:
    """Users present on both sides; both sides are reduced to users first."""
    return left.select(USER).distinct().join(right.select(USER).distinct(), USER, "left_semi")


def split_quality(tagged: DataFrame) -> DataFrame:
    """Rows, users, class counts and shares per split, with the user overlap.

    Posts are first reduced to one row per split and user, so a user with very many
    posts is a partial sum and not a long group.
    """
    per_user = tagged.groupBy(SPLIT, USER).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(TARGET) == 0).alias(NEGATIVE_LABEL),
        F.count_if(F.col(TARGET) == 1).alias(POSITIVE_LABEL),
    )
    sides = per_user.groupBy(SPLIT).agg(
        F.sum("rows").alias("rows"),
        F.count(F.lit(1)).alias("unique_users"),
        F.sum(NEGATIVE_LABEL).alias("count_no"),
        F.sum(POSITIVE_LABEL).alias("count_yes"),
    )
    overlap = (
        per_user.groupBy(USER)
        .agg(F.count(F.lit(1)).alias("sides"))
        .agg(F.count_if(F.col("sides") > 1).alias("n"))
        .scalar()
    )
    return sides.select(
        SPLIT,
        "rows",
        "unique_users",
        "count_no",
        "count_yes",
        (F.col("count_no") / F.col("rows")).alias("share_no"),
        (F.col("count_yes") / F.col("rows")).alias("share_yes"),
        overlap.alias("user_id_overlap_count"),
    )


def require_users(posts: DataFrame) -> None:
    """A post without a user belongs to no side of a split."""
    if USER not in posts.columns:
        raise ValueError(f"column not found: {USER}")
    missing = posts.where(F.col(USER).isNull()).count()
    if missing:
        raise ValueError(f"{missing} posts have no {USER}")


def _dealt(leftover: DataFrame, n_folds: int) -> DataFrame:
    """Folds of the users their signature cannot spread evenly, in one order over all.

    Users whose classes differ most come first; they are dealt one per fold, forwards and
    backwards in turn, so each round hands similar users to all folds. The order is cut
    into ranges whose counts shift the places inside them.
    """
    order = [F.desc(F.abs(F.col("neg") - F.col("pos"))), F.desc("pos"), F.desc("neg"), "key", USER]
    banded = settle(leftover.repartitionByRange(*order).withColumn("band", F.spark_partition_id()))
    before = Window.orderBy("band").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        banded.groupBy("band")
        .agg(F.count(F.lit(1)).alias("size"))
        .select("band", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before"))
    )
    place = F.row_number().over(Window.partitionBy("band").orderBy(*order)) - 1
    ranked = banded.withColumn("place", place).join(shifts, "band")
    rank = F.col("place") + F.col("before")
    step, turn = F.pmod(rank, F.lit(n_folds)), F.pmod(F.floor(rank / n_folds), F.lit(2))
    return ranked.withColumn("fold", F.when(turn == 0, step + 1).otherwise(n_folds - step))


def assign_folds(posts: DataFrame, n_folds: int = 5, seed: int = 42) -> DataFrame:
    """Stratified folds without shared users: ``(user_id, n, fold)``, one row per user."""
    require_users(posts)
    if TARGET not in posts.columns:
        raise ValueError(f"column not found: {TARGET}")
    users = settle(
        posts.groupBy(USER).agg(
            F.count_if(F.col(TARGET) == 0).alias("neg"), F.count_if(F.col(TARGET) == 1).alias("pos")
        )
    )
    class_rows = users.agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos")).first()
    if n_folds > max(class_rows):
        raise ValueError(f"{n_folds} folds exceed the rows of every class")
    if n_folds > min(class_rows):
        warnings.warn("the smaller class has fewer rows than there are folds", stacklevel=2)

    # Rank users inside their signature. The signature of single-post users may hold
    # most users, so it is ranked in up to 4096 pieces that are then shifted.
    keyed = users.withColumn("key", order_key(seed, F.col(USER))).withColumn(
        "prefix", F.substring("key", 1, PREFIX)
    )
    piece = ["neg", "pos", "prefix"]
    signature = Window.partitionBy("neg", "pos")
    before = signature.orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        keyed.groupBy(*piece)
        .agg(F.count(F.lit(1)).alias("size"))
        .withColumn("shift", F.coalesce(F.sum("size").over(before), F.lit(0)))
        .withColumn("alike", F.sum("size").over(signature))
    )
    place = F.row_number().over(Window.partitionBy(*piece).orderBy("key")) - 1
    ranked = settle(
        keyed.withColumn("place", place)
        .join(shifts.select(*piece, "shift", "alike"), piece)
        .withColumn("rank", F.col("place") + F.col("shift"))
        .select(USER, "neg", "pos", "key", "rank", "alike")
    )
    even = F.col("rank") < F.col("alike") - F.pmod("alike", F.lit(n_folds))
    spread = ranked.where(even).withColumn("fold", F.pmod("rank", F.lit(n_folds)) + 1)
    columns = [USER, (F.col("neg") + F.col("pos")).alias("n"), F.col("fold").cast("int").alias("fold")]
    dealt = _dealt(ranked.where(~even), n_folds)
    return settle(spread.select(*columns).unionByName(dealt.select(*columns)))


def tag_folds(posts: DataFrame, assignment: DataFrame) -> DataFrame:
    """Add the user's fold to every post.

    Users holding more than one in 2000 posts are looked up in a broadcast table, which
    therefore has fewer than 2000 rows; their posts join under their own ids, so no
    task receives all posts of one user.
    """
    total = assignment.agg(F.sum("n").alias("n")).first()["n"]
    hot = F.col("n") > total / HOT_SHARE
    heavy = assignment.where(hot).select(USER, F.col("fold").alias("_heavy"))
    light = assignment.where(~hot).select(
        F.col(USER).cast("string").alias("_light_user"), F.col("fold").alias("_light")
    )
    looked = posts.join(F.broadcast(heavy), USER, "left")
    key = F.when(F.col("_heavy").isNull(), F.col(USER).cast("string")).otherwise(
        F.concat(F.lit("\u0000"), F.col(TEXT_ID).cast("string"))
    )
    joined = looked.withColumn("_key", key).join(light, F.col("_key") == F.col("_light_user"), "left")
    return joined.withColumn("fold", F.coalesce("_heavy", "_light")).drop(
        "_heavy", "_light", "_key", "_light_user"
    )


def fold_integrity(tagged: DataFrame) -> DataFrame:
    """Rows, users and class counts per fold, with users that also occur elsewhere."""
    per_user = tagged.groupBy("fold", USER).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col(TARGET) == 0).alias("neg"),
        F.count_if(F.col(TARGET) == 1).alias("pos"),
    )
    spread = per_user.groupBy(USER).agg(
        F.collect_set("fold").alias("folds"),
        F.collect_list(F.struct("fold", "rows", "neg", "pos")).alias("parts"),
    )
    parts = spread.select(
        (F.size("folds") > 1).alias("shared"), F.explode("parts").alias("part")
    ).select("shared", "part.*")
    return parts.groupBy("fold").agg(
        F.sum("rows").alias("validation_rows"),
        F.count(F.lit(1)).alias("validation_users"),
        F.sum("neg").alias("count_no"),
        F.sum("pos").alias("count_yes"),
        F.count_if("shared").alias("user_overlap_count"),
    )


def few_shot_examples(
    posts: DataFrame,
    per_class: int = 3,
    seed: int = 42,
    min_chars: int = 80,
    max_chars: int = 1_200,
) -> DataFrame:
    """A repeatable sample per class among posts of suitable length, positives first.

    Expects the ``normalized`` column; the result has ``2 * per_class`` rows.
    """
    length = F.char_length(NORMALIZED)
    usable = posts.where(length.between(min_chars, max_chars) & (F.trim(NORMALIZED) != ""))
    sides = []
    for position, (value, label) in enumerate(((1, POSITIVE_LABEL), (0, NEGATIVE_LABEL))):
        key = order_key(seed + value, F.col(TEXT_ID))
        chosen = (
            usable.where(F.col(TARGET) == value)
            .select(
                F.lit(position).alias("_side"),
                F.col(TEXT_ID).cast("string").alias(TEXT_ID),
                F.lit(label).alias("label"),
                F.col(NORMALIZED).alias("text"),
            )
            .orderBy(key, TEXT_ID)
            .limit(per_class)
        )
        sides.append(chosen)
    both = sides[0].unionByName(sides[1])
    inside = Window.partitionBy("_side").orderBy(TEXT_ID)
    place = F.col("_side") * per_class + F.row_number().over(inside)
    return both.select(place.alias("position"), TEXT_ID, "label", "text")


def require_examples(examples: DataFrame, per_class: int) -> list:
    """The bounded example rows in prompt order, or an error when a class is short."""
    rows = sorted(examples.collect(), key=lambda row: row["position"])
    for label in (POSITIVE_LABEL, NEGATIVE_LABEL):
        found = sum(row["label"] == label for row in rows)
        if found < per_class:
            raise ValueError(f"only {found} usable examples of class {label}")
    return rows


def test_fold_diagnosis(train: DataFrame, test: DataFrame, labels_present: bool) -> DataFrame:
    """Size, missing values, users, overlap and label counts of a test fold.

    ``test`` must still hold its nulls.
    """
    train_users = train.groupBy(USER).agg(F.count(F.lit(1)).alias("train_rows"))
    aggregates = [
        F.count(F.lit(1)).alias("test_rows"),
        F.count_if(F.col("title").isNull()).alias("no_title"),
        F.count_if(F.col("text").isNull()).alias("no_text"),
    ]
    if labels_present:
        aggregates += [
            F.count_if(F.col(TARGET) == 0).alias("label_no"),
            F.count_if(F.col(TARGET) == 1).alias("label_yes"),
        ]
    test_users = test.groupBy(USER).agg(*aggregates)
    both = train_users.join(test_users, USER, "full")
    total = [
        F.coalesce(F.sum("train_rows"), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum("test_rows"), F.lit(0)).alias("test_rows"),
        F.coalesce(F.sum("no_title"), F.lit(0)).alias("missing_title_values"),
        F.coalesce(F.sum("no_text"), F.lit(0)).alias("missing_text_values"),
        F.count("train_rows").alias("unique_train_users"),
        F.count("test_rows").alias("unique_test_users"),
        F.count_if(F.col("train_rows").isNotNull() & F.col("test_rows").isNotNull()).alias(
            "train_test_user_overlap_count"
        ),
    ]
    if labels_present:
        total += [
            F.coalesce(F.sum("label_no"), F.lit(0)).alias("test_label_no"),
            F.coalesce(F.sum("label_yes"), F.lit(0)).alias("test_label_yes"),
        ]
    return both.agg(*total)
