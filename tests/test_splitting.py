import math

import pytest
from pyspark.sql import functions as F

from postgauge.operators import splitting as S
from postgauge.plans.training import normalized
from postgauge.sources.posts import decode_labels


@pytest.fixture(scope="module")
def posts(small_posts):
    return decode_labels(small_posts).cache()


def test_split_is_exact_disjoint_and_repeatable(spark, posts):
    split = S.split_by_user(posts, 0.2, 42)
    users = posts.select("user_id").distinct().count()
    assert split.n_users == users and split.n_validation == math.ceil(0.2 * users)
    train, valid = split.train(posts), split.validation(posts)
    assert valid.select("user_id").distinct().count() == split.n_validation
    assert S.shared_users(train, valid).count() == 0
    assert train.count() + valid.count() == posts.count()
    assert S.split_by_user(posts.repartition(7), 0.2, 42) == split
    quality = {r.split: r for r in S.split_quality(split.tag(posts)).collect()}
    assert quality["entrenamiento"].rows == train.count()
    assert all(r.user_id_overlap_count == 0 for r in quality.values())


def test_split_guards(spark, posts):
    with pytest.raises(ValueError):
        S.split_by_user(posts.drop("user_id"))
    with pytest.raises(ValueError):
        S.split_by_user(posts.where("user_id = 'heavy'"))


def test_folds_cover_users_once(spark, posts):
    folds = S.assign_folds(posts, 4, 1)
    again = S.assign_folds(posts.repartition(5), 4, 1)
    assert sorted(map(tuple, folds.collect())) == sorted(map(tuple, again.collect()))
    assert folds.count() == posts.select("user_id").distinct().count()
    tagged = S.tag_folds(posts, folds)
    assert tagged.count() == posts.count() and tagged.where("fold is null").count() == 0
    rows = S.fold_integrity(tagged).collect()
    assert len(rows) == 4 and all(r.user_overlap_count == 0 for r in rows)


def test_equal_users_spread_evenly(spark):
    rows = [(f"u{i}", f"t{i}", i % 2) for i in range(103)]
    frame = spark.createDataFrame(rows, "user_id string, text_id string, y int")
    tagged = S.tag_folds(frame, S.assign_folds(frame, 5, 42))
    sizes = {r.fold: r for r in S.fold_integrity(tagged).collect()}
    assert max(r.validation_rows for r in sizes.values()) - min(r.validation_rows for r in sizes.values()) <= 2
    assert all(r.count_yes in (10, 11) and r.count_no in (10, 11) for r in sizes.values())


def test_posts_without_user_are_refused(spark):
    frame = spark.createDataFrame([(None, "1", 0), ("b", "2", 1)], "user_id string, text_id string, y int")
    for split in (S.split_by_user, S.assign_folds):
        with pytest.raises(ValueError, match="1 posts have no user_id"):
            split(frame)


def test_many_signatures_stay_balanced(spark):
    rows = [(f"u{i}", f"t{i}-{j}", int(j < i % 13)) for i in range(300) for j in range(1 + i % 13 + i % 7)]
    frame = spark.createDataFrame(rows, "user_id string, text_id string, y int")
    tagged = S.tag_folds(frame, S.assign_folds(frame, 5, 42))
    sizes = S.fold_integrity(tagged).collect()
    for column in ("validation_rows", "count_yes", "count_no", "validation_users"):
        found = [r[column] for r in sizes]
        assert max(found) - min(found) <= 0.12 * sum(found) / 5


def test_fold_limits(spark):
    frame = spark.createDataFrame([("a", "1", 0), ("b", "2", 1), ("c", "3", 1)], "user_id string, text_id string, y int")
    with pytest.raises(ValueError):
        S.assign_folds(frame, 5)
    with pytest.warns(UserWarning):
        S.assign_folds(frame, 2)


@pytest.mark.parametrize("kind", ["string", "bigint"])
def test_hot_user_is_looked_up(spark, kind):
    rows = [(0, f"h{i}", i % 2) for i in range(3000)] + [(i + 1, f"t{i}", i % 2) for i in range(3000)]
    frame = spark.createDataFrame(rows, "user_id bigint, text_id string, y int")
    frame = frame.withColumn("user_id", F.col("user_id").cast(kind))
    tagged = S.tag_folds(frame, S.assign_folds(frame, 3)).cache()
    assert tagged.count() == 6000 and tagged.where("fold is null").count() == 0
    assert tagged.where("user_id = 0").select("fold").distinct().count() == 1


def test_few_shot(spark, posts):
    found = S.few_shot_examples(normalized(posts), 3, 42, min_chars=10)
    rows = S.require_examples(found, 3)
    assert [r.label for r in rows] == ["yes"] * 3 + ["no"] * 3
    assert [r.text_id for r in rows[:3]] == sorted(r.text_id for r in rows[:3])
    assert rows == S.require_examples(S.few_shot_examples(normalized(posts.repartition(6)), 3, 42, 10), 3)
    with pytest.raises(ValueError, match="0 usable"):
        S.require_examples(S.few_shot_examples(normalized(posts), 3, 42, min_chars=900), 3)


def test_diagnosis(spark, small_posts):
    test = small_posts.withColumn("title", F.when(F.col("text_id") != "t00", F.col("title")))
    row = S.test_fold_diagnosis(small_posts, decode_labels(test), True).first()
    assert (row.train_rows, row.test_rows, row.missing_title_values) == (60, 60, 1)
    assert row.train_test_user_overlap_count == row.unique_test_users
    assert row.test_label_yes == 20
