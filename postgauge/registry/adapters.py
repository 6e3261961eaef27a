"""Views of the shared tables as posts, predictions, runs and stored answers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postgauge.config import CLASSIFIERS, FEATURES, LABEL, TARGET, TEXT_ID, USER
from postgauge.functions.keys import hash_fold, run_id
from postgauge.operators.metrics import evaluate, metric_record
from postgauge.plans.training import normalized
from postgauge.sources.posts import prepare_posts

SEED = 42
FOLDS = 5
PRICE_CUT = 250_000.0
ANSWER_MODELS = ("gemma3:4b", "llama3.2:3b")
ANSWER_MODES = ("few_shot", "zero_shot")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_posts(spark: SparkSession, sf_dir: str, labelled: bool | None = None) -> DataFrame:
    """Documents as posts; label text for those with a label.

    ``labelled`` keeps only posts with or only posts without a label.
    """
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    kind = {None: "left", True: "inner", False: "left_anti"}[labelled]
    joined = documents.join(labels, "doc_id", kind)
    if labelled is False:
        joined = joined.withColumn("quality", F.lit(None).cast("int"))
    text = F.coalesce("text", F.lit(""))
    newline = F.instr(text, "\n")
    return joined.select(
        F.col("doc_id").cast("string").alias(TEXT_ID),
        F.concat_ws("_", "source", (F.col("doc_id") % 7).cast("string")).alias(USER),
        F.when(newline > 0, F.substring_index(text, "\n", 1)).otherwise(text).alias("title"),
        F.when(newline > 0, F.substring(text, newline + 1, F.length(text))).otherwise("").alias("text"),
        F.when(F.col("quality") == 1, "yes").when(F.col("quality") == 0, "no").alias(LABEL),
    )


def posts(spark: SparkSession, sf_dir: str, labelled: bool | None = None) -> DataFrame:
    """Posts with ``normalized``; ``y`` is null without a label."""
    return normalized(prepare_posts(raw_posts(spark, sf_dir, labelled), check=False))


def pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled posts."""
    return posts(spark, sf_dir, True)


def unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts to predict, without label columns."""
    return posts(spark, sf_dir, False).drop(TARGET, LABEL)


def order_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as posts of many users, for splits and folds."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias(TEXT_ID),
        F.col("o_custkey").alias(USER),
        (F.col("o_orderstatus") == "F").cast("int").alias(TARGET),
    )


def order_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as predictions: price decides, price in thousands is a score with ties."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        "o_custkey",
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_orderstatus") == "F").cast("int").alias("y_true"),
        (F.col("o_totalprice") > PRICE_CUT).cast("int").alias("y_pred"),
        F.floor(F.col("o_totalprice") / 1000).cast("double").alias("score"),
        F.col("o_totalprice").alias("price"),
    )


def _catalogue(names: tuple[str, ...], key: Column) -> Column:
    return F.element_at(F.array(*(F.lit(n) for n in names)), (F.pmod(key, F.lit(len(names))) + 1).cast("int"))


def pair_columns(key: str) -> dict[str, Column]:
    """A classifier and a feature configuration for each key value."""
    return {
        "classifier_name": _catalogue(CLASSIFIERS, F.col(key)),
        "feature_config_name": _catalogue(tuple(FEATURES), F.floor(F.col(key) / len(CLASSIFIERS))),
    }


def run_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per customer; a negative balance stands for an unreadable start time."""
    customers = table(spark, sf_dir, "customer")
    last = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max("o_orderdate").alias("last_order")
    )
    started = F.when(F.col("c_acctbal") < 0, "unknown").otherwise(
        F.date_format(F.coalesce("last_order", F.lit("1990-01-01").cast("timestamp_ntz")),
                      "yyyy-MM-dd'T'HH:mm:ss'Z'")
    )
    named = customers.join(last, "c_custkey", "left").withColumns(
        {
            **pair_columns("c_custkey"),
            "experiment_name": F.col("c_mktsegment"),
            "started_at": started,
            "status": F.when(F.col("c_mktsegment") == "MACHINERY", "failed").otherwise("completed"),
        }
    )
    key = run_id(*(F.col(c) for c in ("experiment_name", "classifier_name", "feature_config_name", "started_at")))
    return named.select(
        "c_custkey",
        F.concat_ws("__", key, F.col("c_custkey").cast("string")).alias("run_id"),
        "status",
        "experiment_name",
        "classifier_name",
        "feature_config_name",
        "started_at",
        F.when(F.col("status") == "completed", F.col("started_at")).alias("completed_at"),
        F.abs("c_acctbal").alias("duration_seconds"),
        F.lit(SEED).alias("random_state"),
        F.lit(0.2).alias("validation_size"),
    )


def run_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested metrics of each customer's orders."""
    scored = order_predictions(spark, sf_dir).withColumnRenamed("o_custkey", "c_custkey")
    return metric_record(evaluate(scored, ["c_custkey"]))


def order_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics per pair and fold with customers spread over pairs and folds."""
    scored = order_predictions(spark, sf_dir).withColumns(
        {**pair_columns("o_custkey"), "fold": hash_fold(SEED, F.col("o_custkey"), FOLDS)}
    )
    return evaluate(scored, ["classifier_name", "feature_config_name", "fold"])


def stored_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An answer per post, model and prompt mode; one model makes every kind of mistake.

    Some posts have no stored answer and some have a later one that replaces the first.
    """
    ids = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias(TEXT_ID))
    cells = F.array(
        *(
            F.struct(F.lit(m).alias("model"), F.lit(p).alias("prompt_mode"))
            for m in ANSWER_MODELS
            for p in ANSWER_MODES
        )
    )
    hashed = ids.select(TEXT_ID, F.inline(cells)).withColumn(
        "h", F.md5(F.concat_ws(":", "model", "prompt_mode", TEXT_ID))
    )
    kind = F.when(F.col("model") == ANSWER_MODELS[0], F.substring("h", 1, 1)).otherwise("f")
    label = F.when(F.substring("h", 2, 1) < "8", " YES").otherwise("no")
    score = F.concat(F.lit("0."), F.regexp_replace(F.substring("h", 3, 3), "[a-f]", "7"))

    def answer(label_: Column, score_: Column, evidence: str) -> Column:
        return F.concat(
            F.lit('{"label":"'), label_, F.lit('","score":'), score_,
            F.lit(f',"evidence":{evidence},"justification":" Razón ü "}}'),
        )

    raw = (
        F.when(kind == "0", F.lit("no es json"))
        .when(kind == "1", F.lit('["yes"]'))
        .when(kind == "2", answer(F.lit("maybe"), score, "[]"))
        .when(kind == "3", answer(label, F.lit("1.4"), "[]"))
        .when(kind == "4", answer(label, score, '["a"," ","b ","c","d","e","f"]'))
        .when(kind == "5", F.lit("{}"))
        .when(kind == "6", answer(label, F.concat(F.lit('"'), score, F.lit('"')), '["x"]'))
        .when(kind == "7", answer(label, score, '[1,"x"]'))
        .otherwise(answer(label, score, '["uno"," dos "]'))
    )
    first = hashed.where(kind != "8").select(
        TEXT_ID, "model", "prompt_mode", raw.alias("raw_response"), F.lit(1).alias("seq")
    )
    again = hashed.where(kind.isin("0", "9")).select(
        TEXT_ID, "model", "prompt_mode",
        answer(F.lit("no"), score, '["segunda"]').alias("raw_response"), F.lit(2).alias("seq"),
    )
    return first.unionByName(again)


def embedding_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored vectors as labelled rows of many users."""
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.select(
        F.col("vec_id").cast("string").alias(TEXT_ID),
        (F.col("vec_id") % 50).cast("string").alias(USER),
        "embedding",
        (F.col("label") >= 5).cast("int").alias(TARGET),
    )
