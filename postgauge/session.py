"""Session settings and the one place where lineage is cut."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(name: str = "postgauge", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the options the jobs here rely on; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    options = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.variant.allowDuplicateKeys": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    for key, value in options.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: a
    folder on one machine would not survive the loss of that machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    shared = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if shared is None:
        if not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder all executors share")
        shared = tempfile.mkdtemp(prefix="postgauge-checkpoint-")
    context.setCheckpointDir(shared)


def settle(frame: DataFrame) -> DataFrame:
    """Store a result that several later jobs read, so none of them repeats its work."""
    ensure_checkpoint_dir(frame.sparkSession)
    return frame.checkpoint(eager=True)


def settle_alone(frame: DataFrame) -> DataFrame:
    """As ``settle``; the shuffle files behind the result go as soon as it is stored.

    Otherwise they stay until the driver happens to collect its garbage, so jobs of many small
    steps pile up the files of all of them. A plan is told so when it is made, hence the select.
    """
    conf = frame.sparkSession.conf
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return settle(frame.select("*"))
    finally:
        conf.set(name, before)
