"""Session helpers: table loading, checkpoints in the shared folder, scan spreading."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data directory."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Operators of a logical plan that shuffle.
WIDE = frozenset(
    "Aggregate CoGroup Deduplicate Distinct Except FlatMapCoGroupsInArrow FlatMapCoGroupsInPandas FlatMapGroupsInArrow FlatMapGroupsInPandas GlobalLimit "
    "Intersect Join RebalancePartitions Repartition RepartitionByExpression Sort Window".split()
)


def _is_wide(df: DataFrame) -> bool:
    """Whether any operator of the analysed plan shuffles."""
    stack = [df._jdf.queryExecution().analyzed()]
    while stack:
        plan = stack.pop()
        if plan.nodeName() in WIDE:
            return True
        children = plan.children()
        stack += [children.apply(i) for i in range(children.size())]
    return False


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give a scan at least as many partitions as there are task slots.

    A table of many splits is returned unchanged; one of few row groups is
    hashed on ``keys`` so that heavy per-row work uses every core.
    """
    # A stream has no partitions yet, and asking a plan that shuffles for its own would run it.
    if df.isStreaming or _is_wide(df):
        return df
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= slots:
        return df
    return df.repartition(2 * slots, *keys)


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``; only where it is unset (tests) set one."""
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="inkwell-")
        atexit.register(shutil.rmtree, configured, True)
    context.setCheckpointDir(configured)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
