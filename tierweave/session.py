"""Session defaults and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint into the shared folder of ``spark.checkpoint.dir``.

    A folder of our own is used only in local mode with none configured (tests); executors of a
    cluster could not share it, so there the setting is required.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return context.getCheckpointDir()


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the checkpoint folder and read back.

    For loops: unlike a checkpoint it forgets the size estimates and filters of the old plan,
    which otherwise multiply from round to round until planning takes longer than the work.
    """
    path = f"{shared_folder(df.sparkSession)}/stored-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Even partitions for work that costs far more than its bytes suggest."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def global_row_number(df: DataFrame, order: list, name: str = "rn", keep: list[str] | None = None) -> DataFrame:
    """1-based position under a total order, without a single-partition window.

    The frame is range-sorted once and written out; positions inside a partition then only
    need the number of rows in the partitions before it, one small row per partition. With
    ``keep`` only these columns are sorted along, written and returned.
    """
    placed = cut_lineage(df.orderBy(*order).select(*(keep or ["*"])).withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    # one row per partition, so one task is enough for the running sum
    offsets = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    inside = F.col("_at").bitwiseAND((1 << 33) - 1)
    return (
        placed.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_before") + inside + 1).drop("_at", "_part", "_before")
    )


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and single-machine runs."""
    return (
        SparkSession.builder.master(f"local[{cores}]").appName("tierweave")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
