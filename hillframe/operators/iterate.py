"""Iterative operators: connected components, flow accumulation. Every round is written to the shared folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a local session gets a checkpoint folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="spark-"))
        folder = spark.sparkContext.getCheckpointDir()
    return f"{folder.rstrip('/')}/hillframe"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write to the folder named by spark.checkpoint.dir and read back: lineage ends there."""
    spark = df.sparkSession
    path = f"{_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def cut_bucketed(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """cut for a table that is met by `keys` again and again: a bucketed table with one file a bucket, so joins and groups by these keys leave its rows where they lie."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"hillframe_{name}_{uuid.uuid4().hex}"
    df.repartition(n, *keys).write.format("parquet").bucketBy(n, *keys).option("path", f"{_folder(spark)}/{table}").saveAsTable(table)
    return spark.table(table)


def cut_dealt(df: DataFrame, name: str) -> DataFrame:
    """cut for tables that are joined round after round: such joins deal out both sides. Even small tables, broadcast in every round, add up at the driver."""
    return cut(df, name).hint("merge")


def cell_id(r: Column, c: Column) -> Column:
    """One long for a cell of a grid of fewer than 2^31 rows and columns: ids stand in row order, and different cells never share one."""
    return F.shiftleft(r.cast("long"), 32) + c.cast("long")


def components(links: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(node, component) for links (u, v): labels take the least label of the neighbours, then the label's own label, until nothing changes."""
    both = cut_dealt(links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "edges")
    label = cut_dealt(both.select(F.col("u").alias("node")).distinct().withColumn("label", F.col("node")), "labels")
    for _ in range(most_rounds):
        near = both.join(label, both["v"] == label["node"]).groupBy("u").agg(F.min("label").alias("near")).hint("merge")
        hooked = label.join(near, label["node"] == near["u"]).select("node", "label", F.least("label", "near").alias("new"))
        # a root whose members saw a smaller label takes it too, so that whole trees hook at once
        root = hooked.groupBy("label").agg(F.min("new").alias("down")).hint("merge")
        hooked = hooked.select("node", "label", "new").join(root.withColumnRenamed("label", "l"), F.col("label") == F.col("l")).select("node", "label", F.least("new", "down").alias("new"))
        jump = hooked.select(F.col("node").alias("n"), F.col("new").alias("jump")).hint("merge")
        nxt = cut_dealt(hooked.join(jump, F.col("new") == F.col("n"), "left").select("node", F.col("label").alias("old"), F.least("new", F.coalesce("jump", "new")).alias("label")), "labels")
        changed = nxt.where("old <> label").limit(1).count()
        label = nxt.select("node", "label")
        if not changed:
            break
    else:
        raise RuntimeError(f"components after {most_rounds} rounds aren't complete")
    return label.withColumnRenamed("label", "component")


def flow_accumulation(receivers: DataFrame, most_rounds: int = 40) -> DataFrame:
    """(cell, acc): cells that drain through each, itself included; receivers: (cell, to), to null at a sink.

    Pointer doubling: each round adds what arrives over 2^k steps and doubles the pointers; log2 of the longest path rounds.
    """
    state = cut(receivers.select("cell", "to", F.lit(1).cast("long").alias("acc")), "flow")
    for turn in range(most_rounds + 1):
        if not state.where("to is not null").limit(1).count():
            break
        if turn == most_rounds:
            raise RuntimeError(f"flow after {most_rounds} rounds isn't complete: receivers form a ring")
        arriving = state.where("to is not null").groupBy(F.col("to").alias("t")).agg(F.sum("acc").alias("more"))
        beyond = state.select(F.col("cell").alias("mid"), F.col("to").alias("next"))
        moved = state.join(arriving, F.col("cell") == F.col("t"), "left").join(beyond, F.col("to") == F.col("mid"), "left")
        state = cut(moved.select("cell", F.col("next").alias("to"), (F.col("acc") + F.coalesce("more", F.lit(0))).alias("acc")), "flow")
    return state.select("cell", "acc")
