"""Tables between the steps of a job, written to the folder that all executors share, and pointers followed over them."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """spark.checkpoint.dir; a local session without it gets a temporary folder, a cluster without it an error."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not at:
        set_ = spark.sparkContext._jsc.sc().getCheckpointDir()
        if set_.isDefined():
            at = set_.get()
        elif re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            at = "file://" + tempfile.mkdtemp(prefix="ledgerflow-")
        else:
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table of its own: what is read again is the same each time, and lineage ends."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def roots(pointers: DataFrame, max_rounds: int = 64) -> DataFrame:
    """(node, root) of every row of ``pointers`` (node, parent), where a node without a parent is its own root.

    Each round a node takes its pointer's pointer, so rounds grow with the logarithm of a
    chain. Only nodes whose pointer moved go on; pointers in a circle raise. ``pointers`` is
    read more than once and should be cheap to read.
    """
    going = pointers.where("parent is not null").select("node", F.col("parent").alias("at"))
    alone = pointers.where("parent is null").select("node", F.col("node").alias("root"))
    done: list[DataFrame] = []
    for _ in range(max_rounds):
        known = reduce(DataFrame.unionByName, done, going)
        up = known.select(F.col("node").alias("at"), F.col("at").alias("up"))
        step = written(going.join(up, "at", "left").select("node", F.coalesce("up", "at").alias("at"), F.col("up").isNotNull().alias("moved")), "pointers")
        done.append(step.where("not moved").select("node", "at"))
        going = step.where("moved").select("node", "at")
        if step.where("moved").isEmpty():
            return reduce(DataFrame.unionByName, (d.select("node", F.col("at").alias("root")) for d in done), alone)
    raise RuntimeError(f"pointers did not end after {max_rounds} rounds")
