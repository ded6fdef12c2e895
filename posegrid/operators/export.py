"""Sinks: scene files, training records with dense ids, resumable writes."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).  One of
    our own is taken only under a local master, where the setting may be absent."""
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir", None)
    if not shared and context._jsc.sc().getCheckpointDir().isDefined():
        shared = context._jsc.sc().getCheckpointDir().get()
    if not shared:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        shared = os.path.join(tempfile.gettempdir(), "posegrid-checkpoints")
    return shared


def scratch(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/posegrid-{what}-{uuid.uuid4().hex}"


def _settled(rows: DataFrame) -> DataFrame:
    """A checkpoint in the shared folder: what is read twice is then the same
    both times."""
    context = rows.sparkSession.sparkContext
    if not context._jsc.sc().getCheckpointDir().isDefined():
        context.setCheckpointDir(shared_dir(rows.sparkSession))
    return rows.checkpoint()


def dense_ids(rows: DataFrame, *order: str, name: str = "id") -> DataFrame:
    """Ids 0 .. n-1 in a global order, without a single-task sort: rows are
    ranged, numbered inside each range, and shifted by the ranges before it
    (one count a partition)."""
    ranged = _settled(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    inside = ranged.withColumn("_n", F.row_number().over(Window.partitionBy("_part").orderBy(*order)))
    sizes = ranged.groupBy("_part").agg(F.count("*").alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_shift"))
    return inside.join(shift, "_part").withColumn(name, F.col("_shift") + F.col("_n") - 1).drop("_part", "_n", "_shift")


def first_ids(sizes: DataFrame, key: str, n: str = "n", name: str = "first") -> DataFrame:
    """(key, first): how many rows the keys before have, of a count a key; as ``dense_ids``,
    but no row is numbered, ranged or written for it."""
    ranged = _settled(sizes.repartitionByRange(key).withColumn("_part", F.spark_partition_id()))
    earlier = (Window.unboundedPreceding, -1)
    inside = ranged.withColumn("_in", F.coalesce(F.sum(n).over(Window.partitionBy("_part").orderBy(key).rowsBetween(*earlier)), F.lit(0)))
    parts = ranged.groupBy("_part").agg(F.sum(n).alias("_size"))
    shift = parts.select("_part", F.coalesce(F.sum("_size").over(Window.orderBy("_part").rowsBetween(*earlier)), F.lit(0)).alias("_shift"))
    return inside.join(F.broadcast(shift), "_part").select(key, (F.col("_shift") + F.col("_in")).cast("long").alias(name))


def conversations(qa: DataFrame, *keys: str) -> DataFrame:
    """Records without ids, and the keys given."""
    prompt = F.concat(F.repeat(F.lit("<image>\n"), F.size("images")), F.col("question"))
    turns = F.array(
        F.struct(F.lit("human").alias("from"), prompt.alias("value")),
        F.struct(F.lit("gpt").alias("from"), F.col("answer").alias("value")),
    )
    return qa.select(*keys, turns.alias("conversations"), F.col("images").alias("image"), "question_type", "sub_question_type")


def training_records(qa: DataFrame) -> DataFrame:
    """Conversation records: a human turn with one image tag a line, the answer,
    and the image list.  Takes scene_id, pos, images, question, answer, types."""
    return dense_ids(conversations(qa, "scene_id", "pos"), "scene_id", "pos")


def write_jsonl(records: DataFrame, path: str) -> None:
    names = [c for c in records.columns if c not in ("scene_id", "pos", "id")]
    records.orderBy("id").select(F.to_json(F.struct("id", *names)).alias("value")).write.mode("overwrite").text(path)


def write_scenes(rows: DataFrame, path: str, spark: SparkSession | None = None) -> None:
    """Append the scenes that the target does not hold yet, a folder a scene."""
    spark = spark or rows.sparkSession
    try:
        done = spark.read.parquet(path).select("scene_id").distinct()
        rows = rows.join(done, "scene_id", "left_anti")
    except Exception as error:  # an empty or absent target holds none
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    rows.repartition("scene_id").write.mode("append").partitionBy("scene_id").parquet(path)


def latest_status(log: DataFrame) -> DataFrame:
    """The state of each item of a run log (item, seq, status)."""
    return log.groupBy("item").agg(F.max_by("status", "seq").alias("status"))
