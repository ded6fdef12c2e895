"""Scene files as a Python data sink, and the log of scene states.

``write.format("scene_lists")`` writes one JSON list a scene, ``<scene>.json``, in
two phases.  A task streams its scenes' records (clustered by scene) to files of
its own attempt and reports them; only the driver's commit moves them to their names,
so a task that died or ran twice leaves nothing behind, and an abort
removes what the attempts wrote.  A scene that is there already is kept and the new
one dropped, unless ``option("replace", "true")``; a scene that two tasks report is an
error, and nothing is moved.

``RunLog`` keeps scenes' states, pending, running, completed or failed, as an
append-only table: a batch of transitions is checked against the states it was
read with, and takes effect by the exclusive creation of the next numbered
entry; whoever loses that race checks again.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from ..sources.scene_files import file_system


@dataclass
class Written(WriterCommitMessage):
    """What a task attempt has written: (scene, file, records)."""

    scenes: list[tuple[str, str, int]]


class ListWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.root = options["path"].rstrip("/")
        self.replace = options.get("replace", "false").lower() == "true"
        self.run = uuid.uuid4().hex

    def _attempts(self) -> str:
        return f"{file_system(self.root)[1]}/_attempts-{self.run}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        system, _ = file_system(self.root)
        own = f"{self._attempts()}/{uuid.uuid4().hex}"
        out, sink, scene, n = [], None, None, 0
        seen: set[str] = set()

        def finish() -> None:
            if sink is not None:
                sink.write(b"\n]\n" if n else b"]\n")
                sink.close()
                out.append((scene, f"{own}/{len(out)}", n))

        for batch in iterator:
            for name, record in zip(batch.column("scene").to_pylist(), batch.column("record").to_pylist()):
                if name != scene:
                    finish()
                    if name in seen:
                        raise ValueError(f"rows of scene {name} must be together")
                    seen.add(name)
                    system.create_dir(own, recursive=True)
                    scene, n, sink = name, 0, system.open_output_stream(f"{own}/{len(out)}")
                    sink.write(b"[")
                if record is not None:  # a null record stands for a scene without any
                    sink.write((b",\n" if n else b"\n") + record.encode())
                    n += 1
        finish()
        return Written(out)

    def commit(self, messages: list[Written | None]) -> None:
        system, root = file_system(self.root)
        found = [s for m in messages if m for s in m.scenes]
        names = [s[0] for s in found]
        if len(set(names)) != len(names):
            self.abort(messages)
            raise ValueError("a scene's rows came from two tasks; cluster them by scene")
        for scene, path, _ in found:
            target = f"{root}/{scene}.json"
            if self.replace or system.get_file_info(target).type == fs.FileType.NotFound:
                system.move(path, target)
        self._sweep(system)

    def abort(self, messages: list[Written | None]) -> None:
        self._sweep(file_system(self.root)[0])

    def _sweep(self, system: fs.FileSystem) -> None:
        if system.get_file_info(self._attempts()).type == fs.FileType.Directory:
            system.delete_dir(self._attempts())


class SceneLists(DataSource):
    @classmethod
    def name(cls) -> str:
        return "scene_lists"

    def writer(self, schema: StructType, overwrite: bool) -> ListWriter:
        if [f.name for f in schema] != ["scene", "record"]:
            raise ValueError("scene lists take the columns scene and record")
        return ListWriter(dict(self.options))


def write_lists(records: DataFrame, path: str, *order: str, replace: bool = False) -> None:
    """One JSON list a scene of the JSON texts ``record``, in the given order."""
    spark = records.sparkSession
    spark.dataSource.register(SceneLists)
    rows = records.withColumn("scene", F.col("scene").cast("string")).repartition("scene")
    rows = rows.sortWithinPartitions("scene", *order).select("scene", "record")
    rows.write.format("scene_lists").mode("append").option("replace", str(replace)).save(path)


def put_files(files: DataFrame) -> None:
    """Write each row's ``content`` to its ``path``, whole or not at all; a file
    that is written again is replaced by its equal."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                system, name = file_system(path)
                folder, _, last = name.rpartition("/")
                own = f"{folder}/_{last}-{uuid.uuid4().hex}"
                system.create_dir(folder, recursive=True)
                with system.open_output_stream(own) as sink:
                    sink.write(content)
                system.move(own, name)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], type=pa.int64())], names=["n"])

    files.select("path", "content").mapInArrow(run, "n long").agg(F.sum("n")).collect()


#: Lawful transitions: what a scene may become, by its state (None: unknown).
LAWFUL = {None: {"pending"}, "pending": {"pending", "running"}, "running": {"completed", "failed", "pending"}, "failed": {"pending", "running"}, "completed": set()}


class RunLog:
    """States of scenes below ``path``: entries of transitions, numbered."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.system, self.root = file_system(self.path)
        self.system.create_dir(f"{self.root}/commits", recursive=True)

    def _commits(self) -> list[str]:
        infos = self.system.get_file_info(fs.FileSelector(f"{self.root}/commits"))
        return sorted(i.path for i in infos if i.type == fs.FileType.File)

    def _states(self, commits: list[str]) -> DataFrame:
        if not commits:
            return self.spark.createDataFrame([], "scene string, status string, seq long")
        entries = []
        for c in commits:
            with self.system.open_input_file(c) as source:
                entries.append(json.loads(source.read())["entry"])
        rows = self.spark.read.schema("scene string, status string, seq long").parquet(*[f"{self.path}/entries/{e}" for e in entries])
        return rows.groupBy("scene").agg(F.max_by("status", "seq").alias("status"), F.max("seq").alias("seq"))

    def states(self) -> DataFrame:
        """(scene, status, seq): the latest state of every scene."""
        return self._states(self._commits())

    def move(self, scenes: DataFrame, status: str) -> None:
        """Take all ``scenes`` (column scene) to a state, or raise and take none."""
        allowed = [s for s, to in LAWFUL.items() if status in to]
        while True:
            commits = self._commits()
            seq = len(commits)
            known = self._states(commits).select(F.col("scene").alias("of"), F.col("status").alias("was"))
            asked = scenes.select(F.col("scene").cast("string").alias("scene")).distinct()
            joined = asked.join(known, F.col("scene") == F.col("of"), "left")
            fits = F.col("was").isin([s for s in allowed if s]) | (F.col("was").isNull() if None in allowed else F.lit(False))
            wrong = joined.where(~F.coalesce(fits, F.lit(False))).first()
            if wrong:
                raise ValueError(f"scene {wrong['scene']} cannot go from {wrong['was']} to {status}")
            entry = uuid.uuid4().hex
            joined.select("scene", F.lit(status).alias("status"), F.lit(seq).cast("long").alias("seq")).write.parquet(f"{self.path}/entries/{entry}")
            if self._claim(f"{self.root}/commits/{seq:012d}", entry):
                return

    def _claim(self, path: str, entry: str) -> bool:
        """Create a file that is not there; False if somebody else has."""
        body = json.dumps({"entry": entry})
        if isinstance(self.system, fs.LocalFileSystem):
            own = f"{self.root}/_{entry}"
            with open(own, "w") as sink:
                sink.write(body)
            try:
                os.link(own, path)  # whole, and only if there is none
                return True
            except FileExistsError:
                return False
            finally:
                os.unlink(own)
        jvm = self.spark._jvm
        name = jvm.org.apache.hadoop.fs.Path(f"{self.path}{path[len(self.root):]}")
        try:
            sink = name.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(name, False)
        except Exception as error:
            if "AlreadyExists" in str(error):
                return False
            raise
        sink.write(bytearray(body.encode()))
        sink.close()
        return True


def run_scenes(scenes: DataFrame, work: Callable[[DataFrame], DataFrame], path: str, log: RunLog) -> None:
    """Do the scenes that are not completed: ``work`` takes them
    (column scene) and gives (scene, record, pos); a scene without records gets an empty list.

    A run that fails leaves its scenes failed, and the next run takes them again."""
    done = log.states().where("status = 'completed'").select("scene")
    todo = scenes.select(F.col("scene").cast("string").alias("scene")).distinct().join(done, "scene", "left_anti")
    log.move(todo, "pending")
    log.move(todo, "running")
    try:
        made = work(todo).select(F.col("scene").cast("string").alias("scene"), "record", F.col("pos").cast("long").alias("pos"))
        none = todo.select("scene", F.lit(None).cast("string").alias("record"), F.lit(None).cast("long").alias("pos"))
        write_lists(made.unionByName(none), path, "pos")  # null places come first
    except Exception:
        log.move(todo, "failed")
        raise
    log.move(todo, "completed")
