"""Shared plumbing: shared scratch folder, ordered partitions, Arrow maps."""

from __future__ import annotations

import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Widest block of text handled at once inside a Python worker, in code points.
BLOCK_CHARS = 1 << 19


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder (spark.checkpoint.dir).

    A folder of our own is made only where the setting is absent and Spark runs
    on this machine alone, as in tests; elsewhere a missing setting is an error.
    """
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        conf = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        held = spark.sparkContext._jsc.sc().getCheckpointDir()
        if held.isDefined():
            return held.get()
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        conf = os.path.join(tempfile.gettempdir(), "posegrid-checkpoints")
    return conf


def unused(name: str, *frames: DataFrame) -> str:
    """The name, or a longer one that no column of these tables has."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name += "_"
    return name


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the shared folder."""
    spark = df.sparkSession
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(shared_dir(spark))
    return df.checkpoint()


def scratch(spark: SparkSession, what: str) -> str:
    """A new path for one run's table or files in the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/posegrid-{what}-{uuid.uuid4().hex}"


_HELD: dict[tuple, object] = {}


def held(key: tuple | None, build: Callable[[], object] | None = None) -> object:
    """One large object a Python worker keeps from task to task.

    Workers outlive operators: asking for another one, or for none, gives the
    memory of the last one back to the system.
    """
    if key not in _HELD and _HELD:
        _HELD.clear()
        _trim()
    if key is not None and key not in _HELD:
        _HELD[key] = build()
    return _HELD.get(key)


def _trim() -> None:
    gc.collect()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def blocks(sizes: list[int], limit: int = BLOCK_CHARS) -> Iterator[slice]:
    """Slices of consecutive rows whose sizes sum to about ``limit``."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield slice(start, len(sizes))


def map_blocks(
    df: DataFrame,
    make: Callable[[], Callable[[dict[str, list]], dict[str, list]]],
    schema: str,
    text: str = "text",
    keeps: bool = False,
) -> DataFrame:
    """Apply a column-wise function to blocks of rows of bounded text size.

    ``make`` builds the function once per Python worker task; it takes and
    returns plain lists by column.  The input's columns arrive as they are.
    ``keeps`` says that ``make`` asks for an object by ``held``.
    """
    out_type = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            held(None)
        fn = make()
        for batch in batches:
            at = batch.schema.get_field_index(text)
            column = batch.column(at)
            sizes = [0 if n is None else n for n in pa.compute.utf8_length(column).to_pylist()]
            for part in blocks(sizes):
                piece = batch.slice(part.start, part.stop - part.start)
                cols = {n: piece.column(i).to_pylist() for i, n in enumerate(piece.schema.names)}
                got = fn(cols)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(got[f.name], type=f.type) for f in arrow], schema=arrow
                )

    import pyarrow.compute  # noqa: F401  (binds pa.compute for the closure)

    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, make: Callable[[], Callable[[list], list[bool]]], text: str = "text") -> DataFrame:
    """Keep the rows for which a function of the text column's values says so;
    all columns pass through.  ``make`` is as in ``map_blocks``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        fn = make()
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            sizes = [n or 0 for n in pa.compute.utf8_length(column).to_pylist()]
            for part in blocks(sizes):
                piece = batch.slice(part.start, part.stop - part.start)
                keep = fn(column.slice(part.start, part.stop - part.start).to_pylist())
                yield piece.filter(pa.array(keep, type=pa.bool_()))

    import pyarrow.compute  # noqa: F401

    return df.mapInArrow(run, df.schema)


def edit_rows(df: DataFrame, fn: Callable[[list, list], tuple[list, list[bool]]], text: str, by: str) -> DataFrame:
    """Replace a text column, block by block, and drop rows.

    ``fn`` takes the texts and the values of the last column, ``by``, and gives
    the new texts and whether each row stays.  All columns but ``by`` pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held(None)
        for batch in batches:
            at, last = batch.schema.get_field_index(text), batch.num_columns - 1
            sizes = [n or 0 for n in pa.compute.utf8_length(batch.column(at)).to_pylist()]
            for part in blocks(sizes):
                piece = batch.slice(part.start, part.stop - part.start)
                texts, keep = fn(piece.column(at).to_pylist(), piece.column(last).to_pylist())
                columns = [pa.array(texts, type=c.type) if i == at else c for i, c in enumerate(piece.columns[:last])]
                whole = pa.RecordBatch.from_arrays(columns, schema=pa.schema(list(piece.schema)[:last]))
                yield whole.filter(pa.array(keep, type=pa.bool_()))

    import pyarrow.compute  # noqa: F401

    return df.mapInArrow(run, df.drop(by).schema)
