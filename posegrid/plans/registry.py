"""Relational plans by name: SQL written once, rendered for two engines."""

from __future__ import annotations

import re
import threading
import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions import draws
from ..functions.dialect import Duck, Spark

Text = Callable[[Spark], str]
PLANS: dict[str, Text] = {}
VIEWS: dict[str, Text] = {}


#: Views that DuckDB works out once: numbered rows that are joined to themselves.
MATERIALIZED = frozenset({"detections"})


def plan(fn: Text) -> Text:
    PLANS[fn.__name__] = fn
    return fn


def view(fn: Text) -> Text:
    VIEWS[fn.__name__] = fn
    return fn


#: Relations that Python makes of a folder's tables, for a text of Spark's; they may
#: leave out columns that the text does not name.
Made = Callable[..., DataFrame]
DERIVED: dict[str, Made] = {}
_FOLDERS: dict[str, tuple[str, str]] = {}
_NAMING = threading.RLock()


def derived(fn: Made) -> Made:
    DERIVED[fn.__name__] = fn
    return fn


def relation(name: str, d: Spark) -> str:
    """What a text calls a derived relation of its folder."""
    called = f"{name}_{zlib.crc32(d.sf_dir.encode()):08x}"
    _FOLDERS[called] = name, d.sf_dir
    return called


def render(text: str, d: Spark, given: dict[str, str] | None = None) -> str:
    """Put the views that a text names (and those that they name) before it;
    ``given`` has other texts for some views."""
    needed: dict[str, str] = {}
    given = given or {}

    def visit(sql: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b(from|join|,)\s+{name}\b", sql, re.I):
                body = given[name] if name in given else VIEWS[name](d)
                visit(body)
                needed[name] = body

    visit(text)
    if not needed:
        return text
    kept = {name: " materialized" for name in MATERIALIZED} if d.name == "duck" else {}
    views = ",\n".join(f"{name} as{kept.get(name, '')} ({body})" for name, body in needed.items())
    if re.match(r"\s*with\s", text, re.I):
        return f"with {views},\n" + re.sub(r"^\s*with\s", "", text, flags=re.I)
    return f"with {views}\n{text}"


#: Columns that are ranks or frame numbers: 64 bits wide in both engines.
NUMBERS = frozenset(
    "label_no frame nn_frame rank det track a b before after frame_a frame_b frame_idx frame_no id fa fb rn last_draw value slot "
    "removed_at confirmed_at suppressed turn memory_frame emitted best".split()
)


def widened(df: DataFrame) -> DataFrame:
    narrow = [c for c, kind in df.dtypes if c in NUMBERS and kind == "int"]
    return df.withColumns({c: df[c].cast("bigint") for c in narrow}) if narrow else df


def query(spark: SparkSession, text: str) -> DataFrame:
    """A rendered text as a DataFrame, with the draws that it may name."""
    if "draw_triples(" in text or "draw_couples(" in text:
        draws.register(spark)
    with _NAMING:  # a relation has the columns of the text that it is made for
        for called, (name, sf_dir) in list(_FOLDERS.items()):
            if re.search(rf"\b{called}\b", text):
                DERIVED[name](spark, sf_dir, text).createOrReplaceTempView(called)
        return spark.sql(text)


def run(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def planned(spark: SparkSession, sf_dir: str) -> DataFrame:
        d = Spark(sf_dir)
        return widened(query(spark, render(PLANS[name](d), d)))

    planned.__name__ = name
    return planned


def twin(name: str) -> str:
    d = Duck()
    return render(PLANS[name](d), d)
