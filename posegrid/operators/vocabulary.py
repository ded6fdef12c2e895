"""A scene's vocabulary, frame after frame: each prompt holds what was answered before."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T

#: Labels that every answered frame has.
ALWAYS = ("wall", "floor", "ceiling")
#: From a frame's row and the labels before it to the model's text; None if it fails.
Model = Callable[[pd.Series, list[str]], str | None]


def parse(text: str) -> list[str]:
    """Labels of an answer: pieces between commas, semicolons and line ends, with
    letters, blanks and dashes only; else all its words."""
    pieces = [re.sub(r"[^a-zA-Z\s-]", "", p).strip().lower() for p in re.split("[,;\n]", text)]
    return [p for p in pieces if p] or re.findall("[a-z]+", text.lower())


def vocabulary(frames: DataFrame, model: Callable[[], Model]) -> DataFrame:
    """(scene_id, frame_idx, prompt, labels) for every frame (and any columns
    the model needs): the labels answered before, sorted, and this frame's.

    A scene's frames go through one task in order, which holds the scene's labels and a batch of rows;
    a model that fails gives no labels and the scene goes on."""
    schema = T.StructType([
        frames.schema["scene_id"], frames.schema["frame_idx"],
        T.StructField("prompt", T.ArrayType(T.StringType())), T.StructField("labels", T.ArrayType(T.StringType())),
    ])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask, scene, known = model(), None, set()
        for batch in batches:
            out = []
            for row in batch.to_dict("records"):
                if row["scene_id"] != scene:
                    scene, known = row["scene_id"], set()
                prompt = sorted(known)
                answer = ask(row, prompt)
                labels = sorted({*parse(answer), *ALWAYS}) if answer is not None else []
                known.update(labels)
                out.append((scene, row["frame_idx"], prompt, labels))
            yield pd.DataFrame(out, columns=["scene_id", "frame_idx", "prompt", "labels"])

    ordered = frames.where("scene_id is not null").repartition("scene_id").sortWithinPartitions("scene_id", "frame_idx")
    return ordered.mapInPandas(run, schema)


def scene_vocabulary(answered: DataFrame) -> DataFrame:
    """(scene_id, categories): all labels of a scene, with those that every scene has."""
    from pyspark.sql import functions as F

    found = answered.select("scene_id", F.explode_outer("labels").alias("label")).groupBy("scene_id").agg(F.collect_set("label").alias("held"))
    return found.select("scene_id", F.array_sort(F.array_union("held", F.array(*map(F.lit, ALWAYS)))).alias("categories"))


def sees() -> Model:
    """Offline stand-in: names what the frame's column ``hint`` holds, new things
    first; fails where there is none."""

    def ask(row: pd.Series, prompt: list[str]) -> str | None:
        if row["hint"] is None or not len(row["hint"]):
            return None
        return ", ".join(sorted(row["hint"], key=lambda x: (x in prompt, x)))

    return ask
