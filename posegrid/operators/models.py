"""The seam for model calls: distinct keys in, decisions out, joined back.

A model is any function from a batch of requests (pandas columns) to a series
of answers.  Requests are made distinct first, so each key (nulls are keys too) costs one call, and
the answers are checkpointed by the caller if the model is not deterministic.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce
from operator import and_

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Model = Callable[[pd.DataFrame], pd.Series]


def decide(requests: DataFrame, keys: list[str], model: Callable[[], Model], answer: str = "decision") -> DataFrame:
    """Add the model's answer to every row; ``model`` is built once a task."""
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in requests.select(*keys).schema)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask = model()
        for batch in batches:
            yield batch.assign(**{answer: ask(batch)})

    answers = requests.select(*keys).distinct().mapInPandas(run, f"{fields}, `{answer}` string")
    renamed = answers.select(*[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)], answer)
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)))
    return requests.join(renamed, same, "left").drop(*[f"_key{i}" for i in range(len(keys))])


def longest_wins() -> Model:
    """Offline stand-in: keep descriptions of at least twenty characters."""
    return lambda batch: batch["description"].str.len().ge(20).map({True: "KEEP", False: "DROP"})
