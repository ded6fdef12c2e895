"""Tracks frame by frame, as a keyed stateful stream.

Each object's state holds its first frame, keep-alive, run of matches and
unmatched count; rows of a key are taken in frame order within a batch, and a
frame that is not after the last one seen is dropped (in-order arrival).  Twins
of the results are window plans (``t02``, ``t03``, ``w15``, ``w16``).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: Defaults of the tracker.
DELAY, UNMATCHED, ALIVE_LOW, ALIVE_HIGH, ALIVE_START, CONFIRM = 15, 8, -1, 30, 30, 3
OUT = "obj_id long, frame_idx long, run long, confirmed boolean, alive long, removed boolean"
STATE = "first long, last long, alive long, run long, confirmed boolean, unmatched long, removed boolean"


def step(state: tuple | None, frame: int, matched: bool) -> tuple:
    """One frame of one track: hot-start removal, keep-alive, confirmation."""
    first, _, alive, run, confirmed, unmatched, removed = state or (frame, -1, ALIVE_START, 0, False, 0, False)
    alive = min(ALIVE_HIGH, alive + 1) if matched else max(ALIVE_LOW, alive - 1)
    run = run + 1 if matched else 0
    unmatched += not matched
    removed = removed or (unmatched >= UNMATCHED and first > frame - DELAY)
    return first, frame, alive, run, confirmed or run >= CONFIRM, unmatched, removed


class TrackProcessor(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("track", STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        state = tuple(self.state.get()) if self.state.exists() else None
        out = []
        for frame, matched in pd.concat(list(rows)).sort_values("frame_idx")[["frame_idx", "matched"]].itertuples(index=False):
            if state is not None and frame <= state[1]:
                continue
            state = step(state, int(frame), bool(matched))
            out.append((key[0], int(frame), state[3], state[4], state[2], state[6]))
        if state is not None:
            self.state.update(state)
        yield pd.DataFrame(out, columns=["obj_id", "frame_idx", "run", "confirmed", "alive", "removed"])

    def close(self) -> None:
        pass


def track(frames: DataFrame) -> DataFrame:
    """Rows (obj_id, frame_idx, matched) of a stream or a table to track states.

    Needs the RocksDB state store provider for streams.
    """
    if frames.isStreaming:
        return frames.groupBy("obj_id").transformWithStateInPandas(
            TrackProcessor(), outputStructType=OUT, outputMode="Append", timeMode="None"
        )

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        state, out = None, []
        for obj, frame, matched in rows.sort_values("frame_idx")[["obj_id", "frame_idx", "matched"]].itertuples(index=False):
            state = step(state, int(frame), bool(matched))
            out.append((obj, frame, state[3], state[4], state[2], state[6]))
        return pd.DataFrame(out, columns=["obj_id", "frame_idx", "run", "confirmed", "alive", "removed"])

    return frames.groupBy("obj_id").applyInPandas(run, OUT)
