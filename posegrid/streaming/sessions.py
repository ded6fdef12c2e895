"""Tracking sessions: detections and commands of a video, frame by frame.

``Session`` is one video's tracker between two frames.  A frame's detections are
matched to the tracks' boxes; what is left starts tracks with new ids; tracks
that stay unmatched, or follow an earlier track's detections, are removed while
young; boxes that overlap give way to the one occluded longer ago; a track is
confirmed after matches in a row.  Frames leave ``delay`` frames late, so that
what a removed track showed never leaves, and all at the end.

Events are rows (``EVENTS``) of these kinds: ``detection``; ``frame`` (a frame
that may be empty); and the session's commands, which act before the frame's
detections: ``prompt`` (a box that starts a track, or moves the one of its
``obj_id``), ``remove`` (a track goes, and what of it has not left), ``reset`` (tracks, ids
and frames held go) and, after the detections, ``close`` (frames held leave, and
the session is forgotten).  A row of a frame at or before the last one tracked is late: it is
counted and has no effect.

A row leaves (``OUT``) for every shown object, one of kind ``frame`` for every
frame, and one of kind ``closed`` (by command) or ``expired`` (no more events) with the
session's counts.

A track's box comes from a model in practice; here it moves ``follow`` of the
way to its best detection, is replaced by it when reconditioned, and is gone from view
``fade`` frames after the last match.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

EVENTS = (
    "video_id long, frame_idx long, ts timestamp, kind string, k long, obj_id long, score double, "
    "x0 double, y0 double, x1 double, y1 double"
)
OUT = (
    "video_id long, frame_idx long, kind string, obj_id long, score double, x0 double, y0 double, x1 double, y1 double, "
    "emitted_at long, n_late long, n_dropped long"
)
OUT_NAMES = [c.split()[0] for c in OUT.split(", ")]
#: Occlusion times of tracks never occluded and of those just removed.
NEVER, REMOVED = -1, 100_000
#: Rows that leave a table's sessions together.
LEAVING = 10_000
#: The order of a frame's rows.
TURNS = {"reset": 0, "remove": 1, "prompt": 2, "frame": 3, "detection": 3, "close": 4}


@dataclass(frozen=True)
class Rules:
    """Thresholds; the defaults are the tracker's production values."""

    least_score: float = 0.5  # detections below it do not count
    nms: float = 0.1
    assoc: float = 0.1  # a detection this close to a track is not new
    track_assoc: float = 0.5  # a track without a detection this close is unmatched
    new_score: float = 0.7
    most: int = 10_000  # tracks at once
    delay: int = 15
    unmatched: int = 8
    duplicate: int = 8
    alive_start: int = 30
    alive_low: int = -1
    alive_high: int = 30
    suppress_unmatched: bool = False  # hide tracks whose keep-alive has run out
    overlap: float = 0.7  # boxes this alike hide each other
    recondition_every: int = 16
    high: float = 0.8  # score and overlap that recondition asks for
    confirm: int = 0  # matches in a row before a track is shown; 0 shows all
    follow: float = 0.5
    fade: int = 6


@dataclass
class Track:
    first: int
    alive: int
    unmatched: int
    streak: int
    confirmed: bool
    matched_at: int
    occluded: int
    score: float
    x0: float
    y0: float
    x1: float
    y1: float

    @property
    def box(self) -> tuple[float, float, float, float]:
        return self.x0, self.y0, self.x1, self.y1

    def move(self, box: Iterable[float]) -> None:
        self.x0, self.y0, self.x1, self.y1 = map(float, box)


TRACK = (
    "first long, alive long, unmatched long, streak long, confirmed boolean, matched_at long, occluded long, "
    "score double, x0 double, y0 double, x1 double, y1 double"
)
#: A row of a frame held back: an object (no box: not shown), or the frame itself (no object).
HELD = "frame_idx long, obj_id long, score double, x0 double, y0 double, x1 double, y1 double, confirmed boolean"


def overlaps(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Intersection over union of all boxes of two lists."""
    low, high = np.maximum(a[:, None, :2], b[None, :, :2]), np.minimum(a[:, None, 2:], b[None, :, 2:])
    both = np.clip(high - low, 0, None).prod(axis=2)
    area = lambda x: np.clip(x[:, 2:] - x[:, :2], 0, None).prod(axis=1)
    all_of = area(a)[:, None] + area(b)[None, :] - both
    return np.divide(both, all_of, out=np.zeros_like(both), where=all_of > 0)


@dataclass
class Session:
    rules: Rules
    tracks: dict[int, Track] = field(default_factory=dict)
    pairs: dict[tuple[int, int], int] = field(default_factory=dict)
    held: list[tuple] = field(default_factory=list)
    max_id: int = -1
    frame: int = -1
    late: int = 0
    dropped: int = 0

    def advance(self, frame: int, rows: list[tuple]) -> list[tuple]:
        """Take a frame's rows (kind, k, obj_id, score, box); returns what leaves."""
        if frame <= self.frame:
            self.late += len(rows)
            return []
        out: list[tuple] = []
        rows = sorted(rows, key=lambda r: (TURNS[r[0]], r[1] or 0))
        for kind, _, obj_id, score, box in rows:
            if kind == "reset":
                self.tracks, self.pairs, self.held, self.max_id = {}, {}, [], -1
            elif kind == "remove":
                self._forget({obj_id})
            elif kind == "prompt":
                self._prompt(frame, obj_id, 1.0 if score is None else score, box)
        seen = [r for r in rows if r[0] in ("frame", "detection")]
        if seen:
            self._step(frame, [r for r in seen if r[0] == "detection"])
            self.frame = frame
            frames = sum(r[1] is None for r in self.held)
            if frames >= self.rules.delay:
                out += self._leave(1)
        if any(r[0] == "close" for r in rows):
            out += self.end("closed")
        return out

    def end(self, kind: str) -> list[tuple]:
        """All frames leave, then the session's counts; it starts anew after."""
        out = self._leave(len(self.held))
        out.append((self.frame, kind, None, None, None, None, None, None, self.frame, self.late, self.dropped))
        self.tracks, self.pairs, self.held = {}, {}, []
        self.max_id = self.frame = -1
        self.late = self.dropped = 0
        return out

    def empty(self) -> bool:
        return self.frame < 0 and not self.tracks and not self.late

    def _forget(self, gone: set[int]) -> None:
        for obj_id in gone:
            self.tracks.pop(obj_id, None)
        self.pairs = {p: n for p, n in self.pairs.items() if p[0] not in gone and p[1] not in gone}
        self.held = [r for r in self.held if r[1] not in gone]

    def _prompt(self, frame: int, obj_id: int | None, score: float, box: tuple) -> None:
        if obj_id in self.tracks:
            self.tracks[obj_id].move(box)
            self.tracks[obj_id].matched_at = frame
            return
        obj_id = self.max_id + 1 if obj_id is None else obj_id
        self.max_id = max(self.max_id, obj_id)
        self.tracks[obj_id] = Track(frame, self.rules.alive_start, 0, 0, True, frame, NEVER, score, *map(float, box))

    def _kept(self, found: list[tuple]) -> tuple[np.ndarray, np.ndarray]:
        """Scores and boxes of the detections that count, in their order."""
        r = self.rules
        found = [d for d in found if d[3] is not None and d[3] >= r.least_score]
        score, box = np.array([d[3] for d in found]), np.array([d[4] for d in found], dtype=float).reshape(-1, 4)
        like = overlaps(box, box)
        keep: list[int] = []
        for i in np.lexsort((np.arange(len(score)), -score)).tolist():
            if not keep or like[i, keep].max() <= r.nms:
                keep.append(i)
        keep.sort()
        return score[keep], box[keep]

    def _step(self, frame: int, found: list[tuple]) -> None:
        r = self.rules
        score, box = self._kept(found)
        ids = sorted(self.tracks)
        in_view = [i for i in ids if frame - self.tracks[i].matched_at <= r.fade]
        own = np.array([self.tracks[i].box for i in in_view], dtype=float).reshape(-1, 4)
        like = overlaps(box, own)
        close = like >= r.assoc
        fresh = [d for d in range(len(box)) if score[d] >= r.new_score and not close[d].any()]
        room = max(0, r.most - len(ids))
        if len(fresh) > room:
            self.dropped += len(fresh) - room
            fresh = sorted(sorted(fresh, key=lambda d: -score[d])[:room])

        unmatched = {i for k, i in enumerate(in_view) if not (like[:, k] >= r.track_assoc).any()}
        followed = {i for k, i in enumerate(in_view) if close[:, k].any()}
        young = lambda i: self.tracks[i].first > frame - r.delay
        for i in followed:
            self.tracks[i].alive = min(r.alive_high, self.tracks[i].alive + 1)
        gone: set[int] = set()
        for i in unmatched:
            t = self.tracks[i]
            t.unmatched += 1
            t.alive = max(r.alive_low, t.alive - 1)
        gone |= {i for i in ids if self.tracks[i].unmatched >= r.unmatched and young(i)}
        hidden = {i for i in ids if self.tracks[i].unmatched and self.tracks[i].alive <= 0 and i not in gone} if r.suppress_unmatched else set()
        for d in range(len(box)):
            on_it = [i for k, i in enumerate(in_view) if close[d, k]]
            if len(on_it) > 1:
                eldest = min(on_it, key=lambda i: (self.tracks[i].first, i))
                for i in on_it:
                    if i != eldest:
                        self.pairs[eldest, i] = self.pairs.get((eldest, i), 0) + 1
        gone |= {i for (_, i), n in self.pairs.items() if n >= r.duplicate and i in self.tracks and young(i)}

        shown = {i: own[k] for k, i in enumerate(in_view)}
        hidden |= self._occlude(frame, ids, in_view, own, gone)
        for k, i in enumerate(in_view):  # the model's part: boxes follow what they match
            t, d = self.tracks[i], int(like[:, k].argmax()) if len(box) else -1
            if d >= 0 and like[d, k] >= r.track_assoc:
                t.move(own[k] + r.follow * (box[d] - own[k]))
                t.matched_at, t.score = frame, float(score[d])
        if r.recondition_every > 0 and frame % r.recondition_every == 0 and in_view:
            for d in range(len(box)):  # of several detections of a track, the last
                k = int(like[d].argmax())
                if score[d] >= r.high and d not in fresh and like[d, k] >= r.high and self.tracks[in_view[k]].score > r.high:
                    self.tracks[in_view[k]].move(box[d])
        for d in fresh:
            self.max_id += 1
            self.tracks[self.max_id] = Track(frame, r.alive_start, 0, 0, False, frame, NEVER, float(score[d]), *map(float, box[d]))
            shown[self.max_id] = box[d]
            followed.add(self.max_id)
        self._forget(gone)
        self.held.append((frame, None, None, None, None, None, None, None))
        for i, t in self.tracks.items():
            t.streak = t.streak + 1 if i in followed else 0
            t.confirmed = t.confirmed or t.streak >= r.confirm
            at = (None,) * 4 if i in hidden or i not in shown else tuple(map(float, shown[i]))
            self.held.append((frame, i, t.score, *at, t.confirmed))

    def _occlude(self, frame: int, ids: list[int], in_view: list[int], own: np.ndarray, gone: set[int]) -> set[int]:
        """Of two boxes that overlap, the one occluded later is not shown, if
        the other was ever occluded; also notes who is occluded."""
        last = {i: REMOVED if i in gone and self.tracks[i].occluded == NEVER else self.tracks[i].occluded for i in ids}
        hidden: set[int] = set()
        if len(ids) > 1:
            like = overlaps(own, own)
            for a in range(len(in_view)):
                for b in range(len(in_view)):
                    i, j = in_view[a], in_view[b]
                    if a != b and like[a, b] >= self.rules.overlap and last[i] > last[j] > NEVER:
                        hidden.add(i)
        for i in ids:
            if i in hidden or i not in in_view:
                self.tracks[i].occluded = frame
            else:
                self.tracks[i].occluded = last[i]
        return hidden

    def _leave(self, frames: int) -> list[tuple]:
        """The first frames held: an object leaves with its box, if it is
        confirmed some frames later (or on the last frame held)."""
        order = [r[0] for r in self.held if r[1] is None]
        known: dict[int, dict[int, bool]] = {f: {} for f in order}
        for r in self.held:
            if r[1] is not None:
                known[r[0]][r[1]] = r[7]
        ahead = max(0, self.rules.confirm - 1)
        leaving = {f: known[order[min(k + ahead, len(order) - 1)]] for k, f in enumerate(order[:frames])}
        out = []
        for f, obj_id, score, x0, y0, x1, y1, _ in self.held:
            if f not in leaving:
                continue
            if obj_id is None:
                out.append((f, "frame", None, None, None, None, None, None, self.frame, None, None))
            elif x0 is not None and (self.rules.confirm == 0 or leaving[f].get(obj_id, False)):
                out.append((f, "object", obj_id, score, x0, y0, x1, y1, self.frame, None, None))
        self.held = [r for r in self.held if r[0] not in leaving]
        return out


def _packed(t: Track) -> tuple:
    return t.first, t.alive, t.unmatched, t.streak, t.confirmed, t.matched_at, t.occluded, t.score, *t.box


def _number(x):
    return None if x is None or pd.isna(x) else x


class SessionProcessor(StatefulProcessor):
    """A session a video, in state: tracks and pairs by key, pending rows and
    held frames as lists.  A video has one timer, at its first pending frame or,
    without one, ``idle`` seconds after its last; when the watermark has passed it, all frames
    that are whole by then are tracked in order."""

    def __init__(self, rules: Rules, idle: float):
        self.rules, self.idle = rules, int(idle * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", "frame_idx long, at long, kind string, k long, obj_id long, score double, x0 double, y0 double, x1 double, y1 double")
        self.tracks = handle.getMapState("tracks", "obj_id long", TRACK)
        self.pairs = handle.getMapState("pairs", "a long, b long", "n long")
        self.frames = handle.getListState("frames", HELD)
        self.counts = handle.getValueState("counts", "max_id long, frame long, late long, dropped long, last long, timer long")

    def _load(self) -> tuple[Session, int, int]:
        if not self.counts.exists():
            return Session(self.rules), -1, -1
        max_id, frame, late, dropped, last, timer = self.counts.get()
        tracks = {k[0]: Track(*v) for k, v in self.tracks.iterator()} if max_id >= 0 else {}
        pairs = {(k[0], k[1]): v[0] for k, v in self.pairs.iterator()} if tracks else {}
        held = [tuple(r) for r in self.frames.get()] if self.frames.exists() else []
        return Session(self.rules, tracks, pairs, held, max_id, frame, late, dropped), last, timer

    def _save(self, before: dict, session: Session) -> None:
        now = {i: _packed(t) for i, t in session.tracks.items()}
        for i in before["tracks"].keys() - now.keys():
            self.tracks.removeKey((i,))
        for i, t in now.items():
            if before["tracks"].get(i) != t:
                self.tracks.updateValue((i,), t)
        for p in before["pairs"].keys() - session.pairs.keys():
            self.pairs.removeKey(p)
        for p, n in session.pairs.items():
            if before["pairs"].get(p) != n:
                self.pairs.updateValue(p, (n,))
        if session.held:
            self.frames.put(session.held)
        else:
            self.frames.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        names = ["frame_idx", "at", "kind", "k", "obj_id", "score", "x0", "y0", "x1", "y1"]
        whole = lambda x: None if x is None else int(x)
        got = []
        for frame, at, kind, *rest in pd.concat(list(rows))[names].itertuples(index=False):
            k, obj_id, *box = map(_number, rest)
            got.append((int(frame), int(at), kind, whole(k), whole(obj_id), *box))
        held = self.counts.get() if self.counts.exists() else (-1, -1, 0, 0, -1, -1)
        fresh = [r for r in got if r[0] > held[1]]
        late = len(got) - len(fresh)
        last = max([held[4], *(r[1] for r in fresh)])
        first = min((r[1] for r in fresh), default=None)
        timer = held[5]
        if first is not None:
            self.pending.appendList(fresh)
            if timer < 0 or first < timer:
                timer = self._wake(timer, first)
        self.counts.update((held[0], held[1], held[2] + late, held[3], last, timer))
        yield pd.DataFrame([], columns=OUT_NAMES)

    def _wake(self, timer: int, at: int) -> int:
        """One timer a video, at this time."""
        if timer >= 0:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(at)
        return at

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs()
        session, last, _ = self._load()
        before = {"tracks": {i: _packed(t) for i, t in session.tracks.items()}, "pairs": dict(session.pairs)}
        pending = [tuple(r) for r in self.pending.get()] if self.pending.exists() else []
        ready: dict[int, list[tuple]] = {}
        left = []
        for r in pending:
            if r[1] <= now:
                ready.setdefault(r[0], []).append((r[2], r[3], r[4], r[5], r[6:10]))
            else:
                left.append(r)
        out = []
        for frame in sorted(ready):
            out += session.advance(frame, ready[frame])
        if not left and last + self.idle <= now and not session.empty():
            out += session.end("expired")
        if left:
            self.pending.put(left)
        else:
            self.pending.clear()
        if not left and session.empty():
            self._clear()
        else:
            self._save(before, session)
            timer = self._wake(-1, min((r[1] for r in left), default=last + self.idle))
            self.counts.update((session.max_id, session.frame, session.late, session.dropped, last, timer))
        yield pd.DataFrame([(key[0], *r) for r in out], columns=OUT_NAMES)

    def _clear(self) -> None:
        for state in (self.pending, self.tracks, self.pairs, self.frames, self.counts):
            state.clear()

    def close(self) -> None:
        pass


def sessions(events: DataFrame, rules: Rules = Rules(), *, lateness: str = "10 seconds", idle: float = 60.0) -> DataFrame:
    """Track all sessions of a stream or a table of ``EVENTS``.

    A stream needs the RocksDB state store provider; a frame is tracked once the
    watermark (``lateness`` behind the latest event) has passed it.  Rows that
    Spark drops behind the watermark are in the query's progress
    (``dropped_rows``).  A table is sorted by video and frame, spread over tasks
    by video, and holds one frame of one video at a time.
    """
    if events.isStreaming:
        return (
            events.where("video_id is not null and frame_idx is not null and ts is not null")
            .withColumn("at", F.unix_millis("ts"))
            .withWatermark("ts", lateness)
            .groupBy("video_id")
            .transformWithStateInPandas(SessionProcessor(rules, idle), outputStructType=OUT, outputMode="Append", timeMode="EventTime")
        )

    names = ["video_id", "frame_idx", "kind", "k", "obj_id", "score", "x0", "y0", "x1", "y1"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        session, video, frame, rows = Session(rules), None, None, []

        leaving: list[tuple] = []
        plain = lambda x: None if x is None or x != x else x

        def flush(ends: bool) -> None:
            out = session.advance(frame, rows) if rows else []
            if ends and not session.empty():
                out += session.end("expired")
            leaving.extend((video, *r) for r in out)

        for batch in batches:
            for v, f, kind, k, obj_id, *rest in zip(*(batch[c].tolist() for c in names)):
                if (v, f) != (video, frame):
                    if video is not None:
                        flush(v != video)
                    video, frame, rows = int(v), int(f), []
                k, obj_id = (None if plain(x) is None else int(x) for x in (k, obj_id))
                score, *box = map(plain, rest)
                rows.append((kind, k, obj_id, score, tuple(box)))
            if len(leaving) >= LEAVING:  # rows of many frames and videos leave together
                yield pd.DataFrame(leaving, columns=OUT_NAMES)
                leaving.clear()
        if video is not None:
            flush(True)
        if leaving:
            yield pd.DataFrame(leaving, columns=OUT_NAMES)

    parts = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # a number given is not merged by bytes
    sorted_rows = events.where("video_id is not null and frame_idx is not null").repartition(parts, "video_id").sortWithinPartitions("video_id", "frame_idx")
    return sorted_rows.mapInPandas(run, OUT)


STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def start_files(spark: SparkSession, path: str, schema: T.StructType, target: str, *, rules: Rules = Rules(), files: int = 1) -> StreamingQuery:
    """Track the events of a folder's files, ``files`` a batch in the order they
    were written, into Parquet below ``target``, until none is left.  The checkpoint
    is there too: a run that was cut off goes on where it stopped."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
        sink = sessions(stream, rules).writeStream.format("parquet").option("path", f"{target}/rows")
        return sink.option("checkpointLocation", f"{target}/checkpoint").outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(STORE, before)


def run_files(spark: SparkSession, path: str, schema: T.StructType, target: str, **settings) -> DataFrame:
    """As ``start_files``, to the end: the rows that have left."""
    start_files(spark, path, schema, target, **settings).awaitTermination()
    return spark.read.parquet(f"{target}/rows")


def dropped_rows(query) -> int:
    """Rows of a query that came behind the watermark so far."""
    return sum(int(s.get("numRowsDroppedByWatermark", 0)) for p in query.recentProgress for s in p["stateOperators"])


def session_events(sightings: DataFrame) -> DataFrame:
    """``EVENTS`` of a table of sightings (video_id, frame_idx, k, score and box):
    a second a frame, and these commands: the object 1 of every third video is removed at
    frame 20, every fifth video is reset at frame 25, and all but every seventh are closed
    after frame 39."""
    at = lambda f: F.timestamp_seconds(F.lit(1_700_000_000) + f)
    null = lambda kind: F.lit(None).cast(kind)
    found = sightings.select(
        "video_id", "frame_idx", at(F.col("frame_idx")).alias("ts"), F.lit("detection").alias("kind"), "k", null("long").alias("obj_id"),
        "score", "x0", "y0", "x1", "y1",
    )

    def command(videos: DataFrame, frame: int, kind: str, obj_id: int | None) -> DataFrame:
        return videos.select(
            "video_id", F.lit(frame).cast("long").alias("frame_idx"), at(F.lit(frame)).alias("ts"), F.lit(kind).alias("kind"),
            null("long").alias("k"), F.lit(obj_id).cast("long").alias("obj_id"), null("double").alias("score"),
            *[null("double").alias(c) for c in ("x0", "y0", "x1", "y1")],
        )

    videos = sightings.select("video_id").distinct()
    return (
        found.unionByName(command(videos.where("video_id % 3 = 0"), 20, "remove", 1))
        .unionByName(command(videos.where("video_id % 5 = 0"), 25, "reset", None))
        .unionByName(command(videos.where("video_id % 7 <> 0"), 40, "close", None))
    )
