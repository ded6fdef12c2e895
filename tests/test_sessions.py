"""Tracking sessions: the stream, the batch and a tracker that keeps all history."""

import random
from collections import defaultdict
from datetime import datetime, timedelta, timezone

import pandas as pd
import pytest

from posegrid.operators import queries
from posegrid.streaming import sessions
from posegrid.streaming.sessions import Rules

SF = "/root/testdata/sf0.001"
BEGIN = datetime(2024, 1, 1, tzinfo=timezone.utc)
HARD = Rules(nms=1.0, delay=4, unmatched=3, duplicate=3, alive_start=2, suppress_unmatched=True, most=7, confirm=3, recondition_every=5, fade=4)


def event(video, frame, kind, k=None, obj=None, score=None, box=(None,) * 4, late=0):
    return (video, frame, BEGIN + timedelta(seconds=frame + late), kind, k, obj, score, *box)


def videos(seed, n_videos=4, n_frames=30):
    """Boxes that drift, vanish, meet and come back, with commands in between."""
    rng, out = random.Random(seed), []
    for v in range(n_videos):
        things = [[rng.uniform(0, 60), rng.uniform(0, 60), rng.uniform(-1, 1), rng.uniform(-1, 1)] for _ in range(6)]
        for f in range(n_frames):
            if rng.random() < 0.05:
                continue  # a frame that never comes
            out.append(event(v, f, "frame"))
            k = 0
            for t in things:
                t[0], t[1] = t[0] + t[2], t[1] + t[3]
                for _ in range(rng.choice((0, 1, 1, 1, 2))):
                    x, y = t[0] + rng.uniform(-2, 2), t[1] + rng.uniform(-2, 2)
                    out.append(event(v, f, "detection", k, None, rng.uniform(0.3, 1), (x, y, x + 20, y + 18)))
                    k += 1
            if rng.random() < 0.08:
                out.append(event(v, f, "remove", None, rng.randrange(5)))
            if rng.random() < 0.08:
                out.append(event(v, f, "prompt", None, rng.choice((None, 1, 40)), None, (5.0, 5.0, 30.0, 30.0)))
            if v == 1 and f == 13:
                out.append(event(v, f, "reset"))
        if v != 2:
            out.append(event(v, n_frames, "close"))
    return out


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0) * max(h, 0)
    return both / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both)


class History:
    """A tracker that keeps every frame's facts and says at the end what left when."""

    def __init__(self, rules):
        self.r, self.obj, self.gone, self.frames, self.shows, self.dropped, self.next = rules, {}, {}, [], [], 0, 0

    def remove(self, i):
        if i in self.obj:
            del self.obj[i]
        self.gone.setdefault(i, []).append(len(self.frames))

    def prompt(self, f, i, box):
        if i in self.obj:
            self.obj[i].update(box=list(box), match=f)
            return
        i = self.next if i is None else i
        self.next = max(self.next, i + 1)
        self.obj[i] = dict(first=f, box=list(box), match=f, score=1.0, miss=0, alive=self.r.alive_start, run=0, ok=True, occ=-1, dup=defaultdict(int))

    def frame(self, f, found):
        r, pos = self.r, len(self.frames)
        found = [d for d in found if d[1] >= r.least_score]
        keep = []
        for n in sorted(range(len(found)), key=lambda n: (-found[n][1], n)):
            if all(iou(found[n][2], found[m][2]) <= r.nms for m in keep):
                keep.append(n)
        found = [found[n] for n in sorted(keep)]
        there = {i: list(o["box"]) for i, o in sorted(self.obj.items()) if f - o["match"] <= r.fade}
        o = self.obj
        fans = [[i for i in there if iou(d[2], there[i]) >= r.assoc] for d in found]
        new = [n for n, d in enumerate(found) if d[1] >= r.new_score and not fans[n]]
        best = sorted(new, key=lambda n: -found[n][1])[: max(0, r.most - len(o))]
        self.dropped += len(new) - len(best)
        new = [n for n in new if n in best]
        matched = {i for fan in fans for i in fan}
        for i in matched:
            o[i]["alive"] = min(r.alive_high, o[i]["alive"] + 1)
        for i in there:
            if not any(iou(d[2], there[i]) >= r.track_assoc for d in found):
                o[i]["miss"] += 1
                o[i]["alive"] = max(r.alive_low, o[i]["alive"] - 1)
        for fan in fans:
            if len(fan) > 1:
                eldest = sorted(fan, key=lambda i: (o[i]["first"], i))[0]
                for i in fan:
                    if i != eldest:
                        o[i]["dup"][eldest] += 1
        young = {i for i in o if f - o[i]["first"] < r.delay}
        gone = {i for i in young if o[i]["miss"] >= r.unmatched or any(n >= r.duplicate and e in o for e, n in o[i]["dup"].items())}
        hide = {i for i in o if r.suppress_unmatched and o[i]["miss"] and o[i]["alive"] <= 0 and i not in gone}
        occ = {i: 100_000 if i in gone and o[i]["occ"] == -1 else o[i]["occ"] for i in o}
        covered = {i for i in there for j in there if i != j and iou(there[i], there[j]) >= r.overlap and occ[i] > occ[j] > -1}
        for i in o:
            o[i]["occ"] = f if i in covered or i not in there else occ[i]
        for i in there:
            if found:
                d = max(found, key=lambda d: iou(d[2], there[i]))
                if iou(d[2], there[i]) >= r.track_assoc:
                    o[i].update(box=[a + r.follow * (b - a) for a, b in zip(there[i], d[2])], match=f, score=d[1])
        if r.recondition_every and f % r.recondition_every == 0 and there:
            for n, d in enumerate(found):
                i = max(there, key=lambda i: (iou(d[2], there[i]), -i))
                if d[1] >= r.high and n not in new and iou(d[2], there[i]) >= r.high and o[i]["score"] > r.high:
                    o[i]["box"] = list(d[2])
        for n in new:
            self.prompt(f, None, found[n][2])
            i = self.next - 1
            o[i].update(score=found[n][1], ok=False)
            there[i] = found[n][2]
            matched.add(i)
        self.frames.append(f)
        for i in gone:
            self.gone.setdefault(i, []).append(pos)
            del o[i]
        facts = {}
        for i in o:
            o[i]["run"] = o[i]["run"] + 1 if i in matched else 0
            o[i]["ok"] = o[i]["ok"] or o[i]["run"] >= r.confirm
            facts[i] = (o[i]["score"], None if i in hide | covered or i not in there else tuple(there[i]), o[i]["ok"])
        self.shows.append(facts)

    def left(self, cut):
        """What has left when the video ends, or is cut off by a reset."""
        out, last = [], len(self.frames) - 1
        for pos, f in enumerate(self.frames):
            when = pos + self.r.delay - 1
            if when > last:
                if cut:
                    continue
                when = last
            out.append((f, "frame", None, None, None, None, None, None, self.frames[when]))
            until = when if pos + self.r.delay - 1 <= last else last + 1
            live = lambda i: not any(pos < g <= until for g in self.gone.get(i, ()))
            ahead = self.shows[min(pos + max(0, self.r.confirm - 1), when)]
            for i, (score, box, _) in self.shows[pos].items():
                if box and live(i) and (not self.r.confirm or (i in ahead and ahead[i][2])):
                    out.append((f, "object", i, score, *box, self.frames[when]))
        return out


def plainly(events, rules):
    by_video = defaultdict(lambda: defaultdict(list))
    for e in events:
        by_video[e[0]][e[1]].append(e)
    out = []
    for v, by_frame in by_video.items():
        t, dropped, closed, last = History(rules), 0, False, -1
        for f in sorted(by_frame):
            rows = by_frame[f]
            if any(e[3] == "reset" for e in rows):
                out += [(v, *x) for x in t.left(True)]
                dropped += t.dropped
                t = History(rules)
            for e in rows:
                if e[3] == "remove":
                    t.remove(e[5])
            for e in rows:
                if e[3] == "prompt":
                    t.prompt(f, e[5], e[7:])
            if any(e[3] in ("frame", "detection") for e in rows):
                t.frame(f, [(e[4], e[6], e[7:]) for e in sorted((e for e in rows if e[3] == "detection"), key=lambda e: e[4])])
                last = f
            closed |= any(e[3] == "close" for e in rows)
        out += [(v, *x) for x in t.left(False)]
        out.append((v, last, "closed" if closed else "expired", None, None, None, None, None, None, last, 0, dropped + t.dropped))
    return out


def comparable(rows):
    rounded = lambda x: round(x, 9) if isinstance(x, float) else x
    return sorted((tuple(rounded(x) for x in tuple(r)[:10]) + (tuple(r)[10:] if r[2] in ("closed", "expired") else ()) for r in rows), key=str)


@pytest.mark.parametrize("rules", [HARD, Rules(delay=6), Rules(nms=1.0, unmatched=2, duplicate=2, confirm=2, delay=3, fade=1)])
def test_table_equals_history(spark, rules):
    events = videos(7)
    got = sessions.sessions(spark.createDataFrame(events, sessions.EVENTS), rules).collect()
    assert comparable(got) == comparable(plainly(events, rules))
    kinds = {r["kind"] for r in got}
    assert kinds == {"object", "frame", "closed", "expired"}


def run_stream(spark, tmp_path, batches, rules, runs=1):
    """Files in order, a micro-batch each, by a number of runs of one checkpoint."""
    schema = spark.createDataFrame([], sessions.EVENTS).schema
    dropped, step = 0, -(-len(batches) // runs)
    for begin in range(0, len(batches), step):
        for rows in batches[begin : begin + step]:
            spark.createDataFrame(rows, sessions.EVENTS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        query = sessions.start_files(spark, str(tmp_path / "in"), schema, str(tmp_path / "out"), rules=rules)
        query.awaitTermination()
        dropped += sessions.dropped_rows(query)
    return spark.read.parquet(str(tmp_path / "out" / "rows")).where("video_id >= 0").collect(), dropped


def shuffled(events, seed, per_batch=9):
    """Batches of some seconds of video each, where rows come up to 7 seconds early or late."""
    rng = random.Random(seed)
    order = sorted(events, key=lambda e: e[1] + rng.uniform(-3.5, 3.5))
    ends = max(e[1] for e in events)
    cuts = defaultdict(list)
    for e in order:
        cuts[min(e[1], ends - 1) // per_batch].append(e)
    for rows in cuts.values():
        rng.shuffle(rows)
    return [cuts[k] for k in sorted(cuts)] + [[event(-1, 10_000, "frame")]]


def test_stream_equals_history_and_goes_on_from_its_checkpoint(spark, tmp_path):
    events = videos(11, 5)
    got, dropped = run_stream(spark, tmp_path, shuffled(events, 1), HARD, runs=2)
    assert dropped == 0 and comparable(got) == comparable(plainly(events, HARD))
    frames = defaultdict(list)
    for r in sorted((r for r in got if r["kind"] == "frame"), key=lambda r: (r["video_id"], r["emitted_at"], r["frame_idx"])):
        frames[r["video_id"]].append(r["frame_idx"])
    for v, seen in frames.items():
        assert seen == sorted(set(seen))
        if v != 1:  # the one that is reset loses the frames it held
            assert seen == sorted({e[1] for e in events if e[0] == v and e[3] == "frame"})


def test_late_rows_are_counted(spark, tmp_path):
    """Behind the watermark Spark drops and counts; a frame sent again is counted by its session."""
    events = [event(0, f, "frame") for f in range(40)] + [event(0, 40, "close")]
    behind = [event(0, 2, "detection", 0, None, 0.9, (0.0, 0.0, 9.0, 9.0))]
    again = [event(0, 3, "detection", 0, None, 0.9, (0.0, 0.0, 9.0, 9.0), late=33)]
    batches = [events[:20], events[20:35], behind + again, events[35:], [event(-1, 10_000, "frame")]]
    got, dropped = run_stream(spark, tmp_path, batches, Rules())
    assert dropped == 1 and [r["n_late"] for r in got if r["kind"] == "closed"] == [1]
    assert not [r for r in got if r["kind"] == "object"] and sum(r["kind"] == "frame" for r in got) == 40


def test_rows_without_a_key_and_none(spark):
    rows = [event(None, 1, "frame"), event(2, 0, "frame")]
    got = sessions.sessions(spark.createDataFrame(rows, sessions.EVENTS)).collect()
    assert [(r["video_id"], r["kind"]) for r in got] == [(2, "frame"), (2, "expired")]
    assert sessions.sessions(spark.createDataFrame([], sessions.EVENTS)).collect() == []


def test_queries_agree(spark):
    table, stream = queries.t07_sessions(spark, SF).collect(), queries.t06_sessions_stream(spark, SF).collect()
    assert len(table) > 2000 and comparable(table) == comparable(stream)


def test_rows_of_many_videos_leave_together(spark, monkeypatch):
    made = []
    frame = pd.DataFrame
    monkeypatch.setattr(sessions.pd, "DataFrame", lambda *args, **named: made.append(1) or frame(*args, **named))
    videos = frame([(v, f, "frame", None, None, None, None, None, None, None) for v in range(30) for f in range(20)],
                   columns=["video_id", "frame_idx", "kind", "k", "obj_id", "score", "x0", "y0", "x1", "y1"])
    run = []

    class Rows:
        """A table whose sessions are run here."""

        isStreaming, sparkSession = False, spark
        where = repartition = sortWithinPartitions = lambda self, *args: self

        def mapInPandas(self, fn, schema):
            run.extend(fn(iter([videos])))

    sessions.sessions(Rows())
    assert len(made) == len(run) == 1 and len(run[0]) == 30 * 21
