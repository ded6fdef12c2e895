"""The description filter against plain Python over the same JSON."""

import json
import random
import re

import duckdb

from posegrid.operators import entry_queries, references

SF = "/root/testdata/sf0.001"


def test_twin_agrees(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF}/documents.parquet'")
    want = sorted(con.execute(f"select scene_id, entry_id, n_chars from ({entry_queries.oracle_sql()['d01_filter_entries']}) t").fetchall())
    got = sorted(tuple(r) for r in entry_queries.d01_filter_entries(spark, SF).select("scene_id", "entry_id", "n_chars").collect())
    assert got == want and 20 < len(want) < 192


def plain_refs(e, images):
    if e.get("marker_type") != "language_description":
        return []
    md = e.get("marker_data") or {}
    thing = lambda o: str(o.get("entity_type", "object")).strip().lower() in ("", "object")
    stem = {k: str(e.get(f"image_{k}", "")).rpartition("/")[2].rpartition(".")[0] for k in "ab"}
    good = lambda side, o, text: [(stem[side], o.get("ins_id", ""), o.get("label", ""), text.strip())] if stem[side] and o.get("ins_id") and o.get("label") and text.strip() else []
    if "selected_ins_id" in e and "image_a_description" in md:
        label = next((o.get("label", "") for o in e.get("objects", []) if o.get("ins_id") == e["selected_ins_id"]), "")
        return good("a", {"ins_id": e["selected_ins_id"], "label": label}, md["image_a_description"])
    if {"object_1", "object_2"} <= e.keys() and {"image_a_description_1", "image_b_description_2"} <= md.keys():
        return [r for side, k in (("a", 1), ("b", 2)) if thing(e[f"object_{k}"]) for r in good(side, e[f"object_{k}"], md[f"image_{side}_description_{k}"])]
    out = []
    for key, o in e.items():
        m = re.fullmatch(r"(object|region)_(\d+)", key)
        if m and isinstance(o, dict) and thing(o):
            for side in "ab":
                out += good(side, o, md.get(f"image_{side}_description_{m[2]}", ""))
    if out or not isinstance(e.get("objects"), dict):
        return out
    for k in "ABC":
        o = e["objects"].get(k) or {}
        if o and thing(o):
            out += [r for side in "ab" if o.get("ins_id") in images.get(stem[side], {}) for r in good(side, o, md.get(f"description_{k}", ""))]
    return out


def test_filter_equals_plain_python(spark):
    rng = random.Random(5)
    images = {f"i{k}": {str(n): (rng.choice("xy"), rng.choice(["red", "blue", " red ", "green"])) for n in rng.sample(range(12), 5)} for k in range(6)}
    def obj():
        o = {"ins_id": str(rng.randrange(12)), "label": rng.choice("xy")}
        if rng.random() < 0.3:
            o["entity_type"] = rng.choice(["region", "object", "", " Object "])
        return o

    entries = []
    for n in range(300):
        text = lambda: rng.choice(["red", "blue", "green ", "", "other"])
        e = {"marker_type": rng.choice(["language_description"] * 4 + ["white_mask"]), "image_a": f"p/i{rng.randrange(6)}.jpg", "image_b": f"i{rng.randrange(6)}.png"}
        kind = rng.randrange(5)
        if kind == 0:
            o = obj()
            e |= {"selected_ins_id": o["ins_id"], "objects": [obj(), o], "marker_data": {"image_a_description": text()}}
        elif kind == 1:
            e |= {"object_1": obj(), "object_2": obj(), "marker_data": {"image_a_description_1": text(), "image_b_description_2": text()}}
        elif kind == 2:
            e |= {"object_3": obj(), "region_4": obj(), "object_x": obj(), "marker_data": {f"image_{rng.choice('ab')}_description_{k}": text() for k in (3, 4)}}
        elif kind == 3:
            e |= {"objects": {k: obj() for k in rng.sample("ABC", 2)}, "marker_data": {f"description_{k}": text() for k in "ABC"}}
        entries.append((1, n, json.dumps(e), 7))
    seen = [(1, stem, i, label, text) for stem, held in images.items() for i, (label, text) in held.items()]
    odd = [(1, 1000, None, 0), (1, 1001, "not json", 0), (None, 1002, "{}", 0)]
    df = spark.createDataFrame(entries + odd, "scene_id long, entry_id long, entry string, others int")
    table = spark.createDataFrame(seen, "scene_id long, stem string, ins_id string, label string, description string")
    kept = references.filter_entries(df, table, references.greatest_wins)
    assert kept.columns == df.columns
    got = {r.entry_id for r in kept.collect()}
    want, dropped_by = set(), {"same": 0, "model": 0}
    for _, n, text, _ in entries:
        fine = True
        for stem, i, label, said in plain_refs(json.loads(text), images):
            others = [t.strip() for j, (other, t) in images.get(stem, {}).items() if other == label and j != i]
            if others and said in others:
                fine, dropped_by["same"] = False, dropped_by["same"] + 1
            elif others and not all(said > o for o in others):
                fine, dropped_by["model"] = False, dropped_by["model"] + 1
        if fine:
            want.add(n)
    assert got == want | {1000, 1001, 1002} and min(dropped_by.values()) > 10
