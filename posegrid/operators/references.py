"""The filter of ambiguous descriptions: an entry stays if every object that it
refers to by description can be told from the others of its label in that image."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import models

_REF = "struct<image:string,ins_id:string,label:string,description:string,if_seen:boolean>"
_THING = "ins_id string, label string, entity_type string"
#: The marker that refers by description, and the roles of three objects.
BY_WORDS, ROLES = "language_description", ("A", "B", "C")


def _map(text: Column) -> Column:
    return F.from_json(text, "map<string,string>")


def _is_object(thing: Column) -> Column:
    return F.lower(F.trim(F.coalesce(thing["entity_type"], F.lit("object")))).isin("", "object")


def _ref(image: Column, thing: Column, said: Column, if_seen: bool = False) -> Column:
    return F.struct(
        image.alias("image"), thing["ins_id"].alias("ins_id"), thing["label"].alias("label"),
        F.trim(said).alias("description"), F.lit(if_seen).alias("if_seen"),
    ).cast(_REF)


def _whole(refs: Column) -> Column:
    """Those with an image, an id, a label and a text."""
    said = lambda x: F.coalesce(x, F.lit("")) != ""
    return F.filter(refs, lambda r: said(r["image"]) & said(r["ins_id"]) & said(r["label"]) & said(r["description"]))


def references(entries: DataFrame) -> DataFrame:
    """``entries`` (with ``entry``, a JSON text) with ``refs``: what each refers to.

    The first shape that an entry has counts: a selected object; two numbered
    objects, the first in image A and the second in B; numbered objects and regions (of which
    regions are passed over), in the image or images that describe them; three
    objects by role, wherever they are seen.  Entries with another marker, broken ones and null
    ones refer to nothing."""
    top = _map(F.col("entry"))
    rows = entries.withColumns({"_top": top, "_said": _map(top["marker_data"])})
    t, m = F.col("_top"), F.col("_said")
    a, b = t["image_a"], t["image_b"]
    thing = lambda text: F.from_json(text, _THING)

    listed = F.from_json(t["objects"], f"array<struct<{_THING.replace(' ', ':').replace(',:', ',')}>>")
    chosen = F.get(F.filter(listed, lambda o: o["ins_id"] == t["selected_ins_id"]), F.lit(0))
    named = F.named_struct(F.lit("ins_id"), t["selected_ins_id"], F.lit("label"), chosen["label"])
    one = F.array(_ref(a, named, m["image_a_description"]))

    o1, o2 = thing(t["object_1"]), thing(t["object_2"])
    two = F.array_compact(F.array(
        F.when(_is_object(o1), _ref(a, o1, m["image_a_description_1"])), F.when(_is_object(o2), _ref(b, o2, m["image_b_description_2"])),
    ))

    numbered = F.filter(F.map_entries(t), lambda e: e["key"].rlike("^(object|region)_[0-9]+$") & e["value"].startswith("{"))
    number = lambda e: F.substring_index(e["key"], "_", -1)
    described = lambda e, side: F.element_at(m, F.concat(F.lit(f"image_{side}_description_"), number(e)))
    indexed = F.flatten(F.transform(
        F.filter(numbered, lambda e: _is_object(thing(e["value"]))),
        lambda e: F.array(_ref(a, thing(e["value"]), described(e, "a")), _ref(b, thing(e["value"]), described(e, "b"))),
    ))

    roles = _map(F.when(t["objects"].startswith("{"), t["objects"]))
    by_role = F.flatten(F.array(*[
        F.when(roles[k].isNotNull() & _is_object(thing(roles[k])), F.array(*[_ref(image, thing(roles[k]), m[f"description_{k}"], True) for image in (a, b)]))
        .otherwise(F.array().cast(f"array<{_REF}>"))
        for k in ROLES
    ]))

    has = lambda where, *keys: F.coalesce(F.array_size(F.array_intersect(F.map_keys(where), F.array(*map(F.lit, keys)))) == len(keys), F.lit(False))
    some = F.coalesce(F.size(_whole(indexed)) > 0, F.lit(False))
    found = (
        F.when(F.coalesce(t["marker_type"], F.lit("")) != BY_WORDS, F.array().cast(f"array<{_REF}>"))
        .when(has(t, "selected_ins_id") & has(m, "image_a_description"), _whole(one))
        .when(has(t, "object_1", "object_2") & has(m, "image_a_description_1", "image_b_description_2"), _whole(two))
        .when(some, _whole(indexed))
        .otherwise(_whole(by_role))
    )
    return rows.withColumn("refs", F.coalesce(found, F.array().cast(f"array<{_REF}>"))).drop("_top", "_said")


def filter_entries(entries: DataFrame, seen: DataFrame, model: Callable[[], models.Model], *, use_image: bool = True) -> DataFrame:
    """The entries (scene_id, entry_id, entry, ...) that stay, with all their columns.

    ``seen`` has a row (scene_id, stem, ins_id, label, description) for every object
    of every image.  A reference is clear without rivals of its label in the
    image, ambiguous if a rival's text is the same, else the model says KEEP or
    DROP (anything else drops) once for each distinct question; without ``use_image``
    questions of the same texts are one.  (scene_id, entry_id) tells entries apart."""
    with_refs = references(entries)
    stem = F.regexp_replace(F.substring_index("r.image", "/", -1), r"\.[^.]*$", "")
    refs = with_refs.select("scene_id", "entry_id", F.explode("refs").alias("r")).select(
        "scene_id", "entry_id", F.substring_index("r.image", "/", -1).alias("image"), stem.alias("stem"), "r.ins_id", "r.label", "r.description", "r.if_seen"
    )
    ids = F.col("ins_id").cast("string")
    there = seen.select(F.col("scene_id").alias("in_scene"), F.col("stem").alias("in_stem"), ids.alias("in_id")).distinct()
    here = (F.col("scene_id") == F.col("in_scene")) & (F.col("stem") == F.col("in_stem")) & (F.col("ins_id") == F.col("in_id"))
    refs = refs.join(there, here, "left").where("not if_seen or in_id is not null").drop("in_scene", "in_stem", "in_id")
    labelled = seen.groupBy(F.col("scene_id").alias("of_scene"), F.col("stem").alias("of_stem"), F.col("label").alias("of_label")).agg(
        F.collect_list(F.struct(ids.alias("id"), F.trim(F.coalesce("description", F.lit(""))).alias("text"))).alias("held")  # an image's objects
    )
    same = (F.col("scene_id") == F.col("of_scene")) & (F.col("stem") == F.col("of_stem")) & (F.col("label") == F.col("of_label"))
    others = F.transform(F.filter(F.coalesce("held", F.array()), lambda x: x["id"] != F.col("ins_id")), lambda x: x["text"])
    met = refs.join(labelled, same, "left").withColumn("others", F.array_sort(others)).drop("of_scene", "of_stem", "of_label", "held")
    sure = F.when(F.size("others") == 0, F.lit("KEEP")).when(F.array_contains("others", F.col("description")), F.lit("DROP"))
    judged = met.withColumn("sure", sure)
    keys = ["label", "description", "others"] + (["scene_id", "image"] if use_image else [])
    asked = models.decide(judged.where("sure is null").withColumn("others", F.to_json("others")), keys, model)
    said = F.when(F.upper("decision") == "KEEP", F.lit("KEEP")).otherwise(F.lit("DROP"))
    verdicts = judged.where("sure is not null").select("scene_id", "entry_id", "sure").unionByName(asked.select("scene_id", "entry_id", said.alias("sure")))
    bad = verdicts.groupBy(F.col("scene_id").alias("bad_scene"), F.col("entry_id").alias("bad_entry")).agg(F.bool_and(F.col("sure") == "KEEP").alias("fine")).where("not fine")
    kept = entries.join(bad, F.col("scene_id").eqNullSafe(F.col("bad_scene")) & F.col("entry_id").eqNullSafe(F.col("bad_entry")), "left_anti")
    return kept


def greatest_wins() -> models.Model:
    """Offline stand-in: keep a text that comes after all others in order."""
    import json

    return lambda batch: batch.apply(lambda r: "KEEP" if all(r["description"] > o for o in json.loads(r["others"])) else "DROP", axis=1) if len(batch) else batch["description"]
