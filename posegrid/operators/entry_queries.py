"""The description filter over entries made of documents, with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import references

#: Eight documents an image, eight images a scene; texts that may be alike.
_SEEN = """
    select doc_id {div} 64 as scene_id, concat('img', cast(doc_id {div} 8 as {string})) as stem, doc_id as ins_id, lang as label,
        concat(lang, '-', cast(n_chars % 40 as {string})) as description
    from {documents}"""


def d01_filter_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries by document number modulo 5: a selected object, two objects, an
    object and a region, three by role (two here), another marker."""
    documents = f"parquet.`{sf_dir}/documents.parquet`"
    seen = spark.sql(_SEEN.format(div="div", string="string", documents=documents))
    other = seen.select((F.col("ins_id") - 8).alias("before"), F.col("ins_id").alias("id2"), F.col("label").alias("label2"), F.col("description").alias("text2"))
    rows = seen.join(other, F.col("ins_id") == F.col("before"), "left")
    object_ = lambda i, label, kind=None: F.to_json(F.struct(i.cast("string").alias("ins_id"), label.alias("label"), *([F.lit(kind).alias("entity_type")] if kind else [])))
    mine, theirs = object_(F.col("ins_id"), F.col("label")), object_(F.col("id2"), F.col("label2"))
    shape = F.col("ins_id") % 5
    quoted = lambda text: F.concat(F.lit('"'), text, F.lit('"'))
    pair = lambda key, value: F.concat(F.lit(f'"{key}":'), value)
    body = (
        F.when(shape == 0, F.concat_ws(",", pair("selected_ins_id", quoted(F.col("ins_id").cast("string"))), pair("objects", F.concat(F.lit("["), mine, F.lit("]"))),
                                       pair("marker_data", F.concat(F.lit('{"image_a_description":'), quoted(F.col("description")), F.lit("}")))))
        .when(shape == 1, F.concat_ws(",", pair("object_1", mine), pair("object_2", theirs), pair("marker_data", F.concat(
            F.lit('{"image_a_description_1":'), quoted(F.col("description")), F.lit(',"image_b_description_2":'), quoted(F.col("text2")), F.lit("}")))))
        .when(shape == 2, F.concat_ws(",", pair("object_3", mine), pair("region_4", object_(F.col("id2"), F.col("label2"), "region")), pair("marker_data", F.concat(
            F.lit('{"image_a_description_3":'), quoted(F.col("description")), F.lit(',"image_b_description_4":'), quoted(F.col("text2")), F.lit("}")))))
        .otherwise(F.concat_ws(",", pair("objects", F.concat(F.lit('{"A":'), mine, F.lit(',"B":'), theirs, F.lit("}"))), pair("marker_data", F.concat(
            F.lit('{"description_A":'), quoted(F.col("description")), F.lit(',"description_B":'), quoted(F.col("text2")), F.lit("}")))))
    )
    marker = F.when(shape == 4, "2d_bbox").otherwise(references.BY_WORDS)
    next_stem = F.concat(F.lit("img"), (F.floor(F.col("ins_id") / 8) + 1).cast("string"))
    images = F.concat(F.lit('"image_a":"x/'), F.col("stem"), F.lit('.jpg","image_b":"x/'), next_stem, F.lit('.jpg"'))
    whole = F.concat(F.lit("{"), pair("marker_type", quoted(marker)), F.lit(","), images, F.lit(","), body, F.lit("}"))
    entries = rows.where("id2 is not null").select("scene_id", F.col("ins_id").alias("entry_id"), whole.alias("entry"))
    kept = references.filter_entries(entries, seen, references.greatest_wins)
    return kept.select("scene_id", "entry_id", F.length("entry").cast("long").alias("n_chars"))


D01 = """
    with s as ({seen}),
    e as (select a.*, b.ins_id as id2, b.label as label2, b.description as text2, b.scene_id as scene2,
              concat('img', cast(a.ins_id // 8 + 1 as varchar)) as next_stem
          from s a join s b on b.ins_id = a.ins_id + 8),
    refs as (
        select scene_id, ins_id as entry_id, stem, ins_id, label, description from e where ins_id % 5 in (0, 1, 2, 3)
        union all
        select scene_id, ins_id, next_stem, id2, label2, text2 from e where ins_id % 5 = 1 or (ins_id % 5 = 3 and scene2 = scene_id)),
    judged as (
        select r.scene_id, r.entry_id, count(o.ins_id) as n, max(o.description) as last, max(r.description) as own
        from refs r left join s o on o.scene_id = r.scene_id and o.stem = r.stem and o.label = r.label and o.ins_id <> r.ins_id
        group by r.scene_id, r.entry_id, r.ins_id),
    bad as (select distinct entry_id from judged where n > 0 and own <= last)
    select e.scene_id, e.ins_id as entry_id, cast(case e.ins_id % 5
            when 0 then length('"selected_ins_id":"","objects":[{{"ins_id":"","label":""}}],"marker_data":{{"image_a_description":""}}')
                + 2 * length(cast(e.ins_id as varchar)) + length(e.label) + length(e.description)
            when 1 then length('"object_1":{{"ins_id":"","label":""}},"object_2":{{"ins_id":"","label":""}},"marker_data":{{"image_a_description_1":"","image_b_description_2":""}}')
                + length(concat(e.ins_id, e.id2, e.label, e.label2, e.description, e.text2))
            when 2 then length('"object_3":{{"ins_id":"","label":""}},"region_4":{{"ins_id":"","label":"","entity_type":"region"}},"marker_data":{{"image_a_description_3":"","image_b_description_4":""}}')
                + length(concat(e.ins_id, e.id2, e.label, e.label2, e.description, e.text2))
            else length('"objects":{{"A":{{"ins_id":"","label":""}},"B":{{"ins_id":"","label":""}}}},"marker_data":{{"description_A":"","description_B":""}}')
                + length(concat(e.ins_id, e.id2, e.label, e.label2, e.description, e.text2)) end
        + length('{{"marker_type":"","image_a":"x/.jpg","image_b":"x/.jpg",}}') + length(case when e.ins_id % 5 = 4 then '2d_bbox' else 'language_description' end)
        + length(e.stem) + length(e.next_stem) as bigint) as n_chars
    from e where not exists (select 1 from bad b where b.entry_id = e.ins_id)"""

QUERIES = {"d01_filter_entries": d01_filter_entries}


def oracle_sql() -> dict[str, str]:
    return {"d01_filter_entries": D01.format(seen=_SEEN.format(div="//", string="varchar", documents="documents"))}
