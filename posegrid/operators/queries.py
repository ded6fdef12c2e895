"""Registered queries of the grouped operators (no SQL twin: order-dependent)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scenes
from ..functions.dialect import Spark
from ..plans.registry import PLANS, query, render
from ..streaming import sessions, tracks
from . import export, groups, models, recipe


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return query(spark, render(text, Spark(sf_dir)))


_BOXES = """
    select scene_id * 100 + frame_idx as group_id, k as box_id, score, cast(x as double) as x0, cast(y as double) as y0,
        cast(x + w as double) as x1, cast(y + h as double) as y1, l_linenumber = 1 as is_track from detections"""


def g01_fuse_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "select ins_id as group_id, l_suppkey % 6 as item_pos, x, y, z from points"
    return groups.fuse_instances(_sql(spark, sf_dir, text))


def g02_fuse_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "select ins_id as group_id, l_suppkey % 6 as item_pos, x, y, z from points"
    return groups.fuse_instances(_sql(spark, sf_dir, text), limit=0.33, every=True, fixpoint=False)


def g05_box_suppression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.suppress(_sql(spark, sf_dir, _BOXES), limit=0.1)


def g06_overlap_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.suppress(_sql(spark, sf_dir, _BOXES), limit=0.3, over="least")


def j20_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.assign_tracks(_sql(spark, sf_dir, _BOXES))


def j15_oriented_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Overlaps of the turned regions of a scene; circles around the boxes in plan
    and their heights bound the candidates."""
    sides = ", ".join(f"{s}.{c} as {c}_{s}" for s in "ab" for c in ("cx", "cy", "cz", "ex", "ey", "ez", "yaw_deg"))
    text = f"""
    select a.ins_id as a, b.ins_id as b, {sides} from regions a join regions b on a.scene_id = b.scene_id and a.ins_id < b.ins_id
    where abs(a.cz - b.cz) <= (a.ez + b.ez) / 2
        and sqrt((a.cx - b.cx) * (a.cx - b.cx) + (a.cy - b.cy) * (a.cy - b.cy))
            <= (sqrt(a.ex * a.ex + a.ey * a.ey) + sqrt(b.ex * b.ex + b.ey * b.ey)) / 2"""
    return groups.oriented_overlaps(_sql(spark, sf_dir, text), least=0.33)


def w18_least_loaded_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The objects of each scene placed on eight slots by number of observations."""
    text = """
    select scene_id as group_id, ins_id as item_id, cast(count(*) as double) as load from observations group by 1, 2"""
    return groups.least_loaded(_sql(spark, sf_dir, text))


def w08_greedy_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.sample_pairs(_sql(spark, sf_dir, "select scene_id, frame_a, frame_b, cov from pairs"))


def t01_track_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tracks.track(_sql(spark, sf_dir, "select obj_id, frame_idx, matched from track_events"))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_events(_sql(spark, sf_dir, "select video_id, frame_idx, k, score, x0, y0, x1, y1 from sightings"))


def t07_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every video's tracking session with its commands, as one table."""
    return sessions.sessions(_events(spark, sf_dir))


def t06_sessions_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same sessions as a stream of files, ten seconds of video a batch, and
    a last event that moves the watermark beyond them."""
    path, n = export.scratch(spark, "events"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    events = _events(spark, sf_dir)
    last = spark.range(1).selectExpr("-1L AS video_id", "0L AS frame_idx", "timestamp_seconds(1800000000) AS ts", "'frame' AS kind")
    for k in range(6):
        part = events.where(F.floor(F.col("frame_idx") / 10) == k) if k < 5 else last.unionByName(events.limit(0), allowMissingColumns=True)
        part.repartition(n if k < 5 else 1).write.mode("append").parquet(path)
    found = sessions.run_files(spark, path, events.schema, export.scratch(spark, "sessions"), files=n)
    return found.where("video_id >= 0")


def d02_model_decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _sql(spark, sf_dir, "select scene_id, stem, ins_id, label, description from descriptions")
    return models.decide(rows, ["scene_id", "stem", "label", "description"], models.longest_wins).drop("description")


def k02_training_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the distances between two objects, by scene in drawn order.  Scenes are
    counted first; then each numbers its own records, which are never shuffled or written."""
    first = export.first_ids(scenes.counted_objects(spark, sf_dir), "scene_id")
    columns = ["scene_id", "frame_a", "frame_b", "label_a", "label_b", *(f"{c}_{s}" for s in "ab" for c in ("cx", "cy", "cz"))]
    qa = scenes.numbered_objects(spark, sf_dir, first, columns).selectExpr(
        "id", "scene_id", "array(concat('f', frame_a), concat('f', frame_b)) as images",
        """concat('In image A, a red mask overlay indicates ', label_a, '.\nIn image B, a green mask overlay indicates ', label_b,
            '.\nHow far apart are the centers of the two objects? Answer with one number, in meters: <answer>NUMBER</answer>.') as question""",
        """concat(cast(cast(round(sqrt((cx_a - cx_b) * (cx_a - cx_b) + (cy_a - cy_b) * (cy_a - cy_b) + (cz_a - cz_b) * (cz_a - cz_b)), 2)
            as decimal(18, 2)) as string), ' m') as answer""",
        "'object_distance' as question_type", "'inter_object_distance' as sub_question_type",
    )
    made = export.conversations(qa, "id", "scene_id")
    return made.select("id", "scene_id", F.to_json(F.struct("conversations", "image")).alias("record"))


def w08_recipe_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame pairs of every group of templates."""
    names = F.array(*[F.lit(g.name) for g in recipe.GROUPS])
    return recipe.sampled_pairs(spark, sf_dir).select(F.get(names, "grp").alias("grp"), "scene_id", "frame_a", "frame_b", F.round("cov", 9).alias("cov"))


def u01_recipe_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The question rows of all templates, on the pairs that the recipe draws."""
    return recipe.question_rows(spark, sf_dir)


def k02_recipe_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training records of all question rows."""
    return recipe.records(recipe.question_rows(spark, sf_dir))


def u01_recipe_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of this name, a template at a time."""
    return recipe.each_template(spark, sf_dir, PLANS["u01_recipe_union"](Spark(sf_dir)), "union")


def a13_type_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plan of this name, a template at a time; rows are counted without their questions."""
    counts = recipe.template_counts(spark, sf_dir).rollup("question_type", "sub_question_type").agg(F.sum("n").alias("n"))
    return counts.select(F.coalesce("question_type", F.lit("*")).alias("type"), F.coalesce("sub_question_type", F.lit("*")).alias("sub"), "n")


def a09_fit_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.fit_boxes(_sql(spark, sf_dir, "select ins_id as group_id, x, y, z from points"))


def a10_principal_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.fit_boxes(_sql(spark, sf_dir, "select ins_id as group_id, x, y, z from points"), principal=True)


def a16_mask_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.mask_stats(_sql(spark, sf_dir, "select vec_id as mask_id, height, counts from rle"))


QUERIES = {
    f.__name__: f
    for f in (
        g01_fuse_instances, g02_fuse_regions, g05_box_suppression, g06_overlap_removal, j15_oriented_overlaps, j20_assignment, w08_greedy_pairs,
        w18_least_loaded_slots,
        t01_track_states, t06_sessions_stream, t07_sessions, d02_model_decisions, k02_training_records, w08_recipe_pairs, u01_recipe_rows, u01_recipe_union, a13_type_rollup, k02_recipe_records, a09_fit_boxes, a10_principal_boxes, a16_mask_components,
    )
}
