"""Queries on masks by run sweep and on meshes by components, with twins that
work on pixels and on runs of frames instead."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dialect import Duck, Spark
from ..plans.registry import query, render
from . import components, images, masks, vocabulary


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    return query(spark, render(text, Spark(sf_dir)))


#: Eight masks a frame.
MASKS = "select {frame} as frame_id, vec_id as mask_id, ((vec_id * 37) % 100) / 100e0 as score, counts from rle"
_PIXELS = f"""
    pixels as (
        select frame_id, mask_id, score, unnest(range(stop - len, stop)) as pixel from (
            select frame_id, mask_id, score, p, len, cast(sum(len) over (partition by mask_id order by p) as bigint) as stop from (
                select frame_id, mask_id, score, unnest(range(len(counts))) as p, unnest(counts) as len from ({MASKS.format(frame="vec_id // 8")}) m) e) s
        where p % 2 = 1 and len > 0)"""


def b09_pixel_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each mask keeps where the best score owns a pixel, and which shrink too much."""
    found = masks.non_overlapping(_sql(spark, sf_dir, MASKS.format(frame="vec_id div 8")))
    kept = F.expr("aggregate(counts_left, 0L, (s, c) -> s + c)")
    return found.select("frame_id", "mask_id", "area", "area_left", "shrunk", kept.alias("n_pixels"))


B09 = f"""
    with {_PIXELS},
    owned as (select frame_id, mask_id, row_number() over (partition by frame_id, pixel order by score desc, mask_id) as rn from pixels),
    sums as (select mask_id, count(*) as area from pixels group by 1),
    keeps as (select mask_id, count(*) as area_left from owned where rn = 1 group by 1),
    total as (select vec_id // 8 as frame_id, max(list_sum(counts)) as n_pixels from rle group by 1)
    select m.vec_id // 8 as frame_id, m.vec_id as mask_id, coalesce(s.area, 0) as area, coalesce(k.area_left, 0) as area_left,
        coalesce(k.area_left, 0) / greatest(coalesce(s.area, 0), 1) < 0.3e0 as shrunk, cast(t.n_pixels as bigint) as n_pixels
    from rle m left join sums s on s.mask_id = m.vec_id left join keeps k on k.mask_id = m.vec_id join total t on t.frame_id = m.vec_id // 8"""


def j22_mask_iou_iom(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = masks.mask_pairs(_sql(spark, sf_dir, MASKS.format(frame="vec_id div 8")))
    return found.select("frame_id", "a", "b", "inter", *[F.round(F.col(c) + 1e-9, 6).alias(c) for c in ("iou", "iom")])


J22 = f"""
    with {_PIXELS},
    area as (select mask_id, count(*) as n from pixels group by 1),
    met as (select a.frame_id, a.mask_id as a, b.mask_id as b, count(*) as inter
            from pixels a join pixels b on a.frame_id = b.frame_id and a.pixel = b.pixel and a.mask_id < b.mask_id group by 1, 2, 3)
    select m.frame_id, m.a, m.b, m.inter, round(m.inter / cast(x.n + y.n - m.inter as double) + 1e-9, 6) as iou,
        round(m.inter / cast(least(x.n, y.n) as double) + 1e-9, 6) as iom
    from met m join area x on x.mask_id = m.a join area y on y.mask_id = m.b"""


def a17_mesh_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A strip of triangles along the frames that show an instance: those of
    consecutive frames share an edge.  Clusters of three triangles or more stay."""
    text = """
        select ins_id * 64 + frame_idx as triangle, ins_id * 64 + frame_idx as a, ins_id * 64 + frame_idx + 1 as b, ins_id * 64 + frame_idx + 2 as c
        from observations"""
    return components.clean_mesh(_sql(spark, sf_dir, text), largest=1000, least=3)


A17 = """
    with o as (select ins_id, frame_idx, frame_idx - row_number() over (partition by ins_id order by frame_idx) as island from observations),
    c as (select ins_id, island, min(ins_id * 64 + frame_idx) as cluster, count(*) as size from o group by 1, 2),
    top as (select min(size) as least from (select size from c order by size desc, cluster limit 1000) t)
    select o.ins_id * 64 + o.frame_idx as triangle, c.cluster, c.size
    from o join c on c.ins_id = o.ins_id and c.island = o.island where c.size >= greatest(3, (select least from top))"""

#: Images of eight by eight, and the one after each.
IMAGES = """
    select a.vec_id as image_id, cast(8 as bigint) as width, a.embedding as a, b.embedding as b
    from cam_norms a join cam_norms b on b.vec_id = a.vec_id + 1 where a.vec_id % 2 = 0"""


def m23_ssim_lncc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Likeness of every image of even number to the next one."""
    found = images.image_metrics(_sql(spark, sf_dir, IMAGES))
    rounded = [F.round(c, 6).alias(c) for c in ("ssim", "mse", "lncc", "gradient")]
    return found.select("image_id", "n_unlike", *rounded)


M23 = """
    with e as (select image_id, unnest(range(64)) as p, cast(unnest(a) as double) as a, cast(unnest(b) as double) as b from (
        select a.vec_id as image_id, a.embedding as a, b.embedding as b
        from cam_norms a join cam_norms b on b.vec_id = a.vec_id + 1 where a.vec_id % 2 = 0) i),
    px as (select image_id, p // 8 as y, p % 8 as x, a, b from e),
    g as (select d, exp(-d * d / 4.5e0) / sum(exp(-d * d / 4.5e0)) over () as w from (select unnest(range(-5, 6)) as d) o),
    blurred as (
        select c.image_id, c.y, c.x, sum(gy.w * gx.w * n.a) as ma, sum(gy.w * gx.w * n.b) as mb, sum(gy.w * gx.w * n.a * n.a) as aa,
            sum(gy.w * gx.w * n.b * n.b) as bb, sum(gy.w * gx.w * n.a * n.b) as ab
        from px c join px n on n.image_id = c.image_id and abs(n.y - c.y) <= 5 and abs(n.x - c.x) <= 5
        join g gy on gy.d = n.y - c.y join g gx on gx.d = n.x - c.x group by 1, 2, 3),
    likeness as (
        select image_id, avg((2 * ma * mb + 1e-4) * (2 * (ab - ma * mb) + 9e-4)
            / ((ma * ma + mb * mb + 1e-4) * (aa - ma * ma + bb - mb * mb + 9e-4))) as ssim from blurred group by 1),
    patch as (
        select c.image_id, c.y, c.x, sum(n.a) as sa, sum(n.b) as sb, sum(n.a * n.a) as aa, sum(n.b * n.b) as bb, sum(n.a * n.b) as ab
        from px c join px n on n.image_id = c.image_id and abs(n.y - c.y) <= 1 and abs(n.x - c.x) <= 1
        where c.x between 1 and 6 and c.y between 1 and 6 group by 1, 2, 3),
    local as (
        select image_id, avg(v) as lncc, count(case when v >= 0.9e0 then 1 end) as n_unlike from (
            select image_id, least(2, greatest(0, 1 - (ab - sa * sb / 9) * (ab - sa * sb / 9) / ((aa - sa * sa / 9) * (bb - sb * sb / 9) + 1e-8))) as v
            from patch) t group by 1),
    steep as (
        select c.image_id, greatest(abs(e.a - w.a), abs(s.a - n.a)) as v from px c
        join px e on e.image_id = c.image_id and e.y = c.y and e.x = c.x + 1 join px w on w.image_id = c.image_id and w.y = c.y and w.x = c.x - 1
        join px s on s.image_id = c.image_id and s.x = c.x and s.y = c.y + 1 join px n on n.image_id = c.image_id and n.x = c.x and n.y = c.y - 1),
    gradient as (
        select image_id, (sum((v - low) / (high - low)) + 28) / 64 as gradient from (
            select image_id, v, min(v) over (partition by image_id) as low, max(v) over (partition by image_id) as high from steep) t group by 1),
    off as (select image_id, avg((a - b) * (a - b)) as mse from px group by 1)
    select o.image_id, l.n_unlike, round(k.ssim, 6) as ssim, round(o.mse, 6) as mse, round(l.lncc, 6) as lncc, round(g.gradient, 6) as gradient
    from off o join likeness k on k.image_id = o.image_id join local l on l.image_id = o.image_id join gradient g on g.image_id = o.image_id"""


def b13_error_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where a click corrects the next mask to each mask of even number."""
    text = """
        select a.vec_id as image_id, a.height, a.counts as truth, b.counts as guess
        from rle a join rle b on b.vec_id = a.vec_id + 1 where a.vec_id % 2 = 0"""
    return images.error_points(_sql(spark, sf_dir, text)).withColumn("label", F.col("label").cast("long"))


B13 = """
    with m as (
        select vec_id - vec_id % 2 as image_id, vec_id % 2 as side, unnest(range(stop - len, stop)) as pixel from (
            select vec_id, p, len, cast(sum(len) over (partition by vec_id order by p) as bigint) as stop from (
                select vec_id, unnest(range(len(counts))) as p, unnest(counts) as len from rle) e) s
        where p % 2 = 1 and len > 0),
    size as (select vec_id - vec_id % 2 as image_id, count(*) as n, cast((max(list_sum(counts)) + 39) // 40 as bigint) as width from rle group by 1 having count(*) = 2),
    wrong as (
        select m.image_id, m.pixel // 40 as x, m.pixel % 40 as y, min(m.side) as side from m group by 1, 2, 3 having count(*) = 1),
    grid as (
        select z.image_id, x, y from size z, unnest(range(-1, width + 1)) as a(x), (select unnest(range(-1, 41)) as y) b),
    right_ones as (
        select g.image_id, k.side, g.x, g.y from grid g join (select unnest(range(2)) as side) k on true
        left join wrong w on w.image_id = g.image_id and w.side = k.side and w.x = g.x and w.y = g.y where w.x is null),
    deep as (
        select w.image_id, w.side, w.x, w.y, min((w.x - r.x) * (w.x - r.x) + (w.y - r.y) * (w.y - r.y)) as d2
        from wrong w join right_ones r on r.image_id = w.image_id and r.side = w.side group by 1, 2, 3, 4),
    best as (
        select image_id, side, d2, x, y, row_number() over (partition by image_id order by d2 desc, case when side = 1 then 0 else 1 end, y, x) as rn
        from deep)
    select z.image_id, coalesce(b.x, 0) as x, coalesce(b.y, 0) as y, coalesce(1 - b.side, 0) as label
    from size z left join best b on b.image_id = z.image_id and b.rn = 1"""


def d03_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each frame's prompt (the scene's labels before it) and answer, through the
    model seam; a frame that shows instance numbers divisible by 7 only gets no answer."""
    seen = _sql(spark, sf_dir, "select scene_id, frame_idx, case when ins_id % 7 <> 0 then label end as label from seen")
    frames = seen.groupBy("scene_id", "frame_idx").agg(F.collect_set("label").alias("hint"))
    return vocabulary.vocabulary(frames, vocabulary.sees).select(
        "scene_id", "frame_idx", F.array_join("prompt", ";").alias("prompt"), F.array_join("labels", ";").alias("labels")
    )


D03 = """
    with hits as (select distinct scene_id, frame_idx, label from seen where ins_id % 7 <> 0),
    answers as (
        select scene_id, frame_idx, label from hits
        union select h.scene_id, h.frame_idx, a.label from hits h, (values ('wall'), ('floor'), ('ceiling')) a(label)),
    frames as (select distinct scene_id, frame_idx from seen),
    firsts as (select scene_id, label, min(frame_idx) as at from answers group by 1, 2),
    prompts as (
        select f.scene_id, f.frame_idx, coalesce(string_agg(l.label, ';' order by l.label), '') as prompt
        from frames f left join firsts l on l.scene_id = f.scene_id and l.at < f.frame_idx group by 1, 2),
    said as (select scene_id, frame_idx, string_agg(label, ';' order by label) as labels from answers group by 1, 2)
    select p.scene_id, p.frame_idx, p.prompt, coalesce(s.labels, '') as labels
    from prompts p left join said s on s.scene_id = p.scene_id and s.frame_idx = p.frame_idx"""

_TWINS = {
    b09_pixel_owners: B09, j22_mask_iou_iom: J22, a17_mesh_clusters: A17, m23_ssim_lncc: M23, b13_error_points: B13, d03_vocabulary: D03,
}
QUERIES = {f.__name__: f for f in _TWINS}


def oracle_sql() -> dict[str, str]:
    return {f.__name__: render(text, Duck()) for f, text in _TWINS.items()}
