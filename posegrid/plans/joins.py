"""Joins over scenes, frames, instances and masks."""

from __future__ import annotations

import zlib

from ..functions.dialect import Spark
from .registry import plan, relation, view


def inside(p: str, box: str) -> str:
    """Whether the centre of ``p`` lies in the oriented box (yaw about z)."""
    c, s = f"cos(radians({box}.yaw_deg))", f"sin(radians({box}.yaw_deg))"
    dx, dy = f"({p}.cx - {box}.cx)", f"({p}.cy - {box}.cy)"
    return (
        f"(abs({c} * {dx} + {s} * {dy}) <= {box}.ex / 2 + 1e-6 and abs({c} * {dy} - {s} * {dx}) <= {box}.ey / 2 + 1e-6 "
        f"and abs({p}.cz - {box}.cz) <= {box}.ez / 2 + 1e-6)"
    )


def shuffled(d: Spark, op: str, *keys: str) -> str:
    """The order of a seeded draw: equal on any engine and partitioning."""
    return f"md5(concat_ws('|', '42', '{op}', {', '.join(f'cast({k} as {d.string})' for k in keys)}))"


_PRIME = 2147483647


def drawn(op: str, *keys: str) -> str:
    """A seeded draw in whole numbers below 2^31: cheap where a row is drawn for
    each of many candidates.  Ties are possible; order by the keys besides."""
    h = str(zlib.crc32(op.encode()) % _PRIME)
    for k in keys:
        h = f"(({h} + cast({k} as bigint) % {_PRIME}) * 48271 % {_PRIME})"
    return f"({h} * {h} % {_PRIME})"


@plan
def j01_resume_anti(d):
    return """
    select i.scene_id from (select distinct scene_id from instances) i
    left anti join (select distinct scene_id from observations where ins_id % 20 = 3 and score >= 0.98e0) o on o.scene_id = i.scene_id
    """ if d.name == "spark" else """
    select scene_id from (select distinct scene_id from instances) i
    where not exists (select 1 from observations o where o.scene_id = i.scene_id and o.ins_id % 20 = 3 and o.score >= 0.98e0)"""


@plan
def j02_scene_prereqs(d):
    return """
    select i.scene_id, i.n_inst, coalesce(o.n_frames, 0) as n_frames, coalesce(c.n_pairs, 0) as n_pairs,
        case when o.n_frames is null then 'no_frames' when c.n_pairs is null then 'no_covisibility' else 'ready' end as status
    from (select scene_id, count(*) as n_inst from instances group by 1) i
    left join (select scene_id, count(distinct frame_idx) as n_frames from observations group by 1) o on o.scene_id = i.scene_id
    left join (select scene_id, count(*) as n_pairs from pairs group by 1) c on c.scene_id = i.scene_id"""


@plan
def j03_stem_bridge(d):
    path = f"concat('m/', cast(scene_id as {d.string}), '/f', cast(frame_idx as {d.string}), '/', cast(ins_id as {d.string}), '.png')"
    return f"""
    select scene_id, stem, count(*) as n
    from (select scene_id, {d.at("split(path, '/')", 3)} as stem from (select scene_id, {path} as path from observations) p) s
    group by 1, 2"""


@plan
def j04_pair_candidates(d):
    return "select scene_id, frame_a, frame_b, round(cov, 6) as cov from pairs"


@plan
def j04_pair_range(d):
    return "select scene_id, frame_a, frame_b, round(cov, 6) as cov from covis where cov between 0.05e0 and 0.25e0"


@plan
def j05_common_objects(d):
    if d.derives:  # a row a pair and object is made after the one shuffle by scene, and never shuffled
        return f"select scene_id, frame_a, frame_b, ins_id from {relation('pair_common', d)}"
    return """
    select p.scene_id, p.frame_a, p.frame_b, a.ins_id
    from pairs p
    join observations a on a.scene_id = p.scene_id and a.frame_idx = p.frame_a
    join observations b on b.scene_id = p.scene_id and b.frame_idx = p.frame_b and b.ins_id = a.ins_id"""


@plan
def j06_objects_in_a(d):
    if d.derives:
        return f"select scene_id, frame_a, frame_b, ins_id from {relation('pair_first', d)}"
    return """
    select p.scene_id, p.frame_a, p.frame_b, a.ins_id
    from pairs p join observations a on a.scene_id = p.scene_id and a.frame_idx = p.frame_a"""


_BOX = ("ins_id", "label", "cx", "cy", "cz", "ex", "ey", "ez")
_BOXES = ", ".join(f"{s}.{c} as {c}_{s}" for s in "ab" for c in _BOX)


def _across(d: Spark, op: str, left: str, right: str, residual: str, cap: int) -> str:
    """The least draws of all candidates of a pair: one item of each frame.

    Candidates carry ids only; boxes are joined to those that are drawn."""
    if d.name == "spark" and residual == _UNLIKE:
        return _across_by_draw(op, left, right, cap)
    order = drawn(op, "scene_id", "frame_a", "frame_b", "ins_a", "ins_b")
    return f"""
    select t.scene_id, t.frame_a, t.frame_b, t.cov, {_BOXES}, t.draw from (
        select * from (
            select c.*, row_number() over (partition by scene_id, frame_a, frame_b order by {order}, ins_a, ins_b) as draw from (
                select p.scene_id, p.frame_a, p.frame_b, p.cov, a.ins_id as ins_a, b.ins_id as ins_b
                from pairs p
                join {left} a on a.scene_id = p.scene_id and a.frame_idx = p.frame_a
                join {right} b on b.scene_id = p.scene_id and b.frame_idx = p.frame_b
                where {residual}) c) r
        where draw <= {cap}) t
    join {_KINDS[left]} a on a.ins_id = t.ins_a join {_KINDS[right]} b on b.ins_id = t.ins_b"""


def _across_by_draw(op: str, left: str, right: str, cap: int) -> str:
    """The same draws by ``draw_couples``, from the lists of both frames."""
    return f"""
    select t.scene_id, t.frame_a, t.frame_b, t.cov, {_BOXES}, t.draw from (
        select scene_id, frame_a, frame_b, cov, drawn[2 * at] as ins_a, drawn[2 * at + 1] as ins_b, at + 1 as draw
        from (
            select scene_id, frame_a, frame_b, cov, drawn, explode(sequence(0, size(drawn) div 2 - 1)) as at from (
                select p.scene_id, p.frame_a, p.frame_b, p.cov, draw_couples({zlib.crc32(op.encode()) % _PRIME}L, {cap}L,
                    p.scene_id, p.frame_a, p.frame_b, a.ids, a.labels, b.ids, b.labels) as drawn
                from pairs p
                join {_LISTS[left]} a on a.scene_id = p.scene_id and a.frame_idx = p.frame_a
                join {_LISTS[right]} b on b.scene_id = p.scene_id and b.frame_idx = p.frame_b) d
            where size(drawn) > 0) e) t
    join {_KINDS[left]} a on a.ins_id = t.ins_a join {_KINDS[right]} b on b.ins_id = t.ins_b"""


#: The lists of each kind by frame.
_LISTS = {"seen": "frame_objects", "seen_regions": "frame_regions"}
#: What each kind of item by frame is an item of.
_KINDS = {"seen": "instances", "seen_regions": "regions"}
_UNLIKE = "a.ins_id <> b.ins_id and a.label <> b.label"


@view
def seen_regions(d):
    return """
    select o.scene_id, o.frame_idx, r.ins_id, r.label, r.cx, r.cy, r.cz, r.ex, r.ey, r.ez, r.yaw_deg
    from observations o join regions r on r.ins_id = o.ins_id"""


def objects_drawn(d: Spark, op: str = "j07") -> str:
    return _across(d, op, "seen", "seen", _UNLIKE, 3)


@view
def objects_across(d):
    if d.derives:
        return f"select * from {relation('drawn_objects', d)}"
    return objects_drawn(d)


@view
def regions_across(d):
    if d.derives:
        return f"select * from {relation('drawn_regions', d)}"
    return _across(d, "j08", "seen_regions", "seen_regions", _UNLIKE, 3)


@view
def object_region_across(d):
    if d.derives:
        return f"select * from {relation('drawn_object_region', d)}"
    return _across(d, "j09", "seen", "seen_regions", f"{_UNLIKE} and not {inside('a', 'b')}", 3)


_ACROSS = "select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b from "


@plan
def j07_object_pairs_across(d):
    return _ACROSS + "objects_across"


@plan
def j08_region_pairs_across(d):
    return _ACROSS + "regions_across"


@plan
def j09_object_region_across(d):
    return "select scene_id, frame_a, frame_b, ins_id_a as obj, ins_id_b as region from object_region_across"


@view
def in_either(d):
    """Instances of either frame of a pair, with flags and a drawn order."""
    if d.derives:  # the order, labels and boxes only where a text names them (or nothing)
        return f"select * from {relation('pair_instances', d)}"
    return f"""
    select u.scene_id, u.frame_a, u.frame_b, u.ins_id, i.label, i.cx, i.cy, i.cz, i.ex, i.ey, i.ez, i.yaw_deg, u.in_a, u.in_b,
        row_number() over (partition by u.scene_id, u.frame_a, u.frame_b order by
            {drawn('j10', 'u.scene_id', 'u.frame_a', 'u.frame_b', 'u.ins_id')}, u.ins_id) as pos
    from (
        select scene_id, frame_a, frame_b, ins_id, max(in_a) as in_a, max(in_b) as in_b from (
            select p.scene_id, p.frame_a, p.frame_b, o.ins_id, 1 as in_a, 0 as in_b
            from pairs p join observations o on o.scene_id = p.scene_id and o.frame_idx = p.frame_a
            union all
            select p.scene_id, p.frame_a, p.frame_b, o.ins_id, 0, 1
            from pairs p join observations o on o.scene_id = p.scene_id and o.frame_idx = p.frame_b) e
        group by 1, 2, 3, 4) u
    join instances i on i.ins_id = u.ins_id"""


def _triple_columns() -> str:
    return ", ".join(f"{s}.{c} as {c}_{s}" for s in "abc" for c in ("ins_id", "label", "cx", "cy", "cz", "ex", "ey", "ez"))


def triplets_by_draw(d: Spark, op: str = "j10t") -> str:
    """The same draws by ``draw_triples``, from the objects of both frames: a row
    only for a triple that is drawn, to which its boxes are joined."""
    seeds = [zlib.crc32(o.encode()) % _PRIME for o in ("j10", op)]
    return f"""
    select t.scene_id, t.frame_a, t.frame_b, {_triple_columns()}, t.draw from (
        select scene_id, frame_a, frame_b, drawn[3 * at] as ins_a, drawn[3 * at + 1] as ins_b, drawn[3 * at + 2] as ins_c, at + 1 as draw
        from (
            select scene_id, frame_a, frame_b, drawn, explode(sequence(0, size(drawn) div 3 - 1)) as at from (
                select p.scene_id, p.frame_a, p.frame_b,
                    draw_triples({seeds[0]}L, {seeds[1]}L, p.scene_id, p.frame_a, p.frame_b, a.ids, a.labels, b.ids, b.labels) as drawn
                from pairs p
                join frame_objects a on a.scene_id = p.scene_id and a.frame_idx = p.frame_a
                join frame_objects b on b.scene_id = p.scene_id and b.frame_idx = p.frame_b) d
            where size(drawn) > 0) e) t
    join instances a on a.ins_id = t.ins_a join instances b on b.ins_id = t.ins_b join instances c on c.ins_id = t.ins_c"""


def _lists(source: str) -> str:
    return f"""
    select scene_id, frame_idx, transform(held, x -> x.ins_id) as ids, transform(held, x -> x.label) as labels
    from (select scene_id, frame_idx, collect_list(struct(ins_id, xxhash64(label) as label)) as held from {source} group by 1, 2) h"""


@view
def frame_objects(d):
    """The instances of each frame, and their labels as numbers (Spark only)."""
    return _lists("seen")


@view
def frame_regions(d):
    return _lists("seen_regions")


@view
def triplets(d):
    """At most ten draws of three instances that no single frame shows, from
    all such triples of a pair (a scene's instances bound their number)."""
    if d.derives:
        return f"select * from {relation('drawn_triples', d)}"
    if d.name == "spark":
        return triplets_by_draw(d)
    order = drawn("j10t", "a.scene_id", "a.frame_a", "a.frame_b", "a.ins_id", "b.ins_id", "c.ins_id")
    return f"""
    select * from (
        select a.scene_id, a.frame_a, a.frame_b, {_triple_columns()},
            row_number() over (partition by a.scene_id, a.frame_a, a.frame_b order by {order}, a.ins_id, b.ins_id, c.ins_id) as draw
        from in_either a
        join in_either b on b.scene_id = a.scene_id and b.frame_a = a.frame_a and b.frame_b = a.frame_b
            and b.pos > a.pos and b.label <> a.label
        join in_either c on c.scene_id = a.scene_id and c.frame_a = a.frame_a and c.frame_b = a.frame_b
            and c.pos > b.pos and c.label <> a.label and c.label <> b.label
        where a.in_a + b.in_a + c.in_a < 3 and a.in_b + b.in_b + c.in_b < 3) t
    where draw <= 10"""


@plan
def j10_triplets(d):
    return "select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, ins_id_c as ins_c from triplets"


def _two_and_region(d: Spark, op: str, excluded: str) -> str:
    """Two objects of frame a and a region of frame b that does not hold one of
    them; as ``_across``, boxes are joined to the draws."""
    order = drawn(op, "scene_id", "frame_a", "frame_b", "ins_a", "ins_b", "ins_c")
    return f"""
    select t.scene_id, t.frame_a, t.frame_b, {_triple_columns()}, t.draw from (
        select * from (
            select u.*, row_number() over (partition by scene_id, frame_a, frame_b order by {order}, ins_a, ins_b, ins_c) as draw from (
                select p.scene_id, p.frame_a, p.frame_b, a.ins_id as ins_a, b.ins_id as ins_b, c.ins_id as ins_c
                from pairs p
                join seen a on a.scene_id = p.scene_id and a.frame_idx = p.frame_a
                join seen b on b.scene_id = p.scene_id and b.frame_idx = p.frame_a
                join seen_regions c on c.scene_id = p.scene_id and c.frame_idx = p.frame_b
                where {_UNLIKE} and c.ins_id <> a.ins_id and c.ins_id <> b.ins_id and not {inside(excluded, 'c')}) u) r
        where draw <= 10) t
    join instances a on a.ins_id = t.ins_a join instances b on b.ins_id = t.ins_b join regions c on c.ins_id = t.ins_c"""


@view
def two_and_region_a(d):
    if d.derives:
        return f"select * from {relation('drawn_two_region_a', d)}"
    return _two_and_region(d, "j11", "a")


@view
def two_and_region_b(d):
    if d.derives:
        return f"select * from {relation('drawn_two_region_b', d)}"
    return _two_and_region(d, "j12", "b")


_REGION_C = "select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, ins_id_c as region_c from "


@plan
def j11_two_obj_region_a(d):
    return _REGION_C + "two_and_region_a"


@plan
def j12_two_obj_region_b(d):
    return _REGION_C + "two_and_region_b"


@plan
def j13_mask_lookup(d):
    """The mask of an observation by path, else the instance's best one."""
    order = "score desc, l_orderkey, l_linenumber, l_suppkey, x, y, w, h"
    return f"""
    with exact as (
        select * from (select m.*, row_number() over (partition by scene_id, frame_idx, ins_id order by {order}) as rn
                       from masks m) r where rn = 1),
    fallback as (
        select * from (select m.*, row_number() over (partition by ins_id order by {order}) as rn from masks m) r where rn = 1)
    select o.ins_id, o.frame_idx, case when e.ins_id is not null then 'path' else 'instance' end as src,
        coalesce(e.w, f.w) as w, coalesce(e.h, f.h) as h
    from observations o
    left join exact e on e.scene_id = o.scene_id and e.frame_idx = o.frame_idx and e.ins_id = o.ins_id
    left join fallback f on f.ins_id = o.ins_id"""


def overlap(axis: str) -> str:
    c, e = f"c{axis}", f"e{axis}"
    return f"(least(a.{c} + a.{e} / 2, b.{c} + b.{e} / 2) - greatest(a.{c} - a.{e} / 2, b.{c} - b.{e} / 2))"


_ALL = " and ".join(f"{overlap(x)} >= 0" for x in "xyz")
_VOLUME = " * ".join(overlap(x) for x in "xyz")


@plan
def j14_aabb_overlaps(d):
    return f"""
    select a.scene_id, a.ins_id as a, b.ins_id as b, round({_VOLUME}, 6) as inter_vol
    from instances a join instances b on a.scene_id = b.scene_id and a.ins_id < b.ins_id where {_ALL}"""


@plan
def j15_axis_aligned_overlap_ratio(d):
    ratio = f"({_VOLUME}) / least(a.ex * a.ey * a.ez, b.ex * b.ey * b.ez)"
    return f"""
    select a.scene_id, a.ins_id as a, b.ins_id as b, round({ratio}, 6) as ratio
    from regions a join regions b on a.scene_id = b.scene_id and a.ins_id < b.ins_id
    where {_ALL} and {ratio} >= 0.3e0"""


@plan
def j16_box_containment(d):
    """Boxes all of whose corners lie in another box, both turned about z."""
    ca, sa = "cos(radians(a.yaw_deg))", "sin(radians(a.yaw_deg))"
    cb, sb = "cos(radians(b.yaw_deg))", "sin(radians(b.yaw_deg))"
    held = ["abs(a.cz - b.cz) + a.ez / 2 <= b.ez / 2 + 1e-6"]
    for i in (-1, 1):
        for j in (-1, 1):
            dx = f"(a.cx + {i} * {ca} * a.ex / 2 - {j} * {sa} * a.ey / 2 - b.cx)"
            dy = f"(a.cy + {i} * {sa} * a.ex / 2 + {j} * {ca} * a.ey / 2 - b.cy)"
            held += [f"abs({cb} * {dx} + {sb} * {dy}) <= b.ex / 2 + 1e-6", f"abs({cb} * {dy} - {sb} * {dx}) <= b.ey / 2 + 1e-6"]
    return f"""
    select a.scene_id, a.ins_id as inner_id, b.ins_id as outer_id
    from instances a join regions b on a.scene_id = b.scene_id and a.ins_id <> b.ins_id where {' and '.join(held)}"""


@plan
def j17_knn_cameras(d):
    cos = "least(1e0, greatest(-1e0, a.r02 * b.r02 + a.r12 * b.r12 + a.r22 * b.r22))"
    dist = "sqrt((a.tx - b.tx) * (a.tx - b.tx) + (a.ty - b.ty) * (a.ty - b.ty) + (a.tz - b.tz) * (a.tz - b.tz))"
    return f"""
    select scene_id, frame, nn_frame, rank, round(dist, 6) as dist, round(angle, 6) as angle from (
        select scene_id, frame, nn_frame, dist, angle,
            row_number() over (partition by scene_id, frame order by round(dist, 9), round(angle, 9), nn_frame) as rank
        from (select a.scene_id, a.frame_idx as frame, b.frame_idx as nn_frame, {dist} as dist, degrees(acos({cos})) as angle
              from cams a join cams b on a.scene_id = b.scene_id and a.frame_idx <> b.frame_idx) p
        where angle < 30 and dist > 0.01e0 and dist < 1.5e0) r
    where rank <= 8"""


@plan
def j18_knn3_points(d):
    """Mean squared distance to the three nearest points of the same part."""
    if d.derives:
        return f"select part, id as k, round(mean_d2, 6) as mean_d2 from {relation('near_means', d)}"
    return """
    with p as (select ins_id, x, y, z, row_number() over (
                   partition by ins_id order by l_orderkey, l_linenumber, l_suppkey, x, y, z) as k from points),
    n as (
        select a.ins_id, a.k, (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z) as d2,
            row_number() over (partition by a.ins_id, a.k order by
                round((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) + (a.z - b.z) * (a.z - b.z), 9), b.k) as rank
        from p a join p b on a.ins_id = b.ins_id and a.k <> b.k)
    select ins_id as part, cast(k as bigint) as k, round(avg(d2), 6) as mean_d2 from n where rank <= 3 group by 1, 2"""


def iou(a: str, b: str) -> tuple[str, str]:
    """(intersection, IoU) of two xywh boxes; 0 where empty."""
    wide = f"greatest(0, least({a}.x + {a}.w, {b}.x + {b}.w) - greatest({a}.x, {b}.x))"
    high = f"greatest(0, least({a}.y + {a}.h, {b}.y + {b}.h) - greatest({a}.y, {b}.y))"
    inter = f"({wide} * {high})"
    return inter, f"({inter} / cast({a}.w * {a}.h + {b}.w * {b}.h - {inter} as double))"


@view
def detections(d):
    """Masks of a frame; those of line 1 are the tracks, the others detections."""
    return """
    select m.*, row_number() over (partition by scene_id, frame_idx
        order by l_orderkey, l_linenumber, l_suppkey, ins_id, score, x, y, w, h) as k from masks m"""


@plan
def j19_det_track_assoc(d):
    """Detections against tracks: matches at 0.1, and whether a detection is new."""
    _, share = iou("a", "b")
    return f"""
    with m as (
        select a.scene_id, a.frame_idx, a.k as det, b.k as track, a.score, {share} as iou
        from detections a join detections b on a.scene_id = b.scene_id and a.frame_idx = b.frame_idx
            and a.l_linenumber <> 1 and b.l_linenumber = 1)
    select scene_id, frame_idx, det, count(case when iou >= 0.1e0 then 1 end) as n_tracks,
        round(max(iou), 6) as iou, {d.best('track', d.row('iou', '-track'))} as track,
        case when max(score) >= 0.7e0 and max(iou) < 0.1e0 then true else false end as is_new
    from m group by 1, 2, 3"""


@plan
def j21_box_iou_giou(d):
    """Shares of whole numbers may lie between two decimals: a billionth settles them."""
    inter, share = iou("a", "b")
    hull = (
        "cast((greatest(a.x + a.w, b.x + b.w) - least(a.x, b.x)) * (greatest(a.y + a.h, b.y + b.h) - least(a.y, b.y)) as double)"
    )
    union = f"(a.w * a.h + b.w * b.h - {inter})"
    return f"""
    select a.scene_id, a.frame_idx, a.k as a, b.k as b, round({share} + 1e-9, 6) as iou,
        round({share} - ({hull} - {union}) / {hull} + 1e-9, 6) as giou, round({inter} / cast(b.w * b.h as double) + 1e-9, 6) as ioa
    from detections a join detections b on a.scene_id = b.scene_id and a.frame_idx = b.frame_idx and a.k < b.k"""


@plan
def j23_point_box_distances(d):
    return """
    select o.ins_id, o.frame_idx, cast(b.k as bigint) as k, b.x + b.w / 2e0 - o.x as to_left, o.x - b.x as from_left, b.x + b.w - o.x as to_right,
        o.y - b.y as from_top, b.y + b.h - o.y as to_bottom
    from detections o join detections b on o.scene_id = b.scene_id and o.frame_idx = b.frame_idx and o.k = 1"""


@plan
def j24_priority_path(d):
    """Of the candidate locations of a page, the first that exists."""
    host = d.extract("url", "//([^/]+)/", 1)
    return f"""
    with listing as (select distinct {host} as host from {d.table('pages')} where page_id % 3 = 0),
    candidates as (
        select page_id, ord, case ord when 1 then concat('m.', host) when 2 then host else concat('www.', host) end as path
        from (select page_id, {d.replace_all(host, '^(m|www)[.]', '')} as host from {d.table('pages')}) p
        cross join (select 1 as ord union all select 2 as ord union all select 3 as ord) o)
    select c.page_id, {d.least('c.path', 'c.ord')} as chosen, min(c.ord) as ord
    from candidates c join listing l on l.host = c.path group by 1"""


@plan
def j25_asof_frames(d):
    """For every unmatched frame the matched one before and the one after."""
    return """
    select obj_id, frame_idx as frame,
        max(case when matched = 1 then frame_idx end) over (partition by obj_id order by frame_idx
            rows between unbounded preceding and 1 preceding) as before,
        min(case when matched = 1 then frame_idx end) over (partition by obj_id order by frame_idx
            rows between 1 following and unbounded following) as after
    from track_events"""


@plan
def j26_prior_labels(d):
    """Distinct labels of the frames before each frame."""
    return """
    with firsts as (select scene_id, label, min(frame_idx) as first_frame from seen group by 1, 2),
    frames as (select distinct scene_id, frame_idx from observations)
    select f.scene_id, f.frame_idx, count(l.label) as n_prior
    from frames f left join firsts l on l.scene_id = f.scene_id and l.first_frame < f.frame_idx group by 1, 2"""
