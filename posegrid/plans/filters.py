"""Predicates and set operations."""

from __future__ import annotations

from .joins import inside
from .registry import plan, relation
from .windows import numbered


@plan
def f01_valid_frames(d):
    return """
    select o.scene_id, o.frame_idx, count(*) as n from observations o
    join (select distinct scene_id, frame_idx from masks where l_linenumber = 1) v on v.scene_id = o.scene_id and v.frame_idx = o.frame_idx
    group by 1, 2"""


@plan
def f02_ignore_labels(d):
    """Three of a scene's instances stand for its wall, floor and ceiling."""
    return """
    select ins_id, label from (
        select ins_id, case ins_id % 20 when 0 then 'wall' when 1 then 'Floor' when 2 then 'CEILING' else label end as label from instances) i
    where lower(label) not in ('wall', 'floor', 'ceiling')"""


@plan
def f03_frames_with_boxes(d):
    return """
    select scene_id, count(*) as n_frames from frame_sizes group by 1 having count(*) >= 2"""


@plan
def f05_motion(d):
    dist = "sqrt((a.tx - b.tx) * (a.tx - b.tx) + (a.ty - b.ty) * (a.ty - b.ty) + (a.tz - b.tz) * (a.tz - b.tz))"
    if d.derives:
        return f"select scene_id, frame_a, frame_b, round(dist, 6) as dist from {relation('cam_apart', d)}"
    return f"""
    select a.scene_id, a.frame_idx as frame_a, b.frame_idx as frame_b, round({dist}, 6) as dist
    from cams a join cams b on a.scene_id = b.scene_id and a.frame_idx < b.frame_idx where {dist} >= 2e0"""


@plan
def f06_three_in_union(d):
    return """
    select scene_id, frame_a, frame_b, count(*) as n from in_either group by 1, 2, 3 having count(*) >= 3"""


@plan
def f07_valid_depth(d):
    """Finite, positive, off the margin, and confident."""
    return f"""
    select l_orderkey % 50 as row, count(*) as n, count(case when {d.finite('depth')} and depth > 0 and l_orderkey % 50 between 5 and 44
            and l_tax >= 0.03e0 then 1 end) as n_valid
    from (select *, l_discount * 100 - 1 as depth from {d.table('lineitem')}) p group by 1"""


@plan
def f08_confidence_bands(d):
    return """
    select case when label like 'red%' then 'structural' when s >= 0.9e0 then 'accept' when s < 0.75e0 then 'drop' else 'verify' end as band,
        count(*) as n
    from (select i.ins_id, i.label, max(o.score) as s from instances i join observations o on o.ins_id = i.ins_id group by 1, 2) b group by 1"""


@plan
def f09_min_points(d):
    return "select ins_id, count(*) as n from points group by 1 having count(*) >= 30"


@plan
def f11_depth_agree(d):
    return f"""
    select l_orderkey % 50 as row, l_linenumber as col,
        count(case when l_discount > 0 and l_tax > 0 and abs(l_discount - l_tax) <= 0.006e0 then 1 end) as n_agree, count(*) as n
    from {d.table('lineitem')} group by 1, 2"""


@plan
def f12_grazing_angle(d):
    cos = "abs(r02 * tx + r12 * ty + r22 * tz) / sqrt(tx * tx + ty * ty + tz * tz)"
    return f"""
    select scene_id, frame_idx, round(degrees(acos(least(1e0, {cos}))), 6) as angle,
        degrees(acos(least(1e0, {cos}))) <= 80 as kept
    from cams where tx * tx + ty * ty + tz * tz > 0"""


@plan
def f13_boundary(d):
    return """
    select scene_id, frame_idx, ins_id, count(*) as n from masks
    where x + w / 2e0 between 0.025e0 * 1920 and 0.975e0 * 1920 and y + h / 2e0 between 0.025e0 * 1440 and 0.975e0 * 1440
    group by 1, 2, 3"""


@plan
def f14_short_rle(d):
    return f"select vec_id, {d.size('counts')} as n from rle where {d.size('counts')} > 4"


@plan
def f15_clip_boxes(d):
    return """
    select ins_id, frame_idx, x0, y0, x1, y1, count(*) as n from (
        select ins_id, frame_idx, greatest(0, least(x, 1280)) as x0, greatest(0, least(y, 960)) as y0,
            greatest(0, least(x + w, 1280)) as x1, greatest(0, least(y + h, 960)) as y1 from masks) c
    where x1 - x0 > 20 and y1 - y0 > 20 group by 1, 2, 3, 4, 5, 6"""


@plan
def f17_label_subset(d):
    return "select ins_id, label from instances where label in ('red widget', 'small ring')"


@plan
def f18_containment(d):
    return f"""
    select a.scene_id, a.ins_id as obj, b.ins_id as region
    from instances a join regions b on a.scene_id = b.scene_id and a.ins_id <> b.ins_id where {inside('a', 'b')}"""


@plan
def f19_prune(d):
    """Low opacity or large scale goes; clone or split by a gradient quantile."""
    if d.name == "spark":
        cut = _quantile(d, "l_extendedprice", d.table("lineitem"))
    else:
        cut = f"select quantile_cont(l_extendedprice, 0.9) as cut from {d.table('lineitem')}"
    return f"""
    with q as ({cut})
    select l_partkey, count(*) as n, count(case when l_discount < 0.02e0 or l_quantity > 45 then 1 end) as pruned,
        count(case when l_extendedprice >= q.cut and l_quantity <= 25 then 1 end) as cloned,
        count(case when l_extendedprice >= q.cut and l_quantity > 25 then 1 end) as split
    from {d.table('lineitem')} cross join q group by 1
    """


#: Rows from which a quantile's neighbours are looked for between two sketched ones.
SKETCHED = 100_000


def _quantile(d, value: str, table: str) -> str:
    """The exact nine tenths (interpolated) as ``cut``: a sketch names two values on either side of it, ten times
    its error apart; what lies below is counted, and only the values between them are put in order."""
    return f"""
        with b as (select case when n < {SKETCHED} then low else about[0] end as low, case when n < {SKETCHED} then high else about[1] end as high, 0.9e0 * (n - 1) as place
            from (select count({value}) as n, min({value}) as low, max({value}) as high, approx_percentile({value}, array(0.899e0, 0.901e0), 10000) as about from {table}) a),
        r as (select /*+ broadcast(b) */ case when {value} >= b.low then {value} end as v, b.place, count(*) as n
            from {table} cross join b where {value} <= b.high group by 1, 2),
        o as (select v, place, sum(n) over (order by v nulls first rows unbounded preceding) as upto, n from r),
        s as (select max(place) as place, max(case when upto - n <= floor(place) and floor(place) < upto then v end) as low,
            max(case when upto - n <= ceil(place) and ceil(place) < upto then v end) as high from o)
        select low + (place - floor(place)) * (high - low) as cut from s"""


@plan
def u02_set_ops(d):
    return """
    select scene_id, frame_a, frame_b, count(*) as n_union, cast(sum(case when in_a = 1 and in_b = 1 then 1 else 0 end) as bigint) as n_both
    from in_either group by 1, 2, 3"""


@plan
def u03_first_wins(d):
    return """
    select label, ins_id from (select label, ins_id, row_number() over (partition by label order by ins_id) as rn from instances) r
    where rn = 1"""


@plan
def u05_scene_difference(d):
    return """
    select distinct scene_id from instances except select scene_id from observations where ins_id % 20 = 3 and score >= 0.98e0"""


@plan
def u06_repeated_descriptions(d):
    """Entries whose image has another one with the same label and text."""
    return """
    select a.ins_id from descriptions a
    where exists (select 1 from descriptions b where b.scene_id = a.scene_id and b.stem = a.stem and b.label = a.label
        and b.description = a.description and b.ins_id <> a.ins_id)"""


@plan
def d01_filter_repeats(d):
    """Keep without rivals, drop with an exact one, else ask the model (here:
    keep if the text is at least as long as its longest rival)."""
    return """
    with g as (
        select scene_id, stem, label, description, count(*) as same, min(ins_id) as one,
            length(description) as len from descriptions group by 1, 2, 3, 4),
    t as (select g.*, count(*) over (partition by scene_id, stem, label) as texts,
            max(len) over (partition by scene_id, stem, label) as longest from g)
    select e.ins_id as doc_id, case when t.same > 1 then 'DROP' when t.texts = 1 then 'KEEP'
        when t.len >= t.longest then 'KEEP' else 'DROP' end as decision
    from descriptions e join t on t.scene_id = e.scene_id and t.stem = e.stem and t.label = e.label and t.description = e.description"""


@plan
def u07_decision_cache(d):
    """Distinct model keys, and how many requests each answers."""
    return """
    select scene_id, stem, label, md5(description) as key, count(*) as n_requests from descriptions group by 1, 2, 3, 4"""


@plan
def k02_export_ids(d):
    """Conversations with dense ids, in order, and the digest of their text."""
    source = f"""
        select conv_id, count(*) as n_turns,
            md5({d.joined(d.gather("concat(role, ': ', text)", 'turn'), '|')}) as payload_md5
        from {d.table('conversations')} group by 1"""
    ranked = numbered(source, d.idiv("conv_id", 1000), "conv_id", "conv_id, n_turns, payload_md5")
    return f"select cast(rn - 1 as bigint) as id, conv_id, n_turns, payload_md5 from ({ranked}) n"


@plan
def k07_run_log(d):
    """The latest state of each item of a run log."""
    return f"""
    select user_id as item, {d.best('event_type', d.row('ts', 'event_id'))} as status, count(*) as n_changes
    from {d.table('events')} group by 1"""


@plan
def k05_mask_index(d):
    """Items of each image, in order, and the images without any."""
    return f"""
    select f.scene_id, f.frame_idx, count(m.ins_id) as n_items,
        coalesce({d.joined(d.gather(f'cast(m.ins_id as {d.string})', 'm.ins_id'), ',')}, '') as items, count(m.ins_id) = 0 as missing
    from (select distinct scene_id, frame_idx from masks) f
    left join (select distinct scene_id, frame_idx, ins_id from masks where l_linenumber = 1 and score >= 0.6e0) m
        on m.scene_id = f.scene_id and m.frame_idx = f.frame_idx group by 1, 2"""
