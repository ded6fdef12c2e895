"""Grouped reductions: best masks, robust statistics, vocabularies, counts."""

from __future__ import annotations

from .registry import plan, relation, view


@plan
def a01_label_groups(d):
    """Instances numbered by the first appearance of their label in a scene."""
    return """
    select scene_id, label, row_number() over (partition by scene_id order by first_id) - 1 as label_no, n
    from (select scene_id, label, min(ins_id) as first_id, count(*) as n from instances group by 1, 2) g"""


@plan
def a02_best_mask(d):
    """Best score and frame of each instance, and its confidence band."""
    return f"""
    with best as (
        select ins_id, max(score) as best_score, {d.best('frame_idx', d.row('score', '-frame_idx'))} as best_frame
        from masks where l_linenumber = 1 group by 1)
    select ins_id, round(best_score, 6) as best_score, best_frame,
        case when best_score >= 0.9e0 then 'accept' when best_score < 0.75e0 then 'drop' else 'verify' end as band
    from best"""


@plan
def a03_stem_label_index(d):
    return f"""
    select scene_id, frame_idx, label, count(*) as n,
        {d.joined(d.gather(f'cast(ins_id as {d.string})', 'ins_id'), ',')} as ids
    from seen group by 1, 2, 3"""


@plan
def a04_pair_instances(d):
    return "select scene_id, frame_a, frame_b, ins_id, in_a = 1 as in_a, in_b = 1 as in_b from in_either"


@plan
def a05_mad_trim(d):
    """Per axis 0.6745 (x - median) / MAD; the tenth with the largest goes."""
    z = lambda c: f"0.6745e0 * abs({c} - m{c}) / greatest(d{c}, 1e-6)"
    return f"""
    with m as (select ins_id, median(x) as mx, median(y) as my, median(z) as mz, count(*) as n from points group by 1),
    c as (select p.*, m.mx, m.my, m.mz, m.n from points p join m on m.ins_id = p.ins_id),
    s as (select ins_id, median(abs(x - mx)) as dx, median(abs(y - my)) as dy, median(abs(z - mz)) as dz from c group by 1),
    z as (
        select c.ins_id, c.n, round(greatest({z('x')}, {z('y')}, {z('z')}), 6) as zmax, c.l_orderkey, c.l_linenumber, c.l_suppkey,
            c.x, c.y
        from c join s on s.ins_id = c.ins_id),
    r as (select z.*, row_number() over (partition by ins_id order by zmax, l_orderkey, l_linenumber, l_suppkey, x, y) as rn from z)
    select ins_id as part, max(n) as n_in, count(*) as n_kept, max(zmax) as max_z
    from r where n < 5 or rn <= n - greatest(1, {d.even('n * 0.1e0')}) group by 1"""


@plan
def a06_box_stats(d):
    return """
    select ins_id, round(greatest(ex, ey, ez), 6) as longest, round(cz - ez / 2, 6) as top_z, round(ex * ey * ez, 6) as volume
    from instances"""


@plan
def a07_scene_norm(d):
    return """
    with c as (select scene_id, avg(tx) as cx, avg(ty) as cy, avg(tz) as cz from cams group by 1)
    select c.scene_id, round(max(cx), 6) as cx, round(max(cy), 6) as cy, round(max(cz), 6) as cz,
        round(1.1e0 * max(sqrt((tx - cx) * (tx - cx) + (ty - cy) * (ty - cy) + (tz - cz) * (tz - cz))), 6) as radius
    from cams k join c on c.scene_id = k.scene_id group by 1"""


@plan
def a11_floor_pick(d):
    """The largest instance of each scene's most extended label group."""
    return f"""
    select scene_id, {d.best('ins_id', d.row('round(ex * ey * ez, 9)', '-ins_id'))} as ins_id, round(max(ex * ey * ez), 6) as volume
    from instances where label like '%ring%' or label like '%plate%' or label like '%widget%' group by 1"""


@plan
def a12_scene_vocab(d):
    return f"""
    select scene_id, count(*) as n_labels, {d.joined(d.gather('label', 'label'), ',')} as labels_csv
    from (select distinct scene_id, label from (
            select scene_id, label from seen
            union all select distinct scene_id, w.label from instances
            cross join (select 'floor' as label union all select 'ceiling' as label union all select 'wall' as label) w) u) v
    group by 1"""


@plan
def a14_filter_totals(d):
    return """
    select coalesce(scene_id, -1) as scene_id, count(*) as n_in, count(case when score >= 0.75e0 then 1 end) as n_out,
        count(case when score < 0.75e0 then 1 end) as n_dropped
    from observations group by rollup (scene_id)"""


@view
def rle_runs(d):
    """Foreground runs of each mask: end (exclusive) and length, column-major."""
    if d.name == "spark":
        each = "select vec_id, label, height, p, len from rle lateral view posexplode(counts) ex as p, len"
    else:
        each = "select vec_id, label, height, unnest(range(len(counts))) as p, unnest(counts) as len from rle"
    return f"""
    select vec_id, label, height, stop, len from (
        select vec_id, label, height, p, len, cast(sum(len) over (partition by vec_id order by p) as bigint) as stop from ({each}) e) s
    where p % 2 = 1 and len > 0"""


@plan
def a15_rle_area_bbox(d):
    """Area, inclusive box and centroid of masks, by arithmetic on the runs."""
    first_col, last_col = d.idiv("(stop - len)", "height"), d.idiv("(stop - 1)", "height")
    whole = f"({last_col} > {first_col})"
    # sums of rows and columns over a run: in closed form by whole columns
    tri = lambda n: f"({d.idiv(f'({n}) * (({n}) - 1)', 2)})"
    cum_y = lambda p: f"({d.idiv(p, 'height')} * {tri('height')} + {tri(f'({p}) % height')})"
    cum_x = lambda p: f"({tri(d.idiv(p, 'height'))} * height + ({d.idiv(p, 'height')}) * (({p}) % height))"
    return f"""
    select vec_id, cast(sum(len) as bigint) as area, min({first_col}) as x0,
        min(case when {whole} then 0 else (stop - len) % height end) as y0, max({last_col}) as x1,
        max(case when {whole} then height - 1 else (stop - 1) % height end) as y1,
        round(sum({cum_x('stop')} - {cum_x('stop - len')}) / cast(sum(len) as double), 6) as cx,
        round(sum({cum_y('stop')} - {cum_y('stop - len')}) / cast(sum(len) as double), 6) as cy
    from rle_runs group by 1"""


@view
def rle_words(d):
    """Masks as words of 64 pixels, bit by bit (Spark only)."""
    low, high = "greatest(stop - len - word * 64, 0)", "least(stop - word * 64, 64)"
    ones = f"case when {high} - {low} = 64 then -1L else shiftleft(shiftleft(1L, cast({high} - {low} as int)) - 1L, cast({low} as int)) end"
    return f"""
    select vec_id, label, cast(sum(bit_count(bits)) as bigint) as area, {d.gather('bits', 'word')} as words
    from (
        select vec_id, label, word, bit_or(bits) as bits from (
            select vec_id, label, word, {ones} as bits
            from (select vec_id, label, stop, len, explode(sequence((stop - len) div 64, (stop - 1) div 64)) as word from rle_runs) r
            union all
            select vec_id, label, explode(sequence(0L, last)) as word, 0L as bits
            from (select vec_id, label, (max(stop) - 1) div 64 as last from rle_runs group by 1, 2) z) u
        group by 1, 2, 3) w
    group by 1, 2"""


@plan
def j22_rle_iou(d):
    """Intersection and union of all pairs of masks of a label: by overlapping
    runs, or (Spark) by the common bits of their words, in blocks of masks."""
    if d.derives:
        return f"select a, b, inter, uni from {relation('mask_pairs', d)}"
    if d.name == "spark":
        common = "aggregate(zip_with(a.words, b.words, (x, y) -> bit_count(x & y)), 0L, (n, x) -> n + coalesce(x, 0))"
        return f"""
        select a, b, inter, area_a + area_b - inter as uni from (
            select a.vec_id as a, b.vec_id as b, {common} as inter, a.area as area_a, b.area as area_b
            from rle_words a join rle_words b on a.label = b.label and b.vec_id > a.vec_id) h"""
    return """
    with size as (select vec_id, sum(len) as area from rle_runs group by 1),
    hit as (
        select a.vec_id as a, b.vec_id as b,
            sum(greatest(0, least(a.stop, b.stop) - greatest(a.stop - a.len, b.stop - b.len))) as inter
        from rle_runs a join rle_runs b on a.label = b.label and b.vec_id > a.vec_id
        group by 1, 2)
    select h.a, h.b, cast(h.inter as bigint) as inter, cast(sa.area + sb.area - h.inter as bigint) as uni
    from hit h join size sa on sa.vec_id = h.a join size sb on sb.vec_id = h.b"""


@plan
def a17_cluster_filter(d):
    """Clusters of at least max(third largest, 50) members."""
    return f"""
    with c as (select p_brand as cluster, count(*) as n from {d.table('part')} group by 1),
    k as (select cluster, n, row_number() over (order by n desc, cluster) as rn from c)
    select cluster, n from k where n >= greatest((select min(n) from k where rn <= 3), 50)"""


@plan
def a18_observation_trim(d):
    return "select ins_id, count(distinct frame_idx) as n_views from observations group by 1 having count(distinct frame_idx) >= 2"


@plan
def a19_voxels(d):
    return f"""
    select ins_id, count(*) as n_voxels from (
        select distinct ins_id, {d.floor('x / 5')} as i, {d.floor('y / 2')} as j, {d.floor('z / 2')} as k from points) v group by 1"""


@plan
def b11_shrink_suppression(d):
    """Per cell the best object wins; those left with under 0.3 go."""
    return f"""
    with cells as (select distinct ins_id, score, {d.idiv('x', 100)} as i, {d.idiv('y', 100)} as j, scene_id, frame_idx from masks),
    won as (
        select scene_id, frame_idx, i, j, {d.best('ins_id', d.row('score', '-ins_id'))} as ins_id from cells group by 1, 2, 3, 4),
    before as (select scene_id, frame_idx, ins_id, count(*) as n from (select distinct scene_id, frame_idx, ins_id, i, j from cells) c group by 1, 2, 3),
    after as (select scene_id, frame_idx, ins_id, count(*) as n from won group by 1, 2, 3)
    select b.scene_id, b.frame_idx, b.ins_id, b.n as n_before, coalesce(a.n, 0) as n_after,
        coalesce(a.n, 0) < 0.3e0 * b.n as suppressed
    from before b left join after a on a.scene_id = b.scene_id and a.frame_idx = b.frame_idx and a.ins_id = b.ins_id"""


@plan
def m23_image_metrics(d):
    """Mean squared and absolute error, and PSNR, of two channels."""
    return f"""
    select l_suppkey as image, round(avg((l_discount - l_tax) * (l_discount - l_tax)), 9) as mse,
        round(avg(abs(l_discount - l_tax)), 9) as l1,
        round(-10 * log10(avg((l_discount - l_tax) * (l_discount - l_tax))), 6) as psnr
    from {d.table('lineitem')} group by 1 having avg((l_discount - l_tax) * (l_discount - l_tax)) > 0"""
