"""Strings, paths, hashes and JSON."""

from __future__ import annotations

from .registry import plan, relation


@plan
def x01_categories(d):
    """Split on commas, line ends and semicolons; letters, blanks and dashes stay."""
    clean = f"lower(trim({d.replace_all('t', '[^a-zA-Z -]', '')}))"
    if d.name == "spark":
        source = f"(select page_id, explode(split(url, r'[,;/?&=]')) as t from {d.table('pages')})"
    else:
        source = f"(select page_id, unnest(regexp_split_to_array(url, '[,;/?&=]')) as t from {d.table('pages')})"
    return f"""
    select page_id as id, count(*) as n, max(c) as last_label from (select page_id, {clean} as c from {source} s) k where c <> '' group by 1"""


def slug(d, x: str) -> str:
    word = r"[^\p{L}\p{N}_\-]+"
    return f"coalesce(nullif(trim(both '_' from {d.replace_all(d.replace_all(f'lower({x})', word, '_'), '_+', '_')}), ''), 'label')"


@plan
def x02_slug(d):
    value = slug(d, "url") if d.name == "spark" else slug(d, "url").replace("trim(both '_' from ", "trim(").replace("), ''), 'label')", ", '_'), ''), 'label')")
    return f"select page_id as id, {value} as value from {d.table('pages')}"


@plan
def x03_sanitise(d):
    return f"select page_id as id, {d.replace_all('url', '[^A-Za-z0-9._-]', '')} as value from {d.table('pages')}"


@plan
def x04_mask_names(d):
    return f"""
    select scene_id, frame_idx, ins_id, case when n > 1 then concat(replace(label, ' ', '_'), '_', lpad(cast(rn as {d.string}), 2, '0'), '.png')
        else concat(replace(label, ' ', '_'), '.png') end as name
    from (select scene_id, frame_idx, ins_id, label, count(*) over (partition by scene_id, frame_idx, label) as n,
            row_number() over (partition by scene_id, frame_idx, label order by ins_id) - 1 as rn from seen) s"""


@plan
def x05_paths(d):
    return f"""
    select page_id as id, {d.extract('url', '/([^/?#]*)(?:[?#].*)?$', 1)} as stem, {d.extract('url', '//([^/]+)/', 1)} as host from {d.table('pages')}"""


@plan
def x06_urls(d):
    return f"""
    select s_suppkey as id, concat('http://', lower(replace(s_name, '#', '-')), '/v1/chat/completions') as url, s_suppkey % 4 as server from {d.table('supplier')}"""


@plan
def x07_clean(d):
    """Delete label words and outer punctuation, squeeze blanks; empty is null."""
    body = d.replace_all(d.replace_all("lower(text)", "(the|a|an) label", ""), "[ \\t\\n\\r]+", " ")
    trimmed = d.replace_all(body, "^[ .,;:!?]+|[ .,;:!?]+$", "")
    return f"select doc_id as id, md5({trimmed}) as value, nullif({trimmed}, '') is null as empty from {d.table('documents')}"


@plan
def x08_json_verdict(d):
    """The outermost braces of a reply; what does not parse is dropped."""
    inner = d.extract("props", "[{].*[}]", 0)
    number = f"get_json_object({inner}, '$.k')" if d.name == "spark" else f"json_extract_string({inner}, '$.k')"
    return f"""
    select event_id as id, case when {d.try_int(number)} is null then 'DROP' when {d.try_int(number)} >= 50 then 'KEEP' else 'DROP' end as decision
    from {d.table('events')}"""


@plan
def x09_tool_call(d):
    reply = "concat('<tool>', props, '</tool>')"
    return f"select event_id as id, {d.extract(reply, '<tool>(.*)</tool>', 1)} as call from {d.table('events')}"


@plan
def x10_canonical(d):
    clean = d.replace_all("lower(replace(url, '_', ' '))", "[^a-z0-9 ]", "")
    return f"select page_id as id, trim({d.replace_all(clean, ' +', ' ')}) as value from {d.table('pages')}"


@plan
def x12_seed(d):
    return f"select p_partkey as id, {d.hexint("substr(md5(concat_ws('|', p_name, p_brand, 'camrot')), 1, 8)")} as value from {d.table('part')}"


@plan
def x13_marker_suffix(d):
    return f"""
    select scene_id, frame_a, frame_b, substr(md5(concat_ws('|', 'object_distance', cast(least(ins_id_a, ins_id_b) as {d.string}),
        cast(greatest(ins_id_a, ins_id_b) as {d.string}), 'red', 'green')), 1, 8) as suffix from objects_across"""


@plan
def x14_mask_keys(d):
    return """
    select p.ins_id, p.key, case when p.key in ('A', 'B', 'C') then strpos('ABC', p.key) else 3 + cast(p.key as int) end + cast(0 as bigint) as ord from (
        select ins_id, case ins_id % 5 when 0 then 'A' when 1 then 'B' when 2 then 'C' when 3 then '1' else '2' end as key from instances) p
    """.replace("strpos('ABC', p.key)", "instr('ABC', p.key)")


@plan
def x16_prompt(d):
    return f"""
    select conv_id, turn, md5(concat(repeat('<image>', cast(1 + turn % 2 as int)), text)) as value from {d.table('conversations')}"""


@plan
def x19_latest_iteration(d):
    return f"""
    select p_brand, max(cast({d.extract('name', '_([0-9]+)$', 1)} as bigint)) as latest
    from (select p_brand, concat('iteration_', cast(p_partkey as {d.string})) as name from {d.table('part')}) n group by 1"""


@plan
def x20_config_merge(d):
    """Command-line values win over the file's."""
    return f"""
    select c_custkey, coalesce(case when c_custkey % 3 = 0 then c_mktsegment end, n.n_name) as value
    from {d.table('customer')} c left join {d.table('nation')} n on n.n_nationkey = c.c_nationkey"""


@plan
def x21_size_cap(d):
    return f"""
    select p_partkey, greatest(1, {d.even('w * least(1e0, 1024 / greatest(w, h))')}) as w, greatest(1, {d.even('h * least(1e0, 1024 / greatest(w, h))')}) as h
    from (select p_partkey, 400e0 + p_partkey * 37 % 3000 as w, 300e0 + p_partkey * 53 % 2500 as h from {d.table('part')}) s"""


@plan
def x22_valid_indices(d):
    return f"""
    select scene_id, frame_idx, {d.joined(d.gather(f'cast(k as {d.string})', 'k'), ',')} as kept from (
        select distinct scene_id, frame_idx, ins_id % 25 as k from observations) u where k between 1 and 20 group by 1, 2"""


@plan
def x17_choice_text(d):
    return f"""
    select scene_id, {d.joined(d.gather("concat(letter, '. ', label)", 'letter'), '/')} as text from (
        select scene_id, label, substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ', cast(row_number() over (partition by scene_id order by ins_id) as int), 1) as letter
        from instances) l group by 1"""


@plan
def s13_scene_discovery(d):
    return """
    select scene_id, count(*) as n_frames from frame_sizes where scene_id % 2 = 0 group by 1"""


@plan
def s12_multi_part(d):
    """Parts of one scene by name prefix; the cloud with the best priority."""
    prefix = d.extract("p_type", "^([A-Z]+)", 1)
    return f"""
    select {prefix} as prefix, count(*) as n_parts, {d.least('p_partkey', d.row('p_size', 'p_partkey'))} as chosen from {d.table('part')} group by 1"""


@plan
def s15_scene_list(d):
    """Ids from a comma list."""
    if d.name == "spark":
        source = "(select explode(split('1, 2,3 ,5,8', ',')) as t)"
    else:
        source = "(select unnest(string_split('1, 2,3 ,5,8', ',')) as t)"
    return f"select i.scene_id, count(*) as n from instances i join (select cast(trim(t) as bigint) as scene_id from {source} s) w on w.scene_id = i.scene_id group by 1"


@plan
def s01_camera_frames(d):
    """Frames numbered by path, with whether the frame is usable; numbers have four
    digits or more, as many as they need, so that no two frames share a path."""
    number = f"cast(frame_idx as {d.string})"
    return f"""
    select scene_id, row_number() over (partition by scene_id order by path) - 1 as frame_no, path, is_bad from (
        select scene_id, concat('f', lpad({number}, cast(greatest(4, length({number})) as int), '0'), '.jpg') as path, vec_id % 11 = 0 as is_bad from cams) f"""


@plan
def s05_stem_filter(d):
    """Only the frames that some mask names."""
    return """
    select c.scene_id, c.frame_idx, round(c.tx, 6) as tx from cams c
    where exists (select 1 from masks m where m.scene_id = c.scene_id and m.frame_idx = c.frame_idx)"""


@plan
def s07_instance_corners(d):
    return """
    select ins_id, label, round(cx - ex / 2, 6) as x0, round(cy - ey / 2, 6) as y0, round(cz - ez / 2, 6) as z0,
        round(cx + ex / 2, 6) as x1, round(cy + ey / 2, 6) as y1, round(cz + ez / 2, 6) as z1 from instances"""


@plan
def s08_mask_root(d):
    """The root of a mask path: all before the component that is the scene."""
    path = f"concat('data/masks/scene', cast(scene_id as {d.string}), '/f', cast(frame_idx as {d.string}), '/m.png')"
    root = d.extract("path", "^(.*)/scene[0-9]+/", 1)
    return f"select root, count(*) as n, count(distinct scene_id) as n_scenes from (select {root} as root, scene_id from (select scene_id, {path} as path from observations) p) r group by 1"


@plan
def s17_annotation_tables(d):
    return """
    select scene_id, count(distinct frame_idx) as n_images, count(distinct ins_id) as n_categories, count(*) as n_annotations
    from masks group by 1"""


@plan
def f16_marker_filter(d):
    return f"""
    select scene_id, frame_a, frame_b, ins_id_a, ins_id_b from (
        select *, {d.hexint("substr(md5(concat_ws('|', cast(ins_id_a as varchar), cast(ins_id_b as varchar))), 1, 2)") if d.name == "duck"
                  else d.hexint("substr(md5(concat_ws('|', cast(ins_id_a as string), cast(ins_id_b as string))), 1, 2)")} % 5 as marker
        from objects_across) m where marker = 4"""


@plan
def u04_frame_labels(d):
    return f"""
    select scene_id, frame_idx, {d.joined(d.gather('label', 'label'), ',')} as labels from (
        select distinct scene_id, frame_idx, label from seen) s group by 1, 2"""


@plan
def x15_reference_keys(d):
    key = f"concat(case when ins_id % 3 = 0 then 'region_' else 'object_' end, cast(ins_id % 4 as {d.string}))"
    return f"select key, {d.extract('key', '^(object|region)_[0-9]+$', 1)} as kind, count(*) as n from (select {key} as key from instances) k group by 1, 2"


@plan
def x18_depth_paths(d):
    return f"""
    select page_id, case when page_id % 3 = 0 then {d.replace_all("url", "/[^/]*$", "/depth.npy")} else concat(url, '.depth') end as path from {d.table('pages')}"""


@plan
def t05_reconditioning(d):
    """Every sixteenth frame a matched track takes the detection's mask."""
    return """
    select obj_id, count(*) as n, cast(sum(case when matched = 1 and frame_idx % 16 = 0 then 1 else 0 end) as bigint) as replaced
    from track_events group by 1"""


@plan
def t06_emission_buffer(d):
    """The frame that leaves a FIFO of fifteen when each one comes."""
    return """
    select obj_id, frame_idx, lag(frame_idx, 15) over (partition by obj_id order by frame_idx) as emitted from track_events"""


@plan
def m19_proxy_frame(d):
    """Axes in plan, if a lies north of b."""
    return """
    select scene_id, frame_a, frame_b, ins_id_a, ins_id_b, ins_id_c, round(cos(delta), 6) as fx, round(sin(delta), 6) as fy,
        round(-sin(delta), 6) as rx, round(cos(delta), 6) as ry
    from (select *, atan2(cy_a - cy_b, cx_a - cx_b) as delta from triplets
          where sqrt((cx_a - cx_b) * (cx_a - cx_b) + (cy_a - cy_b) * (cy_a - cy_b)) >= 1e-6) t"""


@plan
def m25_virtual_camera(d):
    """Midpoints between covisible cameras."""
    source = f"{relation('cam_close', d)} p" if d.derives else """cam_covis p join cams a on a.scene_id = p.scene_id and a.frame_idx = p.frame_a
    join cams b on b.scene_id = p.scene_id and b.frame_idx = p.frame_b where p.cov > 0.25e0"""
    return f"""
    select p.scene_id, p.frame_a, p.frame_b, round((a.tx + b.tx) / 2, 6) as tx, round((a.ty + b.ty) / 2, 6) as ty, round((a.tz + b.tz) / 2, 6) as tz
    from {source}"""


@plan
def m27_camera_record(d):
    """Camera centre in its own inverse: position, and the view axis."""
    return """
    select scene_id, frame_idx, round(-(r00 * tx + r10 * ty + r20 * tz), 6) as px, round(-(r01 * tx + r11 * ty + r21 * tz), 6) as py,
        round(-(r02 * tx + r12 * ty + r22 * tz), 6) as pz from cams"""


@plan
def b02_box_measures(d):
    return """
    select ins_id, frame_idx, cast(sum(w * h) as bigint) as area, max(x + w) as x1, max(y + h) as y1 from masks group by 1, 2"""


@plan
def b06_nearest_resize(d):
    return f"""
    select distinct ins_id, frame_idx, {d.floor('x * 640 / 1500e0')} as x, {d.floor('y * 480 / 1000e0')} as y from masks"""


@plan
def b09_exclusive_cells(d):
    return f"""
    select scene_id, frame_idx, i, j, {d.best('ins_id', d.row('score', '-ins_id'))} as ins_id from (
        select distinct scene_id, frame_idx, ins_id, score, {d.idiv('x', 100)} as i, {d.idiv('y', 100)} as j from masks) c group by 1, 2, 3, 4"""


@plan
def b12_best_candidate(d):
    """Of the masks of an instance the one of the largest IoU with line 1's."""
    from .joins import iou

    _, share = iou("a", "b")
    return f"""
    select ins_id, {d.best('k', d.row('share', 'score', '-k'))} as best, round(max(share), 6) as iou from (
        select a.ins_id, a.score, a.k, {share} as share from detections a join detections b
            on a.scene_id = b.scene_id and a.frame_idx = b.frame_idx and a.ins_id = b.ins_id and b.l_linenumber = 1 and a.k <> b.k) c group by 1"""
