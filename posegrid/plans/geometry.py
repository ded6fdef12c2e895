"""Cameras, boxes and directions in closed form."""

from __future__ import annotations

from .registry import plan, relation, view


def to_cam(p: tuple[str, str, str], c: str, *, rotate_only: bool = False) -> tuple[str, str, str]:
    """A world point in the axes of camera ``c`` (x right, y down, z forward)."""
    x, y, z = p if rotate_only else (f"({p[0]} - {c}.tx)", f"({p[1]} - {c}.ty)", f"({p[2]} - {c}.tz)")
    return tuple(f"({c}.r0{k} * {x} + {c}.r1{k} * {y} + {c}.r2{k} * {z})" for k in range(3))


def relative(r: int, k: int) -> str:
    """Entry of the rotation from camera a to camera b, in a's axes."""
    return f"(a.r0{r} * b.r0{k} + a.r1{r} * b.r1{k} + a.r2{r} * b.r2{k})"


#: Words by axis for positive and negative components.
MOTION_WORDS = {"x": ("right", "left"), "y": ("down", "up"), "z": ("forward", "backward")}
FACING_WORDS = {"x": ("Right", "Left"), "y": ("Down", "Up"), "z": ("Front", "Back")}
#: Share of the largest component from which a lesser one counts, and the
#: eight directions, clockwise from the front.
SECOND = "0.5774e0"
EGO8 = ["front", "front-right", "right", "back-right", "back", "back-left", "left", "front-left"]


def axis_words(x: str, y: str, z: str, words: dict, most: int) -> str:
    """Words of the components that count, largest first (x, y, z among equals)."""
    mags = {"x": f"abs({x})", "y": f"abs({y})", "z": f"abs({z})"}
    vals = {"x": x, "y": y, "z": z}
    word = {a: f"case when {vals[a]} > 0 then '{words[a][0]}' else '{words[a][1]}' end" for a in "xyz"}
    top = f"greatest({mags['x']}, {mags['y']}, {mags['z']})"
    branches = []
    for order in ("xyz", "xzy", "yxz", "yzx", "zxy", "zyx"):
        tests = []
        for first, second in zip(order, order[1:]):
            tests.append(f"{mags[first]} {'>=' if first < second else '>'} {mags[second]}")
        parts = [word[order[0]]]
        for k in range(1, most):
            parts.append(f"case when {mags[order[k]]} >= {SECOND} * {top} then concat('-', {word[order[k]]}) else '' end")
        branches.append(f"when {' and '.join(tests)} then concat({', '.join(parts)})")
    return f"case when {top} = 0 then 'stationary' {' '.join(branches)} end"


def compass8(right: str, forward: str) -> str:
    ns = f"case when {forward} > 0 then 'North' else 'South' end"
    ew = f"case when {right} > 0 then 'East' else 'West' end"
    return (
        f"case when greatest(abs({right}), abs({forward})) < 1e-6 then null "
        f"when least(abs({right}), abs({forward})) >= {SECOND} * greatest(abs({right}), abs({forward})) then concat({ns}, '-', {ew}) "
        f"when abs({right}) >= abs({forward}) then {ew} else {ns} end"
    )


def ego8_index(d, right: str, up: str, forward: str) -> str:
    flat = f"sqrt({right} * {right} + {forward} * {forward})"
    turn = d.even(f"round(degrees(atan2({right}, {forward})), 9) / 45e0")
    return f"case when {flat} < 1e-6 or abs({up}) >= 1.2e0 * {flat} then null else {d.pmod(turn, 8)} end"


def named(index: str, names: list[str]) -> str:
    return "case " + " ".join(f"when {index} = {i} then '{n}'" for i, n in enumerate(names)) + " end"


def firm(d, values: str) -> str:
    """Named values of a select list.  For Spark they come of a generator: no later filter or
    projection can spell them out again wherever they are used."""
    return f"inline(array(struct({values})))" if d.name == "spark" else values


@view
def cam_pairs(d):
    """Covisible camera pairs: rotation as Euler angles, motion in a's axes."""
    x, y, z = to_cam(("b.tx", "b.ty", "b.tz"), "a")
    source = f"{relation('cam_close', d)} p" if d.derives else """cam_covis p
    join cams a on a.scene_id = p.scene_id and a.frame_idx = p.frame_a
    join cams b on b.scene_id = p.scene_id and b.frame_idx = p.frame_b
    where p.cov > 0.25e0"""
    values = f"""degrees(atan2({relative(0, 2)}, {relative(2, 2)})) as yaw,
        degrees(asin(least(1e0, greatest(-1e0, -({relative(1, 2)}))))) as pitch,
        degrees(atan2({relative(1, 0)}, {relative(1, 1)})) as roll,
        {x} as x, {y} as y, {z} as z"""
    return f"""
    select p.scene_id, p.frame_a, p.frame_b, p.cov,
        {firm(d, values)}
    from {source}"""


@view
def cam_objects(d):
    """Each camera with all instances of the scene of the same number."""
    x, y, z = to_cam(("i.cx", "i.cy", "i.cz"), "c")
    return f"""
    select c.scene_id, c.frame_idx, i.ins_id, i.label, {x} as x, {y} as y, {z} as z
    from cams c join instances i on i.scene_id = c.scene_id"""


@plan
def m01_axis_flip(d):
    return """
    select scene_id, frame_idx, round(r00, 6) as r00, round(-r01, 6) + 0e0 as r01, round(-r02, 6) + 0e0 as r02, round(tx, 6) as tx from cams"""


@plan
def m02_world_to_cam(d):
    return "select scene_id, frame_idx, ins_id, round(x, 6) as x, round(y, 6) as y, round(z, 6) as z from cam_objects"


@plan
def m03_project(d):
    return """
    select scene_id, frame_idx, ins_id, case when z > 1e-6 then round(600e0 * x / z + 480, 4) end as u,
        case when z > 1e-6 then round(600e0 * y / z + 360, 4) end as v from cam_objects"""


@plan
def m04_unproject(d):
    """Pixels with depth back to camera axes."""
    return f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, round((l_suppkey * 13 % 960 - 480) / 600e0 * l_quantity, 6) as x,
        round((l_orderkey * 7 % 720 - 360) / 600e0 * l_quantity, 6) as y, l_quantity as z from {d.table('lineitem')}"""


@plan
def m05_relative_euler(d):
    return """
    select scene_id, frame_a as fa, frame_b as fb, round(yaw, 6) as yaw, round(pitch, 6) as pitch, round(roll, 6) as roll
    from cam_pairs"""


@plan
def m06_translation(d):
    return """
    select scene_id, frame_a, frame_b, round(x, 6) as x, round(y, 6) as y, round(z, 6) as z, round(sqrt(x * x + y * y + z * z), 6) as norm
    from cam_pairs"""


@plan
def m07_rotation_matrix(d):
    return "select scene_id, frame_idx, " + ", ".join(f"round(r{i}{j}, 6) as r{i}{j}" for i in range(3) for j in range(3)) + " from cams"


@plan
def m08_fov(d):
    return f"""
    select p_partkey, round(2 * atan(p_size / (2 * p_retailprice)), 9) as fov,
        round(p_size / (2 * tan(2 * atan(p_size / (2 * p_retailprice)) / 2)), 4) as focal from {d.table('part')}"""


@plan
def m09_corners(d):
    corners = " union all ".join(
        f"select {n} as k, {sx}e0 as sx, {sy}e0 as sy, {sz}e0 as sz"
        for n, (sx, sy, sz) in enumerate((x, y, z) for x in (-1, 1) for y in (-1, 1) for z in (-1, 1))
    )
    return f"""
    select ins_id, k,
        round(cx + cos(radians(yaw_deg)) * sx * ex / 2 - sin(radians(yaw_deg)) * sy * ey / 2, 6) as x,
        round(cy + sin(radians(yaw_deg)) * sx * ex / 2 + cos(radians(yaw_deg)) * sy * ey / 2, 6) as y,
        round(cz + sz * ez / 2, 6) as z
    from instances cross join ({corners}) s"""


def _tilted(d) -> str:
    """Boxes turned about x after their yaw, so that their axes lean: the axes
    as columns, u (from x), v (from y) and w (from z)."""
    c, s = "cos(radians(yaw_deg))", "sin(radians(yaw_deg))"
    ct, st = "cos(radians(ins_id * 13 % 180 - 90))", "sin(radians(ins_id * 13 % 180 - 90))"
    return f"""
    select ins_id, ex, ey, ez, {c} as ux, {ct} * {s} as uy, {st} * {s} as uz, -({s}) as vx, {ct} * {c} as vy, {st} * {c} as vz,
        0e0 as wx, -({st}) as wy, {ct} as wz from instances"""


_CLOSEST = "case when abs(round(uz, 9)) >= abs(round(vz, 9)) and abs(round(uz, 9)) >= abs(round(wz, 9)) then 0 when abs(round(vz, 9)) >= abs(round(wz, 9)) then 1 else 2 end"


@plan
def m11_up_axis(d):
    """Up axis of a box: the one closest to the vertical (and whether it points
    down), or that of the least extent."""
    return f"""
    select ins_id, cast(zclose as bigint) as zclose, case zclose when 0 then uz < 0 when 1 then vz < 0 else wz < 0 end as flipped,
        cast(case when ex <= ey and ex <= ez then 0 when ey <= ez then 1 else 2 end as bigint) as largest_face
    from (select t.*, {_CLOSEST} as zclose from ({_tilted(d)}) t) z"""


@plan
def m12_align_keep(d):
    """A box stood upright with its extents kept: the up-most axis becomes z, of
    the other two the one with the larger horizontal part (the first among
    equals) gives the heading x, and y = z x x."""
    pick = lambda a, b, c: f"case zclose when 0 then {a} when 1 then {b} else {c} end"
    return f"""
    select ins_id, round(case when second then eq else ep end, 6) as ex, round(case when second then ep else eq end, 6) as ey, round(eup, 6) as ez,
        round(hx / sqrt(hx * hx + hy * hy), 6) + 0e0 as hx, round(hy / sqrt(hx * hx + hy * hy), 6) + 0e0 as hy
    from (
        select o.*, case when second then qx else px end as hx, case when second then qy else py end as hy from (
            select k.*, round(qx * qx + qy * qy, 9) > round(px * px + py * py, 9) as second from (
                select ins_id, {pick('ex', 'ey', 'ez')} as eup, {pick('ey', 'ex', 'ex')} as ep, {pick('ez', 'ez', 'ey')} as eq,
                    {pick('vx', 'ux', 'ux')} as px, {pick('vy', 'uy', 'uy')} as py, {pick('wx', 'wx', 'vx')} as qx, {pick('wy', 'wy', 'vy')} as qy
                from (select t.*, {_CLOSEST} as zclose from ({_tilted(d)}) t) z) k) o) h"""


@plan
def m13_wrap180(d):
    return f"select ins_id, {d.pmod('(yaw_deg * 5 - 900) + 180', 360)} - 180 as wrapped from instances"


@plan
def m16_compass4(d):
    return """
    select ins_id, case when abs(cx - 5) < 1e-6 and abs(cy - 5) < 1e-6 then null when abs(cx - 5) >= abs(cy - 5)
        then case when cx > 5 then 'East' else 'West' end else case when cy > 5 then 'North' else 'South' end end as label from instances"""


def apart(*pairs: tuple[str, str]) -> str:
    """No two of the boxes touch."""
    meet = [" and ".join(f"abs(c{x}_{a} - c{x}_{b}) <= (e{x}_{a} + e{x}_{b}) / 2" for x in "xyz") for a, b in pairs]
    return " and ".join(f"not ({m})" for m in meet)


def _facing(d, source: str) -> str:
    """Triples in the frame that stands at a and faces b.

    forward f is from a to b; right r = f x (0, 0, -1), or f x (1, 0, 0) where f
    is near the vertical; up = r x f; the components are those of c - a."""
    steep = "abs(fz) > 0.99e0"
    if d.name == "spark":  # each step once a row: spelled out within one another, they are hundreds of terms
        keys = "scene_id, frame_a, frame_b, ins_id_a, ins_id_b, ins_id_c"
        far = "sqrt((cx_b - cx_a) * (cx_b - cx_a) + (cy_b - cy_a) * (cy_b - cy_a) + (cz_b - cz_a) * (cz_b - cz_a)) as n"
        along = f"""{apart(('a', 'b'), ('a', 'c'), ('b', 'c'))} as apart, (cx_b - cx_a) / n as fx, (cy_b - cy_a) / n as fy, (cz_b - cz_a) / n as fz,
            cx_c - cx_a as vx, cy_c - cy_a as vy, cz_c - cz_a as vz,
            sqrt((cx_c - cx_a) * (cx_c - cx_a) + (cy_c - cy_a) * (cy_c - cy_a) + (cz_c - cz_a) * (cz_c - cz_a)) as dist"""
        right = f"""case when {steep} then 0e0 else -fy / sqrt(fx * fx + fy * fy) end as rx,
            case when {steep} then fz / sqrt(fy * fy + fz * fz) else fx / sqrt(fx * fx + fy * fy) end as ry,
            case when {steep} then -fy / sqrt(fy * fy + fz * fz) else 0e0 end as rz"""
        placed = """vx * fx + vy * fy + vz * fz as fwd, vx * rx + vy * ry + vz * rz as rgt,
            vx * (ry * fz - rz * fy) + vy * (rz * fx - rx * fz) + vz * (rx * fy - ry * fx) as up_raw"""
        return f"""
    select {keys}, apart, dist, {firm(d, placed)} from (
        select t.*, {firm(d, right)} from (
            select {keys}, {firm(d, along)} from (select q.*, {firm(d, far)} from {source} q) s where n >= 1e-6) t) r"""
    return f"""
    select scene_id, frame_a, frame_b, ins_id_a, ins_id_b, ins_id_c, apart, dist,
        vx * fx + vy * fy + vz * fz as fwd, vx * rx + vy * ry + vz * rz as rgt,
        vx * (ry * fz - rz * fy) + vy * (rz * fx - rx * fz) + vz * (rx * fy - ry * fx) as up_raw
    from (
        select t.*, case when {steep} then 0e0 else -fy / sqrt(fx * fx + fy * fy) end as rx,
            case when {steep} then fz / sqrt(fy * fy + fz * fz) else fx / sqrt(fx * fx + fy * fy) end as ry,
            case when {steep} then -fy / sqrt(fy * fy + fz * fz) else 0e0 end as rz
        from (
            select scene_id, frame_a, frame_b, ins_id_a, ins_id_b, ins_id_c, {apart(('a', 'b'), ('a', 'c'), ('b', 'c'))} as apart,
                (cx_b - cx_a) / n as fx, (cy_b - cy_a) / n as fy, (cz_b - cz_a) / n as fz,
                cx_c - cx_a as vx, cy_c - cy_a as vy, cz_c - cz_a as vz,
                sqrt((cx_c - cx_a) * (cx_c - cx_a) + (cy_c - cy_a) * (cy_c - cy_a) + (cz_c - cz_a) * (cz_c - cz_a)) as dist
            from (select *, sqrt((cx_b - cx_a) * (cx_b - cx_a) + (cy_b - cy_a) * (cy_b - cy_a)
                    + (cz_b - cz_a) * (cz_b - cz_a)) as n from {source}) s
            where n >= 1e-6) t) r"""


@view
def facing(d):
    return _facing(d, "triplets")


@view
def facing_region(d):
    return _facing(d, "two_and_region_a")


@plan
def m14_ego8(d):
    index = ego8_index(d, "rgt", "up_raw", "fwd")
    return f"""
    select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, ins_id_c as ins_c, idx, {named('idx', EGO8)} as label
    from (select f.*, {index} as idx from facing f) i"""


@plan
def m15_compass8(d):
    return f"""
    select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, ins_id_c as ins_c,
        {compass8('(cx_c - cx_b)', '(cy_c - cy_b)')} as label from triplets"""


@plan
def m17_axis_words(d):
    return f"select scene_id, frame_idx, ins_id, {axis_words('round(x, 9)', 'round(y, 9)', 'round(z, 9)', FACING_WORDS, 2)} as label from cam_objects"


@plan
def m18_local_frame(d):
    return """
    select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, ins_id_c as ins_c, round(fwd, 6) + 0e0 as fwd,
        round(rgt, 6) + 0e0 as rgt, round(up_raw, 6) + 0e0 as up, round(dist, 6) as dist from facing"""


@plan
def m21_colour_transforms(d):
    return f"""
    select l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, round((l_discount - 0.5e0) / 0.28209479177387814e0, 6) as sh,
        round(ln((l_tax + 0.01e0) / (1 - l_tax - 0.01e0)), 6) as inv_sigmoid,
        round(exp(ln(0.01e0) * (1 - l_quantity / 50e0) + ln(0.0001e0) * (l_quantity / 50e0)), 9) as lr
    from {d.table('lineitem')}"""


@plan
def m22_flying(d):
    """Depths over 0.01 off the median of the cells around them."""
    return f"""
    with g as (select l_orderkey % 50 as r, cast(l_linenumber as bigint) as c, l_suppkey % 10 as img, avg(l_discount) as depth
        from {d.table('lineitem')} group by 1, 2, 3),
    m as (select a.img, a.r, a.c, max(a.depth) as depth, median(b.depth) as med
        from g a join g b on a.img = b.img and b.r between a.r - 2 and a.r + 2 and b.c between a.c - 2 and a.c + 2 group by 1, 2, 3)
    select img, count(*) as n, count(case when abs(round(depth, 9) - round(med, 9)) > 0.01e0 then 1 end) as n_flying from m group by 1"""


@plan
def m24_camera_rays(d):
    return """
    select scene_id, frame_idx, k, round((k * 96 - 480 / 2e0) / 300, 6) as rx, round((k * 72 - 360 / 2e0) / 300, 6) as ry
    from cams cross join (select 0 as k union all select 1 as k union all select 2 as k union all select 3 as k) s"""


@plan
def m26_working_size(d):
    """Divisor 1/2/4/8 with rounding, or a width capped at 1600."""
    return f"""
    select p_partkey, case when p_size % 5 = 0 then {d.floor('(1000 + p_partkey % 3000) / greatest(1e0, (1000 + p_partkey % 3000) / 1600e0)')}
        else {d.even('(1000 + p_partkey % 3000) / (case p_size % 4 when 0 then 1e0 when 1 then 2e0 when 2 then 4e0 else 8e0 end)')} end as width
    from {d.table('part')}"""


@plan
def b01_box_formats(d):
    return """
    select distinct ins_id, frame_idx, l_orderkey, l_linenumber, l_suppkey, x + w / 2e0 as cx, y + h / 2e0 as cy, x + w as x1, y + h as y1, w * h as area,
        round(x / 1920e0, 6) as nx, round(y / 1440e0, 6) as ny from masks"""


@plan
def b03_rotated_boxes(d):
    return """
    select ins_id, round(ex * ey, 6) as area, (yaw_deg + 180) % 360 - 180 as angle,
        round(abs(cos(radians(yaw_deg))) * ex + abs(sin(radians(yaw_deg))) * ey, 6) as bound_w,
        round(abs(sin(radians(yaw_deg))) * ex + abs(cos(radians(yaw_deg))) * ey, 6) as bound_h from instances"""


@plan
def b04_polygon_area(d):
    """Shoelace over each instance's footprint."""
    corners = [(-1, -1), (1, -1), (1, 1), (-1, 1)]
    pts = [
        (
            f"(cx + cos(radians(yaw_deg)) * {sx} * ex / 2 - sin(radians(yaw_deg)) * {sy} * ey / 2)",
            f"(cy + sin(radians(yaw_deg)) * {sx} * ex / 2 + cos(radians(yaw_deg)) * {sy} * ey / 2)",
        )
        for sx, sy in corners
    ]
    terms = " + ".join(f"({a[0]} * {b[1]} - {b[0]} * {a[1]})" for a, b in zip(pts, pts[1:] + pts[:1]))
    return f"select ins_id, round(abs({terms}) / 2, 6) as area from instances"


@plan
def b08_zoom_window(d):
    """Grow by a fifth or 16 pixels, then shift inside the image."""
    return """
    select distinct ins_id, frame_idx, l_orderkey, l_linenumber, l_suppkey, greatest(0, least(x - greatest(w * 0.1e0, 16), 1920 - zw)) as zx, zw
    from (select m.*, least(1920e0, w + 2 * greatest(w * 0.1e0, 16)) as zw from masks m) z"""


@plan
def b10_color(d):
    return f"""
    select p_partkey as id, {d.idiv(d.hexint('substr(md5(p_name), 1, 2)'), 2)} + 64 as r, {d.idiv(d.hexint('substr(md5(p_name), 3, 2)'), 2)} + 64 as g,
        {d.idiv(d.hexint('substr(md5(p_name), 5, 2)'), 2)} + 64 as b from {d.table('part')}"""


@plan
def b14_heatmap_cell(d):
    return f"""
    select distinct ins_id, frame_idx, l_orderkey, l_linenumber, l_suppkey, {d.floor('least(x % 97, 96) * 56 / 97e0')} as col, {d.floor('(y % 61) * 56 / 61e0')} as row,
        x % 97 < 90 as valid from masks"""
