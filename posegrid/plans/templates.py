"""Question templates: one joined tuple in, one row or none out."""

from __future__ import annotations

from .bindings import of_cameras
from .geometry import EGO8, FACING_WORDS, MOTION_WORDS, apart, axis_words, compass8, ego8_index, firm, named, to_cam
from .joins import shuffled
from .registry import plan, relation, view

#: The eight compass directions, and angles of the assumed four.
COMPASS8 = ["North", "North-East", "East", "South-East", "South", "South-West", "West", "North-West"]
ASSUMED = {"north": "0e0", "east": "pi() / 2", "south": "pi()", "west": "-pi() / 2"}


def _draws(d, op: str, keys: list[str]):
    """A draw for a tag and an option."""
    return lambda tag, x: f"md5(concat_ws('|', '42', '{op}{tag}', {', '.join(f'cast({k} as {d.string})' for k in keys)}, {x}))"


def mixed(d, op: str, keys: list[str], truth: str, wrong: str) -> tuple[str, str]:
    """(options, letter): the truth among the wrong ones, in a drawn order."""
    draw = _draws(d, op, keys)
    if d.name == "spark":
        options = f"transform(array_sort(transform(array_append({wrong}, {truth}), x -> concat({draw('o', 'x')}, x))), x -> substr(x, 33))"
        letter = f"substr('ABCD', cast(array_position({options}, {truth}) as int), 1)"
    else:
        options = f"list_transform(list_sort(list_transform(list_append({wrong}, {truth}), lambda x: concat({draw('o', 'x')}, x))), lambda x: substr(x, 33))"
        letter = f"substr('ABCD', list_position({options}, {truth}), 1)"
    return d.joined(options, "/"), letter


def choices(d, op: str, keys: list[str], truth: str, pool: list[str], barred: str | None = None) -> tuple[str, str]:
    """As ``mixed``, with the first three others of the pool in a drawn order;
    ``barred`` may name one that is too near the truth."""
    return drawn_from(d, op, keys, truth, d.array(*(f"'{p}'" for p in pool)), barred)


def drawn_from(d, op: str, keys: list[str], truth: str, pool: str, barred: str | None = None) -> tuple[str, str]:
    """As ``choices``, with the pool as an array expression."""
    draw = _draws(d, op, keys)
    also = f" and coalesce(x <> {barred}, true)" if barred else ""
    keyed = d.each(d.keep(pool, "x", f"x <> {truth}{also}"), "x", f"concat({draw('w', 'x')}, x)")
    first = f"slice(array_sort({keyed}), 1, 3)" if d.name == "spark" else f"list_sort({keyed})[1:3]"
    return mixed(d, op, keys, truth, d.each(first, "x", "substr(x, 33)"))


def chosen(d, op: str, keys: list[str], source: str, pool: list[str], barred: str | None = None) -> tuple[str, str, str]:
    """(rows, options, letter): ``choices`` for the column ``label`` (not null) of a source.  For Spark, a
    fixed pool of five words or more needs no lambdas: each word's draw is spelled out and held once a row."""
    if d.name != "spark" or len(pool) < 5:
        options, letter = choices(d, op, keys, "label", pool, barred)
        return once(d, source, "x", options=options), "options", lettered(d, letter)
    known = ", ".join(f"cast({k} as {d.string})" for k in keys)
    heads = {f"of_{tag}": f"concat(concat_ws('|', '42', '{op}{tag}', {known}), '|')" for tag in "wo"}
    also = f" and coalesce('{{0}}' <> {barred}, true)" if barred else ""
    others = d.array(*(f"case when '{w}' <> label{also.format(w)} then concat(md5(concat(of_w, '{w}')), '{w}') else '~' end" for w in pool))
    drawn = d.array("concat(md5(concat(of_o, label)), label)", *(f"concat(md5(concat(of_o, substr(first[{k}], 33))), substr(first[{k}], 33))" for k in range(3)))
    rows = f"(select q.*, {firm(d, ', '.join(f'{v} as {c}' for c, v in heads.items()))} from {source} q)"
    rows = f"(select q.*, {firm(d, f'sort_array({others}) as first')} from {rows} q)"  # what may not be drawn is last
    rows = f"(select q.*, {firm(d, f'sort_array({drawn}) as last')} from {rows} q) x"
    said = [f"substr(last[{k}], 33)" for k in range(4)]
    letter = "case label " + " ".join(f"when {w} then '{x}'" for w, x in zip(said, "ABCD")) + " end"
    return rows, f"concat_ws('/', {', '.join(said)}) as options", letter


def assumed(d, op: str, *keys: str) -> str:
    names = list(ASSUMED)
    index = f"{d.hexint(f'substr({shuffled(d, op, *keys)}, 1, 4)')} % 4"
    if d.name == "spark":  # one draw a row, not one a name
        return f"get({d.array(*(repr(n) for n in names))}, cast({index} as int))"
    return named(index, names)


def angle_of(direction: str) -> str:
    return f"case {direction} " + " ".join(f"when '{n}' then {a}" for n, a in ASSUMED.items()) + " end"


def once(d, source: str, alias: str, **values: str) -> str:
    """A source with further columns.  For Spark each is a generator's, which no
    later filter or projection can spell out again wherever the column is used."""
    if d.name == "spark":
        views = " ".join(f"lateral view explode(array({v})) of_{c} as {c}" for c, v in values.items())
        return f"(select * from {source} q {views}) {alias}"
    return f"(select q.*, {', '.join(f'{v} as {c}' for c, v in values.items())} from {source} q) {alias}"


def lettered(d, letter: str) -> str:
    """The letter of the label; for Spark by its place in the joined options, which are at hand."""
    return "substr('ABCD', cast(array_position(split(options, '/'), label) as int), 1)" if d.name == "spark" else letter


_PAIR = ["scene_id", "frame_a", "frame_b"]


#: The other words offered for a motion along one axis.
OTHER_MOTIONS = {
    "left": ["right", "up", "down"], "right": ["left", "up", "down"], "forward": ["backward", "left", "right"],
    "backward": ["forward", "left", "right"], "up": ["down", "left", "right"], "down": ["up", "left", "right"],
}


@plan
def q01_main_dir(d):
    """One word: three fixed others.  Two: either or both turned round.  Three:
    each two of them."""
    label = axis_words("round(x, 9)", "round(y, 9)", "round(z, 9)", MOTION_WORDS, 3)
    words = [w for pair in MOTION_WORDS.values() for w in pair]
    across = {w: v for a, b in MOTION_WORDS.values() for w, v in ((a, b), (b, a))}
    other = lambda w: "case " + w + " " + " ".join(f"when '{x}' then '{across[x]}'" for x in words) + " end"
    texts = lambda names: d.array(*(f"'{n}'" for n in names))
    one = "case label " + " ".join(f"when '{w}' then {texts(OTHER_MOTIONS[w])}" for w in words) + f" else {texts(['right', 'up', 'down'])} end"
    two = d.array(f"concat(w1, '-', {other('w2')})", f"concat({other('w1')}, '-', w2)", f"concat({other('w1')}, '-', {other('w2')})")
    three = d.array("concat(w1, '-', w2)", "concat(w1, '-', w3)", "concat(w2, '-', w3)")
    options, letter = mixed(d, "q01", _PAIR, "label", f"case when w2 is null then {one} when w3 is null then {two} else {three} end")
    word = lambda k: f"case when {d.size('parts')} >= {k} then {d.at('parts', k)} end"
    rounded = "cam_pairs"
    if d.name == "spark":
        rounded = f"(select scene_id, frame_a, frame_b, {firm(d, 'round(x, 9) as x, round(y, 9) as y, round(z, 9) as z')} from cam_pairs)"
        label = axis_words("x", "y", "z", MOTION_WORDS, 3)
    labelled = f"select p.*, {firm(d, f'{label} as label')} from {rounded} p"
    words = f"{word(1)} as w1, {word(2)} as w2, {word(3)} as w3"
    worded = f"""select scene_id, frame_a, frame_b, label, {firm(d, words)}
          from (select l.*, split(label, '-') as parts from ({labelled}) l) s"""
    if d.name == "spark":
        return f"""
    select scene_id, frame_a, frame_b, label, options, {lettered(d, letter)} as answer
    from {once(d, f'({worded})', 'w', options=options)}"""
    return f"""
    select scene_id, frame_a, frame_b, label, {options} as options, {letter} as answer
    from ({worded}) w"""


@plan
def q02_distance_exact(d):
    return "select scene_id, frame_a, frame_b, round(sqrt(x * x + y * y + z * z), 3) as answer from cam_pairs"


@plan
def q03_distance_threshold(d):
    u = f"(0.6e0 + 0.8e0 * {d.hexint(f'substr({shuffled(d, "q03", *_PAIR)}, 1, 6)')} / 16777216e0)"
    return f"""
    select scene_id, frame_a, frame_b, round(greatest(0.05e0, dist * factor), 6) as threshold,
        case when dist > greatest(0.05e0, dist * factor) then 'yes' else 'no' end as answer
    from (select scene_id, frame_a, frame_b, dist,
            case when u > 0.85e0 and u < 1.15e0 then case when u >= 1 then 1.15e0 else 0.85e0 end else u end as factor
          from (select scene_id, frame_a, frame_b, sqrt(x * x + y * y + z * z) as dist, {u} as u from cam_pairs) p) f"""


@plan
def q04_rotation(d):
    """The two largest of yaw, pitch and roll; one or both make the answer."""
    word = {
        "yaw": ("turn right", "turn left"), "pitch": ("tilt up", "tilt down"), "roll": ("clockwise roll", "counter-clockwise roll"),
    }
    said = {a: f"case when {a} > 0 then '{p}' else '{n}' end" for a, (p, n) in word.items()}
    value = lambda col: "case " + col + " " + " ".join(f"when '{a}' then {said[a]}" for a in word) + " end"
    axes = """case when abs(yaw) >= abs(pitch) and abs(yaw) >= abs(roll) then 'yaw'
                when abs(pitch) >= abs(roll) then 'pitch' else 'roll' end as axis1,
            case when abs(yaw) < abs(pitch) and abs(yaw) < abs(roll) then 'yaw'
                when abs(pitch) < abs(roll) and abs(pitch) <= abs(yaw) then 'pitch' else 'roll' end as axis_drop,
            greatest(abs(yaw), abs(pitch), abs(roll)) as a1, least(abs(yaw), abs(pitch), abs(roll)) as a3,
            abs(yaw) + abs(pitch) + abs(roll) as total"""
    second = "case when axis1 <> 'yaw' and axis_drop <> 'yaw' then 'yaw' when axis1 <> 'pitch' and axis_drop <> 'pitch' then 'pitch' else 'roll' end as axis2"
    derived = f"total - a1 - a3 as a2, (total - a1 - a3) / (a1 + 1e-9) as ratio,\n            {second}"
    return f"""
    with a as (select scene_id, frame_a, frame_b, {firm(d, 'round(yaw, 9) as yaw, round(pitch, 9) as pitch, round(roll, 9) as roll')} from cam_pairs),
    s as (
        select a.*, {firm(d, axes)} from a),
    t as (select s.*, {firm(d, derived)} from s)
    select scene_id, frame_a, frame_b, axis1, axis2, case when a2 >= 5 and ratio >= 0.6e0 then 'dual_dominant' else 'single_dominant' end as mode,
        case when a1 >= 30 then 'easy' when a1 >= 10 then 'medium' else 'hard' end as difficulty,
        case when a2 >= 5 and ratio >= 0.6e0 then concat({value('axis1')}, ' and ', {value('axis2')}) else {value('axis1')} end as answer
    from t where a1 >= 5 and (a2 < 5 or ratio >= 0.6e0 or ratio <= 0.4e0)"""


def posed(d, both: bool = True) -> str:
    """Camera pairs with the instances that both frames of the scene of the same
    number show (or the first one does), in the axes of camera b."""
    shown = of_cameras(d) if d.derives else "observations"
    again = f"join {shown} ob on ob.scene_id = p.scene_id and ob.frame_idx = p.frame_b and ob.ins_id = oa.ins_id" if both else ""
    bx, by, bz = to_cam(("i.cx", "i.cy", "i.cz"), "b")
    kept = relation("cam_close_shown", d) if d.derives else "cam_covis"
    with_b = "" if d.derives else "join cams b on b.scene_id = p.scene_id and b.frame_idx = p.frame_b"
    return f"""
    select p.scene_id, p.frame_a, p.frame_b, i.ins_id, i.label, {bx} as x, {by} as y, {bz} as z
    from {kept} p {with_b}
    join {shown} oa on oa.scene_id = p.scene_id and oa.frame_idx = p.frame_a
    {again}
    join instances i on i.ins_id = oa.ins_id
    where p.cov > 0.25e0"""


@view
def posed_pairs(d):
    return posed(d)


@plan
def q05_center_distance(d):
    return "select scene_id, frame_a, frame_b, ins_id, round(sqrt(x * x + y * y + z * z), 1) as answer from posed_pairs"


@plan
def q06_center_direction(d):
    if d.name != "spark":
        label = axis_words("round(x, 9)", "round(y, 9)", "round(z, 9)", FACING_WORDS, 2)
        return f"""
    select scene_id, frame_a, frame_b, ins_id, {label} as label from posed_pairs where greatest(abs(x), abs(y), abs(z)) > 1e-6"""
    rounded = ", ".join(f"round({c}, 9) as {c}" for c in "xyz")
    placed = f"(select scene_id, frame_a, frame_b, ins_id, {firm(d, 'x as x, y as y, z as z')} from posed_pairs)"
    return f"""
    select scene_id, frame_a, frame_b, ins_id, {axis_words('x', 'y', 'z', FACING_WORDS, 2)} as label
    from (select scene_id, frame_a, frame_b, ins_id, {firm(d, rounded)} from {placed} p where greatest(abs(x), abs(y), abs(z)) > 1e-6) r"""


@plan
def q07_orient(d):
    """The older wording, whose vertical and depth signs are opposite."""
    return """
    select scene_id, frame_a, frame_b, ins_id, concat(case when x > 0 then 'right' else 'left' end, ', ',
        case when y > 0 then 'up' else 'down' end, ', ', case when z > 0 then 'back' else 'front' end) as label from posed_pairs"""


@plan
def q08_inter_object_distance(d):
    return """
    select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b,
        round(sqrt((cx_a - cx_b) * (cx_a - cx_b) + (cy_a - cy_b) * (cy_a - cy_b) + (cz_a - cz_b) * (cz_a - cz_b)), 6) as dist
    from objects_across"""


@plan
def q09_height_or_length(d):
    coin = f"{d.hexint(f'substr({shuffled(d, "q09", *_PAIR, "ins_id_a", "ins_id_b")}, 1, 1)')} % 2"
    la, lb = "greatest(ex_a, ey_a, ez_a)", "greatest(ex_b, ey_b, ez_b)"
    za, zb = "(cz_a - ez_a / 2)", "(cz_b - ez_b / 2)"
    return f"""
    select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, case when coin = 1 then 'length' else 'height' end as variant,
        case when coin = 1 then case when abs(round({la} - {lb}, 9)) < 1e-3 then 'same' when {la} > {lb} then label_a else label_b end
             else case when abs(round({za} - {zb}, 9)) < 1e-3 then 'same' when {za} < {zb} then label_a else label_b end end as answer
    from (select o.*, {coin} as coin from objects_across o) c"""


def _cross(d, source: str, op: str) -> str:
    """Where the second one is, if the first is in the assumed direction; the
    second one's vector from camera b, in the axes of camera a."""
    cams, hint = "cams", ""
    if d.derives:  # only frames that are shown: few, whatever the number of cameras
        cams = "(select c.* from cams c left semi join (select distinct frame_idx from observations) f on f.frame_idx = c.frame_idx)"
        hint = "/*+ broadcast(a), broadcast(b) */ "
    x1, _, z1 = to_cam(("s.cx_a", "s.cy_a", "s.cz_a"), "a")
    x2, _, z2 = to_cam(("(s.cx_b - b.tx)", "(s.cy_b - b.ty)", "(s.cz_b - b.tz)"), "a", rotate_only=True)
    turned = f"""(select * from (
            select {hint}s.scene_id, s.frame_a, s.frame_b, s.ins_id_a as ins_a, s.ins_id_b as ins_b, s.dir,
                {x1} as x1, {z1} as z1, {x2} as x2, {z2} as z2
            from {once(d, source, 's', dir=assumed(d, op, 'scene_id', 'frame_a', 'frame_b', 'ins_id_a', 'ins_id_b'))}
            join {cams} a on a.scene_id = s.scene_id % 10 and a.frame_idx = s.frame_a
            join {cams} b on b.scene_id = s.scene_id % 10 and b.frame_idx = s.frame_b) u
        where abs(x1) >= 1e-6 or abs(z1) >= 1e-6)"""
    placed = "round(x2 * sin(delta) + z2 * cos(delta), 9) as fwd,\n            round(x2 * cos(delta) - z2 * sin(delta), 9) as rgt"
    return f"""
    select scene_id, frame_a, frame_b, ins_a, ins_b, dir, {compass8('rgt', 'fwd')} as label from (
        select scene_id, frame_a, frame_b, ins_a, ins_b, dir, {firm(d, placed)}
        from {once(d, turned, 'v', delta=f"atan2(x1, z1) - ({angle_of('dir')})")}) w
    where greatest(abs(rgt), abs(fwd)) >= 1e-6"""


@plan
def q10_cross_direction(d):
    return _cross(d, "objects_across", "q10")


@plan
def q11_region_cross_direction(d):
    return _cross(d, "regions_across", "q11")


@plan
def q12_region_object_cross_direction(d):
    return _cross(d, "object_region_across", "q12")


_TRIPLE = ["scene_id", "frame_a", "frame_b", "ins_id_a", "ins_id_b", "ins_id_c"]


def _proxy(d, source: str, op: str, options: bool = True) -> str:
    """Where c is from b, if a is in the assumed direction from b (in plan); without ``options`` only the rows' keys."""
    keys = ["scene_id", "frame_a", "frame_b", "ins_a", "ins_b", "ins_c"]
    free = f"""(select * from {source} where {apart(('a', 'b'), ('a', 'c'), ('b', 'c'))}
        and sqrt((cx_a - cx_b) * (cx_a - cx_b) + (cy_a - cy_b) * (cy_a - cy_b)) >= 1e-6)"""
    aimed = once(d, free, "s", dir=assumed(d, op, *_TRIPLE))
    turned = once(d, f"(select * from {aimed})", "v", delta=f"atan2(cy_a - cy_b, cx_a - cx_b) - ({angle_of('dir')})")
    placed = """round((cx_c - cx_b) * cos(delta) + (cy_c - cy_b) * sin(delta), 9) as fwd,
            round(-(cx_c - cx_b) * sin(delta) + (cy_c - cy_b) * cos(delta), 9) as rgt"""
    named8 = f"""(select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, ins_id_c as ins_c, dir,
            {firm(d, placed)} from {turned})"""
    labelled = f"(select * from {once(d, named8, 'w', label=compass8('rgt', 'fwd'))} where label is not null)"
    if not options:
        return f"select {', '.join(keys)} from {labelled} x"
    rows, options, letter = chosen(d, op, keys, labelled, COMPASS8)
    return f"""
    select scene_id, frame_a, frame_b, ins_a, ins_b, ins_c, dir, label, {options}, {letter} as answer
    from {rows}"""


@plan
def q13_proxy_direction(d):
    return _proxy(d, "triplets", "q13")


@plan
def q14_region_proxy_direction(d):
    return _proxy(d, "two_and_region_b", "q14")


def _relpos(d, source: str, op: str, options: bool = True) -> str:
    """Standing at a and facing b, where c is; the neighbouring direction is not
    offered within three degrees of the border to it.  Without ``options`` only the rows' keys."""
    index = ego8_index(d, "rgt", "up_raw", "fwd")
    keys = ["scene_id", "frame_a", "frame_b", "ins_a", "ins_b", "ins_c"]
    faced = f"(select * from {source} where apart)"
    if not options:
        return f"select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, ins_id_c as ins_c from {faced} f where {index} is not null"
    placed = f"(select * from {once(d, faced, 'f', idx=index, turn='round(degrees(atan2(rgt, fwd)), 9)')} where idx is not null)"
    off = once(d, placed, "o", off=f"turn - 45 * idx - 360 * {d.floor('(turn - 45 * idx + 180) / 360')}")
    near = f"case when off >= 19.5e0 then {d.pmod('idx + 1', 8)} when off <= -19.5e0 then {d.pmod('idx + 7', 8)} end"
    words = f"(select * from {once(d, f'(select * from {off})', 'n', label=named('idx', EGO8), barred=named(near, EGO8))})"
    keyed = f"(select scene_id, frame_a, frame_b, ins_id_a as ins_a, ins_id_b as ins_b, ins_id_c as ins_c, dist, label, barred from {words} l)"
    rows, options, letter = chosen(d, op, keys, keyed, EGO8, "barred")
    return f"""
    select scene_id, frame_a, frame_b, ins_a, ins_b, ins_c, label, {options}, {letter} as answer, round(dist, 6) as dist
    from {rows}"""


#: The rows of templates whose options cost more than the rows do.
KEYS = {
    "q13_proxy_direction": lambda d: _proxy(d, "triplets", "q13", False), "q14_region_proxy_direction": lambda d: _proxy(d, "two_and_region_b", "q14", False),
    "q15_relpos": lambda d: _relpos(d, "facing", "q15", False), "q16_region_relpos": lambda d: _relpos(d, "facing_region", "q16", False),
}


@plan
def q15_relpos(d):
    return _relpos(d, "facing", "q15")


@plan
def q16_region_relpos(d):
    """Q15 with a region for the third."""
    return _relpos(d, "facing_region", "q16")
