"""Whole question rows: text, options and answer of every template in use.

A row's text holds {A}, {B} and {C} for its instances until one join puts their
labels in.  Marked objects are shown by mask overlays: red, green, blue.
"""

from __future__ import annotations

from . import templates as t
from .geometry import FACING_WORDS
from .registry import plan, view

#: The overlays' wording and the answers on sizes are the output's own.
_NONE = "cast(null as bigint)"
_METERS = "Answer with one number, in meters: <answer>NUMBER</answer>."
_OVERLAYS = "In image A, a red mask overlay indicates {A}.\nIn image B, a green mask overlay indicates {B}.\n"
_THREE = "A red mask overlay indicates {A}, a green one {B}, a blue one {C}.\n"
_TURNS = {"yaw": ("turn right", "turn left"), "pitch": ("tilt up", "tilt down"), "roll": ("clockwise roll", "counter-clockwise roll")}


def decimals(d, x: str, places: int) -> str:
    return f"cast(cast(round({x}, {places}) as decimal(18, {places})) as {d.string})"


def listed(d, options: str = "options") -> str:
    """The options of a slash-joined list, a lettered line each."""
    lines = ", ".join(f"'\n{letter}. ', {d.at(f'split({options}, ' + chr(39) + '/' + chr(39) + ')', k)}" for k, letter in enumerate("ABCD", 1))
    return f"concat({lines})"


def _pooled(source: str, pool: str) -> str:
    return f"select s.*, {pool} as pool from ({source}) s"


def _rotations(d) -> str:
    """Both signs of both axes: in twos where both count, else one by one."""
    said = lambda col, k: f"case {col} " + " ".join(f"when '{a}' then '{w[k]}'" for a, w in _TURNS.items()) + " end"
    p1, n1, p2, n2 = said("axis1", 0), said("axis1", 1), said("axis2", 0), said("axis2", 1)
    both = d.array(*(f"concat({x}, ' and ', {y})" for x in (p1, n1) for y in (p2, n2)))
    every = f"case when mode = 'dual_dominant' then {both} else {d.array(p1, n1, p2, n2)} end"
    return _pooled(t.q04_rotation(d), every)


def _facings(d) -> str:
    """One word: its opposite and a pair across; two: either or both turned."""
    turned = {w: v for a, b in FACING_WORDS.values() for w, v in ((a, b), (b, a))}
    across = lambda w: ("Up", "Down") if w in FACING_WORDS["x"] else ("Left", "Right")
    one = "case label " + " ".join(f"when '{w}' then {d.array(*(repr(x) for x in (turned[w], *across(w))))}" for w in turned) + " end"
    other = lambda w: f"case {w} " + " ".join(f"when '{x}' then '{y}'" for x, y in turned.items()) + " end"
    two = d.array(f"concat(w1, '-', {other('w2')})", f"concat({other('w1')}, '-', w2)", f"concat({other('w1')}, '-', {other('w2')})")
    second = f"case when {d.size('parts')} > 1 then {d.at('parts', 2)} end"
    source = f"""
    select p.*, {d.at('parts', 1)} as w1, {second} as w2 from (select q.*, split(label, '-') as parts from ({t.q06_center_direction(d)}) q) p"""
    wrong = f"case when w2 is null then {one} else {two} end"
    return _pooled(source, wrong)


def _sizes(d) -> str:
    """Either object, both alike, or no telling."""
    source = f"""
    select q.scene_id, q.frame_a, q.frame_b, q.ins_a, q.ins_b, q.variant, case when q.answer = 'same' then concat('Both are about the same ', q.variant)
        when q.answer = i.label then '{{A}}' else '{{B}}' end as label
    from ({t.q09_height_or_length(d)}) q join instances i on i.ins_id = q.ins_a"""
    every = d.array("'{A}'", "'{B}'", "concat('Both are about the same ', variant)", "'Cannot tell'")
    return _pooled(source, every)


def _cross(d, name: str) -> str:
    return _pooled(getattr(t, name)(d), d.array(*(f"'{c}'" for c in t.COMPASS8)))


def count_texts(d) -> list[str]:
    """How many rows each template has by kind, a text a template; nothing is drawn that no row depends on."""
    return lead_texts(d, "select question_type, sub_question_type, count(*) as n from ({}) l group by 1, 2")


def lead_texts(d, counted: str | None = None) -> list[str]:
    """Each template's rows, a text a template: the question up to its options,
    what is true, and the options (or the texts to choose them from).  ``counted`` is a text on the
    rows' kinds alone."""
    rows = []

    def add(kind, sub, source, lead, truth, *items, form="marked", given=False, tail="''"):
        if counted:
            rows.append(counted.format(f"select '{kind}' as question_type, {sub} as sub_question_type from ({source}) r"))
            return
        a, b, c = (*(f"cast({i} as bigint)" for i in items), _NONE, _NONE, _NONE)[:3]
        options, letter = ("options", "answer") if given else (f"cast(null as {d.string})",) * 2
        pool = f"cast(null as {d.strings})" if given or form == "plain" else "pool"
        rows.append(f"""
        select {len(rows)} as ord, '{kind}' as question_type, {sub} as sub_question_type, cast(scene_id as bigint) as scene_id,
            cast(frame_a as bigint) as frame_a, cast(frame_b as bigint) as frame_b, {a} as ins_a, {b} as ins_b, {c} as ins_c,
            '{form}' as form, {lead} as lead, {tail} as tail, {truth} as truth, {options} as given, {letter} as given_letter, {pool} as pool
        from ({source}) r""")

    # every covisible pair of cameras has a main direction and a distance
    every = "select scene_id, frame_a, frame_b from cam_pairs"
    add("cam_translation", "'main_dir'", every if counted else t.q01_main_dir(d),
        "'Seen in the axes of view A, in which main direction does the camera move from view A to view B?'", "label",
        form="letter", given=True, tail="'\nReply with the option letter only (A/B/C/D).'")
    add("cam_translation", "'distance_exact'", t.q02_distance_exact(d),
        "'How far does the camera move from view A to view B (meters)?'", decimals(d, "answer", 3), form="plain")
    add("cam_translation", "'distance_threshold'", t.q03_distance_threshold(d),
        f"concat('From the camera transforms alone: is the distance between the camera centers of view A and view B more than ', {decimals(d, 'threshold', 2)}, ' meters? Answer <answer>yes</answer> or <answer>no</answer>.')",
        "answer", form="plain")
    add("cam_rotation", "concat(axis1, '+', axis2, '_', mode)", _rotations(d),
        "concat('Take the rotation from view A to view B in the camera frame of view A. ', case when mode = 'dual_dominant' then concat('Which option gives both of its parts, ', axis1, ' and ', axis2, '?') else concat('Which single direction is the largest, of ', axis1, ' and ', axis2, '?') end)",
        "answer", form="letter")
    add("object_distance", "'bbox_center_distance'", t.q05_center_distance(d),
        f"'In image A, a red mask overlay indicates {{A}}.\nHow far is the center of the same object from the camera of image B? {_METERS}'",
        f"concat({decimals(d, 'answer', 1)}, ' m')", "ins_id", form="plain")
    add("object_direction", "'bbox_center_direction'", _facings(d),
        "'In image A, a red mask overlay indicates {A}.\nIn which direction is it from you as you take image B?'", "label", "ins_id")
    add("object_distance", "'inter_object_distance'", t.q08_inter_object_distance(d),
        f"'{_OVERLAYS}How far apart are the centers of the two objects? {_METERS}'", f"concat({decimals(d, 'dist', 2)}, ' m')", "ins_a", "ins_b", form="plain")
    add("object_height_or_length", "case when variant = 'length' then 'longest_side_compare' else 'top_height_compare' end", _sizes(d),
        f"concat('{_OVERLAYS}', case when variant = 'length' then 'Which one is longer, by its longest side?' else 'Which one is taller, by its top?' end)",
        "label", "ins_a", "ins_b")
    crosses = (
        ("object_cross_direction", "cross_image_assumed_dir", "q10_cross_direction"),
        ("region_cross_direction", "cross_image_assumed_dir_region_region", "q11_region_cross_direction"),
        ("region_object_cross_direction", "cross_image_assumed_dir_object_region", "q12_region_object_cross_direction"),
    )
    for kind, sub, name in crosses:
        lead = f"concat('{_OVERLAYS}Take {{A}} to be ', dir, ' of image A. In which direction is {{B}} from image B?')"
        add(kind, f"'{sub}'", _cross(d, name), lead, "label", "ins_a", "ins_b")
    proxy = f"concat('{_THREE}Take {{A}} to be ', dir, ' of {{B}}. In which direction is {{C}} from {{B}}?')"
    stand = f"'{_THREE}You stand at {{A}} and face {{B}}. In which direction is {{C}} from you?'"
    for kind, sub, name, lead in (
        ("object_proxy_direction", "proxy_object_direction", "q13_proxy_direction", proxy),
        ("region_proxy_direction", "proxy_object_region_direction", "q14_region_proxy_direction", proxy),
        ("object_relpos", "relpos_A_facing_B", "q15_relpos", stand),
        ("region_relpos", "relpos_A_facing_B_region_C", "q16_region_relpos", stand),
    ):
        source = t.KEYS[name](d) if counted else getattr(t, name)(d)
        add(kind, f"'{sub}'", source, lead, "label", "ins_a", "ins_b", "ins_c", given=True)
    return rows


@view
def question_leads(d):
    return " union all ".join(lead_texts(d))


@view
def question_bodies(d):
    """Leads with their options drawn: the truth and three others of the pool."""
    keys = ["sub_question_type", "scene_id", "frame_a", "frame_b", "ins_a", "ins_b", "ins_c"]
    options, letter = t.drawn_from(d, "qa", keys, "truth", "pool")
    return f"""
    select o.*, case when form = 'plain' then lead else concat(lead, {listed(d)}, tail) end as question,
        case form when 'plain' then truth when 'letter' then letter else concat(letter, '. ', truth) end as answer
    from (select l.*, case when pool is null then given else {options} end as options,
              case when pool is null then given_letter else {letter} end as letter from question_leads l) o"""


@view
def question_rows(d):
    """The rows with their labels put in."""
    filled = lambda x: f"replace(replace(replace({x}, '{{A}}', coalesce(a.label, '')), '{{B}}', coalesce(b.label, '')), '{{C}}', coalesce(c.label, ''))"
    return f"""
    select q.ord, q.question_type, q.sub_question_type, q.scene_id, q.frame_a, q.frame_b, q.ins_a, q.ins_b, q.ins_c,
        {filled('q.question')} as question, {filled('q.answer')} as answer
    from question_bodies q left join instances a on a.ins_id = q.ins_a left join instances b on b.ins_id = q.ins_b
    left join instances c on c.ins_id = q.ins_c"""


@plan
def u01_recipe_union(d):
    """All templates' rows by kind and scene: how many, and a sum of digests of
    question and answer."""
    digest = d.hexint("substr(md5(concat(question, '|', answer)), 1, 8)")
    return f"""
    select question_type, sub_question_type, scene_id, count(*) as n, cast(sum({digest}) as bigint) as digest
    from question_rows group by 1, 2, 3"""


@plan
def a13_type_rollup(d):
    return """
    select coalesce(question_type, '*') as type, coalesce(sub_question_type, '*') as sub, count(*) as n
    from question_leads group by rollup (question_type, sub_question_type)"""
