"""One SQL text for two engines.

Relational plans are written once, as functions of a dialect; ``Spark`` renders
the text that Catalyst plans over the Parquet tables, ``Duck`` the twin that
checks it.  Only spelling differs: integer division, array functions, rounding.
"""

from __future__ import annotations


class Spark:
    """Renders over ``parquet.`path` `` relations; no view is registered."""

    name = "spark"
    string, double, bigint, strings = "string", "double", "bigint", "array<string>"

    def __init__(self, sf_dir: str, derives: bool = True):
        """``derives``: whether texts may name relations made by Python of whole tables."""
        self.sf_dir, self.derives = sf_dir, derives

    def table(self, name: str) -> str:
        return f"parquet.`{self.sf_dir}/{name}.parquet`"

    def idiv(self, a: str, b: str | int) -> str:
        return f"(({a}) div ({b}))"

    def floor(self, x: str) -> str:
        return f"cast(floor({x}) as bigint)"

    def even(self, x: str) -> str:
        """Rounding half to even, to a whole number."""
        return f"cast(bround({x}, 0) as bigint)"

    def pmod(self, a: str, b: str | int) -> str:
        return f"pmod({a}, {b})"

    def array(self, *items: str) -> str:
        return f"array({', '.join(items)})"

    def each(self, items: str, var: str, body: str) -> str:
        return f"transform({items}, {var} -> {body})"

    def keep(self, items: str, var: str, body: str) -> str:
        return f"filter({items}, {var} -> {body})"

    def fold(self, items: str, start: str, acc: str, var: str, body: str) -> str:
        return f"aggregate({items}, {start}, ({acc}, {var}) -> {body})"

    def at(self, items: str, place: str | int) -> str:
        """Element from 1."""
        return f"element_at({items}, {place})"

    def size(self, items: str) -> str:
        return f"cast(size({items}) as bigint)"

    def steps(self, low: str, high: str) -> str:
        return f"sequence({low}, {high})"

    def gather(self, value: str, order: str) -> str:
        """A group's values, in the order of a key."""
        return f"transform(array_sort(collect_list(struct({order} as o, {value} as v))), x -> x.v)"

    def joined(self, items: str, sep: str) -> str:
        return f"array_join({items}, '{sep}')"

    def best(self, value: str, by: str) -> str:
        return f"max_by({value}, {by})"

    def least(self, value: str, by: str) -> str:
        return f"min_by({value}, {by})"

    def row(self, *pairs: str) -> str:
        return f"struct({', '.join(pairs)})"

    def unfold(self, source: str, items: str, alias: str) -> str:
        return f"{source} LATERAL VIEW explode({items}) ex AS {alias}"

    def hexint(self, text: str) -> str:
        return f"cast(conv({text}, 16, 10) as bigint)"

    def replace_all(self, text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, r'{pattern}', r'{by}')"

    def extract(self, text: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract({text}, r'{pattern}', {group})"

    def matches(self, text: str, pattern: str) -> str:
        return f"regexp_like({text}, r'{pattern}')"

    def split(self, text: str, pattern: str) -> str:
        return f"split({text}, r'{pattern}')"

    def words_of(self, text: str, pattern: str) -> str:
        return f"regexp_extract_all({text}, r'{pattern}', 0)"

    def try_int(self, text: str) -> str:
        return f"try_cast({text} as bigint)"

    def finite(self, x: str) -> str:
        return f"(not isnan({x}) and abs({x}) < double('infinity'))"

    def as_json(self, pairs: dict[str, str]) -> str:
        inner = ", ".join(f"{v} as {k}" for k, v in pairs.items())
        return f"to_json(struct({inner}))"


class Duck(Spark):
    """The same texts for DuckDB, over views named as the tables."""

    name = "duck"
    string, strings = "varchar", "varchar[]"

    def __init__(self):
        super().__init__("", False)

    def table(self, name: str) -> str:
        return name

    def idiv(self, a: str, b: str | int) -> str:
        return f"(({a}) // ({b}))"

    def even(self, x: str) -> str:
        return f"cast(round_even({x}, 0) as bigint)"

    def pmod(self, a: str, b: str | int) -> str:
        return f"((({a}) % ({b}) + ({b})) % ({b}))"

    def array(self, *items: str) -> str:
        return f"[{', '.join(items)}]"

    def each(self, items: str, var: str, body: str) -> str:
        return f"list_transform({items}, lambda {var}: {body})"

    def keep(self, items: str, var: str, body: str) -> str:
        return f"list_filter({items}, lambda {var}: {body})"

    def fold(self, items: str, start: str, acc: str, var: str, body: str) -> str:
        return f"list_reduce(list_prepend({start}, {items}), lambda {acc}, {var}: {body})"

    def at(self, items: str, place: str | int) -> str:
        return f"list_extract({items}, {place})"

    def size(self, items: str) -> str:
        return f"cast(len({items}) as bigint)"

    def steps(self, low: str, high: str) -> str:
        return f"range({low}, ({high}) + 1)"

    def gather(self, value: str, order: str) -> str:
        return f"list({value} order by {order})"

    def joined(self, items: str, sep: str) -> str:
        return f"array_to_string({items}, '{sep}')"

    def best(self, value: str, by: str) -> str:
        return f"arg_max({value}, {by})"

    def least(self, value: str, by: str) -> str:
        return f"arg_min({value}, {by})"

    def row(self, *pairs: str) -> str:
        return f"row({', '.join(pairs)})"

    def unfold(self, source: str, items: str, alias: str) -> str:
        return f"(select *, unnest({items}) as {alias} from {source})"

    def hexint(self, text: str) -> str:
        return f"cast(concat('0x', {text}) as bigint)"

    def replace_all(self, text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, '{pattern}', '{by}', 'g')"

    def extract(self, text: str, pattern: str, group: int = 0) -> str:
        return f"regexp_extract({text}, '{pattern}', {group})"

    def matches(self, text: str, pattern: str) -> str:
        return f"regexp_matches({text}, '{pattern}')"

    def split(self, text: str, pattern: str) -> str:
        return f"regexp_split_to_array({text}, '{pattern}')"

    def words_of(self, text: str, pattern: str) -> str:
        return f"regexp_extract_all({text}, '{pattern}')"

    def finite(self, x: str) -> str:
        return f"isfinite({x})"

    def as_json(self, pairs: dict[str, str]) -> str:
        inner = ", ".join(f"'{k}', {v}" for k, v in pairs.items())
        return f"cast(json_object({inner}) as varchar)"
