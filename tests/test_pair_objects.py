"""Objects of frame pairs come of one shuffle by scene; a text that names no column has all of them."""

import duckdb
import pytest

from posegrid import plans
from posegrid.operators import queries as operator_queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["j05_common_objects", "j06_objects_in_a"])
def test_objects_of_pairs_are_not_shuffled(spark, name):
    got = plans.queries()[name](spark, SF)
    con = duckdb.connect()
    for t in ("lineitem", "part"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    want = sorted(con.sql(plans.oracle_sql()[name]).fetchall())
    assert sorted(map(tuple, got.collect())) == want and want
    assert got._jdf.queryExecution().sparkPlan().toString().count("Join") == 0


def test_all_columns_where_none_is_named(spark):
    rows = operator_queries._sql(spark, SF, "select * from in_either where scene_id = 3").collect()
    places = {}
    for r in rows:
        places.setdefault((r.frame_a, r.frame_b), []).append(r.pos)
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in places.values()) and places
    assert all(r.label and r.cx is not None and (r.in_a or r.in_b) for r in rows)
