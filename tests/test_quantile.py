"""The exact quantile between two sketched values: that of all values in order."""

import numpy as np
import pytest

from posegrid import plans
from posegrid.functions.dialect import Spark
from posegrid.plans import filters

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("sketched", [0, 100_000])
@pytest.mark.parametrize("kind", ["spread", "equal", "two", "one", "none"])
def test_quantile_is_exact(spark, monkeypatch, sketched, kind):
    if not sketched and kind in ("two", "one", "none"):
        return  # too few rows for a sketch
    monkeypatch.setattr(filters, "SKETCHED", sketched)
    rng = np.random.default_rng(4)
    values = {"spread": rng.exponential(1e3, 30_000), "equal": np.r_[np.ones(20_000), rng.random(15_000) * 2], "two": [1.0, 5.0], "one": [3.0], "none": []}[kind]
    spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double").createOrReplaceTempView("values_of")
    got = spark.sql(filters._quantile(Spark(SF), "v", "values_of")).first()["cut"]
    assert got == (pytest.approx(np.quantile(values, 0.9), rel=1e-12) if len(values) else None)


def test_no_row_gathers_all_values(spark):
    plan = plans.run("f19_prune")(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert " percentile(" not in plan


def test_frames_are_not_made_of_boxes(spark):
    from posegrid.operators import queries

    for query in (queries.g05_box_suppression, queries.j20_assignment):
        assert "MapInPandas" not in query(spark, SF)._jdf.queryExecution().optimizedPlan().toString()
