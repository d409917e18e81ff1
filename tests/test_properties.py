"""Property tests (hypothesis) on small generated panels."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillcast.operators import features, reshape

D0 = dt.date(2021, 3, 1)

panels = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 20),
              st.one_of(st.none(), st.floats(0, 100, allow_nan=False).map(lambda x: round(x, 2)))),
    min_size=1, max_size=40, unique_by=lambda t: (t[0], t[1]))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(panels)
def test_forward_fill_never_crosses_items(spark, rows):
    data = [(k, D0 + dt.timedelta(days=d), v) for k, d, v in rows]
    df = spark.createDataFrame(data, "item_id string, date date, p double")
    got = {(r.item_id, r.date): r.ff for r in
           df.select("item_id", "date", features.forward_fill("p").alias("ff")).collect()}
    for k in {r[0] for r in data}:
        last = None
        for _, d, v in sorted(x for x in data if x[0] == k):
            last = v if v is not None else last
            assert got[(k, d)] == last


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.integers(0, 9), min_size=3, max_size=3), min_size=1, max_size=6))
def test_pivot_of_unpivot_is_identity(spark, mat):
    wide = spark.createDataFrame([(f"id{i}", *[float(v) for v in row]) for i, row in enumerate(mat)],
                                 "id string, d_1 double, d_2 double, d_3 double")
    long = reshape.melt(wide, ["id"], prefix="d_")
    back = reshape.pivot_wide(long, "id", "d", "sales", ["d_1", "d_2", "d_3"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_result_independent_of_partitioning(spark):
    from conftest import SF_SMALL
    from tillcast.operators.forecast import naive
    from tillcast.sources.panel import SalesPanel

    tr = SalesPanel(spark, SF_SMALL).train()
    a = sorted(map(tuple, naive.naive_family(tr.repartition(1)).collect()))
    b = sorted(map(tuple, naive.naive_family(tr.repartition(13, "date")).collect()))
    assert a == b
    assert tr.select("item_id").distinct().count() * 28 * 4 == len(a)
    assert F is not None
