"""Semantics on hand-made fixtures with hand-computed answers (FIXTURES.md §3)."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillcast.functions import dates as D
from tillcast.operators import enrich, features, reshape, score
from tillcast.operators.forecast import ar, gram, naive, smoothing
from tillcast.operators.ml import folds

D0 = dt.date(2020, 1, 1)


def days(n, start=D0):
    return [start + dt.timedelta(days=i) for i in range(n)]


def test_lag7_first_week_and_no_leak(spark):
    rows = [("a", d, float(i + 1)) for i, d in enumerate(days(9))] + \
           [("b", d, float(100 + i)) for i, d in enumerate(days(9))]
    df = spark.createDataFrame(rows, "item_id string, date date, v double")
    out = df.select("item_id", "date", features.lag_first_filled("v", 7).alias("l")).orderBy("item_id", "date")
    got = [(r.item_id, r.l) for r in out.collect()]
    assert [v for k, v in got if k == "a"] == [1.0] * 7 + [1.0, 2.0]
    assert [v for k, v in got if k == "b"] == [100.0] * 7 + [100.0, 101.0]


def test_real_null_lag_stays_null(spark):
    rows = [("a", d, (None if i == 1 else float(i))) for i, d in enumerate(days(10))]
    df = spark.createDataFrame(rows, "item_id string, date date, v double")
    out = df.select("date", features.lag_first_filled("v", 7).alias("l")).orderBy("date").collect()
    assert out[8].l is None and out[9].l == 2.0


def test_late_item_ffill_and_first_flag(spark):
    rows = [("a", d, 1.0) for d in days(6)] + [("b", d, (None if i < 4 else 2.0)) for i, d in enumerate(days(6))]
    df = spark.createDataFrame(rows, "item_id string, date date, p double")
    out = enrich.first_date_flag(df.withColumn("ff", features.forward_fill("p")), F.col("p").isNotNull())
    b = [r for r in out.orderBy("date").collect() if r.item_id == "b"]
    assert [r.ff for r in b] == [None] * 4 + [2.0, 2.0]
    assert [r.week_added for r in b] == [0, 0, 0, 0, 1, 0]


def test_price_band_edges(spark):
    edges = F.array(*[F.lit(x) for x in (0.0, 1.0, 2.0, 3.0, 4.0)])
    df = spark.createDataFrame([(x,) for x in (0.0, 0.5, 1.0, 1.5, 2.0, 3.0, 4.0, 5.0)], "p double")
    strict = [r.b for r in df.select(features.band(F.col("p"), edges, True).alias("b")).collect()]
    loose = [r.b for r in df.select(features.band(F.col("p"), edges, False).alias("b")).collect()]
    assert strict == ["low", "low", "low", "mid-low", "mid-low", "mid-high", "high", "low"]
    assert loose[-1] == "high"


def test_pct_change_from_zero(spark):
    # weeks 1..4 priced 0, 2, 2, 0: first 0, then 0 -> 2 is +inf -> 0, 2 -> 2 is 0, 2 -> 0 is -100
    rows = [("a", D0 + dt.timedelta(days=7 * w), w, p) for w, p in enumerate([0.0, 2.0, 2.0, 0.0])]
    df = spark.createDataFrame(rows, "item_id string, date date, wk int, p double")
    out = df.select("wk", features.pct_change("p", "week", period_col="wk").alias("c")).orderBy("wk").collect()
    assert [r.c for r in out] == [0.0, 0.0, 0.0, -100.0]


def test_half_even_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (-0.5,)], "x double")
    assert [r.r for r in df.select(F.bround("x", 0).alias("r")).collect()] == [0.0, 2.0, 2.0, -0.0]


def test_leap_day_year_ago(spark):
    cal = spark.createDataFrame([(dt.date(2000, 2, 28), 1), (dt.date(2000, 2, 29), 0)], "date date, snap_TX int")
    grid = spark.createDataFrame([("a", dt.date(2001, 2, 28)), ("a", dt.date(2001, 3, 1))], "item_id string, date date")
    out = enrich.year_ago(grid, cal, "snap_TX").orderBy("date").collect()
    assert len(out) == 2 and out[0].snap_TX_year_ago == 1 and out[1].snap_TX_year_ago is None


def test_week_edges(spark):
    ds = [dt.date(2015, 12, 31), dt.date(2016, 1, 1), dt.date(2016, 1, 3), dt.date(2016, 1, 4)]
    df = spark.createDataFrame([(d,) for d in ds], "date date")
    out = df.select(D.week_end("date").alias("we"), F.weekofyear("date").alias("iso"),
                    D.retail_wday("date").alias("wd")).collect()
    assert [r.we for r in out] == [dt.date(2016, 1, 3)] * 3 + [dt.date(2016, 1, 10)]
    assert [r.iso for r in out] == [53, 53, 53, 1]
    assert out[2].wd == 2  # a Sunday is retail weekday 2


def test_mape_floor_and_deviance(spark):
    df = spark.createDataFrame([("m", "a", D0, 0.0, 1.0), ("m", "a", D0, 2.0, 1.0)],
                               "model string, item_id string, date date, y double, yhat double")
    r = score.pooled_errors(df).first()
    assert r.mape == pytest.approx((1 / 2.220446049250313e-16 + 0.5) / 2)
    assert r.poisson_deviance == pytest.approx((2 * (0 - 0 + 1) + 2 * (2 * math.log(2) - 2 + 1)) / 2)
    df0 = spark.createDataFrame([("m", "a", D0, 1.0, 0.0)], "model string, item_id string, date date, y double, yhat double")
    assert score.pooled_errors(df0).first().poisson_deviance is None


def test_negative_forecasts(spark):
    rows = [("m", "a", d, -1.0) for d in days(3)] + [("m", "b", d, (-1.0 if i == 0 else 1.0)) for i, d in enumerate(days(3))]
    df = spark.createDataFrame(rows, "model string, item_id string, date date, mean double")
    r = score.negative_forecasts(df).first()
    assert r.items_all_negative == 1 and r.negative_rows == 4


def _series(spark, values, key="a"):
    return spark.createDataFrame([(key, d, float(v)) for d, v in zip(days(len(values)), values)],
                                 "item_id string, date date, sales_amount double")


def test_snaive_matches_brute_force(spark):
    vals = list(range(1, 31))
    fc = naive.fc_snaive(_series(spark, vals), h=10).orderBy("date").collect()
    last7 = vals[-7:]
    assert [r.mean for r in fc] == [float(last7[(h - 1) % 7]) for h in range(1, 11)]
    assert fc[0].date == D0 + dt.timedelta(days=30)


def test_drift_and_mean(spark):
    vals = [1, 3, 5, 7]
    d = naive.fc_drift(_series(spark, vals), h=2).orderBy("date").collect()
    assert [r.mean for r in d] == [9.0, 11.0]
    m = naive.fc_mean(_series(spark, vals), h=1).first()
    assert m.mean == 4.0


def test_ses_fold_matches_loop(spark):
    rng = np.random.default_rng(3)
    vals = list(rng.poisson(5, 60).astype(float))
    model = smoothing.fit(_series(spark, vals), forms=("ses",)).first()
    best = None
    for a in smoothing.ALPHAS:
        lvl, sse = vals[0], 0.0
        for v in vals:
            sse += (v - lvl) ** 2
            lvl = a * v + (1 - a) * lvl
        if best is None or sse < best[0]:
            best = (sse, lvl)
    assert model.l == pytest.approx(best[1])


def test_gram_ols_recovers_coefficients(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k in range(20):
        x = rng.normal(size=200)
        y = 2.0 + (1.5 + k * 0.1) * x + rng.normal(scale=0.01, size=200)
        rows += [(f"s{k}", float(a), float(b)) for a, b in zip(x, y)]
    df = spark.createDataFrame(rows, "item_id string, x double, y double")
    coef = gram.ols(gram.gram_sums(df, "item_id", ["x"], "y"), "item_id", 2).collect()
    for r in coef:
        k = int(r.item_id[1:])
        assert r.beta[0] == pytest.approx(2.0, abs=0.01) and r.beta[1] == pytest.approx(1.5 + k * 0.1, abs=0.01)


def test_ar_recovers_ar1(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k in range(5):
        y = [10.0]
        for _ in range(399):
            y.append(10 + 0.6 * (y[-1] - 10) + rng.normal())
        rows += [(f"s{k}", d, v) for d, v in zip(days(400), y)]
    df = spark.createDataFrame(rows, "item_id string, date date, sales_amount double")
    fc = ar.fc_ar(df, h=50).groupBy("item_id").agg(F.max_by("mean", "date").alias("far")).collect()
    for r in fc:
        assert r.far == pytest.approx(10.0, abs=1.0)  # reverts to the mean


def test_arima_tracks_moving_average_shocks(spark):
    # y_t = 10 + e_t + 0.8 e_{t-1}; the last shock is forced to +3, so the best
    # one-step forecast is 10 + 2.4 and later steps revert to the mean
    rng = np.random.default_rng(7)
    rows, theta = [], 0.8
    for k in range(4):
        e = rng.normal(size=600)
        e[-1] = 3.0
        y = 10 + e + theta * np.concatenate([[0.0], e[:-1]])
        rows += [(f"s{k}", d, float(v)) for d, v in zip(days(600), y)]
    df = spark.createDataFrame(rows, "item_id string, date date, sales_amount double")
    fc = ar.fc_arima(df, h=5).toPandas().sort_values(["item_id", "date"])
    assert len(fc) == 20 and set(fc.model) == {"arima"}
    for _, g in fc.groupby("item_id"):
        m = g["mean"].to_numpy()
        assert m[0] == pytest.approx(10 + theta * 3.0, abs=0.5)
        assert m[2] == pytest.approx(10.0, abs=0.5)


def test_dense_index_is_consecutive(spark):
    df = spark.createDataFrame([(f"k{i:03d}",) for i in range(50)] * 2, "item_id string").repartition(5)
    out = reshape.dense_index(df, "item_id", "num").orderBy("item_id").collect()
    assert [r.num for r in out] == list(range(1, 51))


def test_folds_never_train_on_future(spark):
    df = spark.createDataFrame([(d,) for d in days(100)], "date date")
    f = folds.date_folds(df, "date", 5).toPandas().sort_values("date")
    for i in range(1, 6):
        assert f[f.fold < i].date.max() < f[f.fold == i].date.min()
    assert sorted(f.fold.value_counts().to_dict().items())[1:] == [(i, 16) for i in range(1, 6)]


def test_cap_train_keeps_latest_rows(spark):
    rows = [(k, d) for d in days(5) for k in ("a", "b", "c")]
    df = spark.createDataFrame(rows, "item_id string, date date")
    kept = folds.cap_train(df, 7).collect()
    assert len(kept) == 7 and min(r.date for r in kept) == D0 + dt.timedelta(days=2)


def test_acf_matches_numpy(spark):
    from tillcast.operators import explore

    rng = np.random.default_rng(5)
    x = np.cumsum(rng.normal(size=80))
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "t int, y double")
    got = explore.acf(df, "t", "y", 5).orderBy("k").toPandas()
    e = x - x.mean()
    want = [np.sum(e[: len(e) - k] * e[k:]) / np.sum(e * e) for k in range(6)]
    assert np.allclose(got.acf.to_numpy(), want)
    assert got.band[1] == pytest.approx(1.96 / math.sqrt(80))


def test_ets_grouped_matches_jvm_fold(spark):
    rng = np.random.default_rng(11)
    t = np.arange(70)
    vals = list((5 + 0.05 * t + 2 * np.sin(2 * np.pi * t / 7) + rng.normal(size=70)).round(3))
    tr = _series(spark, vals)
    jvm = [r.mean for r in smoothing.fc_ets(tr, h=10).orderBy("date").collect()]
    grouped = [r.mean for r in smoothing.fc_ets_grouped(tr, h=10).orderBy("date").collect()]
    assert np.allclose(jvm, grouped)


def test_leaderboard_scores_absent_forecasts_as_zero(spark):
    actual = spark.createDataFrame([(k, d, y) for k, y in (("a", 2.0), ("b", 3.0)) for d in days(2)],
                                   "item_id string, date date, sales_amount double")
    fc = spark.createDataFrame([("a", d, "m", 2.0) for d in days(2)] + [("a", days(1)[0], "n", None)],
                               "item_id string, date date, model string, mean double")
    got = {r.model: r for r in score.leaderboard(fc, actual).collect()}
    assert got["m"].rmse == pytest.approx(1.5) and got["m"].n_items == 2 and got["m"].n_absent == 2
    assert got["m"].rmse_per_day == pytest.approx(3 / math.sqrt(2)) and got["m"].rmse_pooled == pytest.approx(3 / math.sqrt(2))
    assert got["n"].rmse == pytest.approx(2.5) and got["n"].mae == pytest.approx(2.5) and got["n"].n_absent == 4
    named = {r.model: r for r in score.leaderboard(fc, actual, models=["m", "n", "gone"]).collect()}
    assert named["gone"].n_absent == 4


def test_stream_scores_absent_forecasts_as_zero(spark, tmp_path):
    from tillcast.streaming import forecast_stream

    actual = spark.createDataFrame([(k, d, y) for k, y in (("a", 2.0), ("b", 3.0)) for d in days(2)],
                                   "item_id string, date date, sales_amount double")
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "m.csv").write_text("item_id,date,mean\na,2020-01-01,2.0\na,2020-01-02,2.0\n")
    r = forecast_stream.run_once(spark, str(folder), actual, str(tmp_path / "work")).first()
    assert (r.n_items, r.n_days, r.n_absent) == (2, 2, 2) and r.rmse == pytest.approx(1.5)
    assert r.rmse_pooled == pytest.approx(3 / math.sqrt(2)) and r.mae == pytest.approx(1.5)


def test_weekly_change_over_the_turn_of_a_year(spark):
    # retail week ids jump from ...52 to ...01: the week before is the one seven days earlier
    rows = [("a", D0 + dt.timedelta(days=7 * i), w, p) for i, (w, p) in enumerate([(11151, 1.0), (11152, 2.0), (11201, 4.0), (11202, 4.0)])]
    df = spark.createDataFrame(rows, "item_id string, date date, wm_yr_wk int, sell_price double")
    got = {r.wm_yr_wk: r.weekly_pct_change for r in features.pct_changes(df).collect()}
    assert got == {11151: 0.0, 11152: 100.0, 11201: 100.0, 11202: 0.0}


def test_product_age_reaches_the_calendar_end(spark):
    from conftest import SF_SMALL
    from tillcast.plans.registry import QUERIES, load_all
    from tillcast.sources.panel import SalesPanel

    load_all()
    p = SalesPanel(spark, SF_SMALL)
    n_days = p.calendar_scan().count()
    first = {r.item_id: r.d for r in p.train().filter("sales_amount > 0").groupBy("item_id").agg(F.min("date").alias("d")).collect()}
    lo = p.bounds_values()[0]
    for r in QUERIES["product_age"](spark, SF_SMALL).collect():
        assert r.product_age == n_days - ((first[r.item_id] - lo).days + 1)


def test_calendar_scan_equals_calendar(spark):
    from conftest import SF_SMALL
    from tillcast.sources.panel import SalesPanel

    p = SalesPanel(spark, SF_SMALL)
    assert sorted(map(str, p.calendar_scan().collect())) == sorted(map(str, p.calendar().collect()))


def test_describe_counts_values_first(spark):
    from tillcast.operators import explore

    df = spark.createDataFrame([(1.0,), (2.0,), (2.0,), (4.0,), (None,)], "x double")
    r = explore.describe(df, ["x"]).first()
    assert (r["count"], r["min"], r["q50"], r["max"]) == (4, 1.0, 2.0, 4.0)
    assert r["mean"] == pytest.approx(2.25) and r["std"] == pytest.approx(np.std([1, 2, 2, 4], ddof=1))


def test_group_folds_number_all_groups(spark):
    df = spark.createDataFrame([(f"g{i:02d}", d) for i in range(13) for d in days(3, D0 + dt.timedelta(days=i))], "g string, date date")
    f = {r.g: r.fold for r in folds.group_folds(df, "g", "date", 5).collect()}
    assert [f[f"g{i:02d}"] for i in range(13)] == [0] * 3 + [1, 1, 2, 2, 3, 3, 4, 4, 5, 5]


def test_all_calendar_events_are_regressors(spark):
    from tillcast.operators.forecast import decomposable

    cal = spark.createDataFrame([(d, "Fair" if i == 1 else None, "Market" if i == 2 else None) for i, d in enumerate(days(4))],
                                "date date, event_name_1 string, event_name_2 string")
    assert decomposable.holiday_names(cal) == ["Fair", "Market"]


def test_a_cluster_needs_a_shared_folder(monkeypatch):
    from types import SimpleNamespace

    from tillcast.session import checkpoint_dir

    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d),
                           sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError):
        checkpoint_dir(fake)


def test_poisson_deviance_of_every_round(spark):
    from tillcast.operators.ml import bins, leafwise

    rng = np.random.default_rng(4)
    rows = [(float(a), float(b), float(rng.poisson(np.exp(0.5 * a + (b > 0.5)))), int(k % 3)) for k, (a, b) in enumerate(rng.random((300, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, y double, fold int")
    of = bins.fit_bins(df, "y", [], ["a", "b"])
    spec = leafwise.Spec(loss="poisson", leaves=4, rounds=5, step=0.3, columns=1.0, fold=2)
    (model,), (errors,) = leafwise.fit(of.packed(df, "y", "fold"), of, [spec])
    held = [r for r in model.predict(df.where("fold = 2"), of, ["y"]).collect()]
    y, m = np.array([r.y for r in held]), np.array([r.prediction for r in held])
    want = (2 * (np.where(y > 0, y * (np.log(np.maximum(y, 1e-9)) - np.log(m)), 0) - y + m)).sum()
    assert errors[-1][3] == pytest.approx(want) and errors[0][3] > errors[1][3] and len(errors) == 6


def test_bootstrap_interval_against_brute_force(spark):
    import hashlib

    from tillcast.operators import explore

    rng = np.random.default_rng(6)
    rows = [(int(k), f"g{k % 3}", None if k == 4 else float(rng.integers(0, 50))) for k in range(90)] + [(90, "one", 7.0), (91, "none", None)]
    got = {r["g"]: r for r in explore.bootstrap_ci(spark.createDataFrame(rows, "k long, g string, y double").repartition(3), ["g"], "y", ["k"], 20).collect()}
    assert set(got) == {"g0", "g1", "g2", "one"}
    cdf = np.array(explore.poisson_one())
    for g in ("g0", "g1", "g2", "one"):
        own = [(k, y) for k, h, y in rows if h == g and y is not None]
        w = np.array([[(cdf <= int(hashlib.md5(f"0|{k}|{b}".encode()).hexdigest()[:13], 16) / 2 ** 52).sum() for b in range(1, 21)] for k, _ in own])
        y = np.array([v for _, v in own])
        means = [(w[:, b] * y).sum() / w[:, b].sum() for b in range(20) if w[:, b].sum()]
        assert got[g]["n"] == len(own) and got[g]["mean"] == pytest.approx(y.mean())
        assert [got[g]["ci_low"], got[g]["ci_high"]] == pytest.approx(list(np.quantile(means, [0.025, 0.975])))
