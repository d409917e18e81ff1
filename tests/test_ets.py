"""Smoothing forms: recursion against a plain loop, forms picked on data simulated from them, edge series."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest

from tillcast.operators.forecast import ets, series


def simulate(rng, form, n, alpha=0.3, beta=0.05, gamma=0.2, phi=0.9, season=7, noise=1.0):
    level, trend = 60.0, 1.0 if form[1] != "N" else 0.0
    phi = phi if form[1] == "D" else 1.0
    shape = np.array([-9, -6, 0, 3, 12, 6, -6.0])
    s = {"N": np.zeros(7), "A": shape.copy(), "M": 1 + shape / 30}[form[2]]
    out = []
    for t in range(n):
        q = level + phi * trend
        f = q * s[t % season] if form[2] == "M" else q + s[t % season]
        e = rng.normal(0, noise) if form[0] == "A" else f * rng.normal(0, 0.03)
        ls, lq = (s[t % season], q) if form[2] == "M" else (1, 1)
        out.append(f + e)
        level, trend = q + alpha * e / ls, phi * trend + (beta * e / ls if form[1] != "N" else 0)
        s[t % season] += gamma * e / lq if form[2] != "N" else 0
    return np.array(out)


@pytest.mark.parametrize("form", ets.FORMS)
def test_recursion(form):
    rng = np.random.default_rng(1)
    y = simulate(rng, form, 40)[None]
    stack = ets.Stack(y, [form], 7)
    theta = rng.normal(0, 0.5, (1, 6))
    fit, err, (level, trend, s, _) = stack.errors(y, theta)
    a, b, g, phi, lv, tr = (x[0] for x in stack.parameters(theta, 1))
    season = stack.s0[0].copy()
    for t in range(40):
        q, now = lv + phi * tr, season[t % 7]
        f = q * now if form[2] == "M" else q + now
        e = y[0, t] - f
        assert np.isclose(fit[0, t], f) and np.isclose(err[0, t], e)
        if form[2] == "M":
            lv, tr, season[t % 7] = q + a * e / now, phi * tr + b * e / now, now + g * e / q
        else:
            lv, tr, season[t % 7] = q + a * e, phi * tr + b * e, now + g * e
    assert np.isclose(level[0], lv) and np.isclose(trend[0], tr) and np.allclose(s[0], season)


@pytest.mark.parametrize("want", ["ANN", "AAN", "ANA", "AAA", "MNM", "MAM"])
def test_form_is_picked(want):
    rng = np.random.default_rng(2)
    many = np.stack([simulate(rng, want, 300, beta=0.01 if want[0] == "M" else 0.05) for _ in range(12)])
    assert want[2] != "M" or (many > 0).all()
    _, chosen = ets.fit_batch(many, 7, 7)
    # the season must be the one simulated; the error too where the season is multiplicative
    assert sum(c[2] == want[2] for c in chosen) >= 9
    assert sum((c[1] == "N") == (want[1] == "N") for c in chosen) >= 8
    if want[2] == "M":
        assert sum(c[0] == "M" for c in chosen) >= 9


def test_damped_trend_is_picked():
    rng = np.random.default_rng(3)
    many = np.stack([simulate(rng, "ADN", 300, alpha=0.5, beta=0.4, phi=0.85) for _ in range(12)])
    _, chosen = ets.fit_batch(many, 7, 7, ["ANN", "AAN", "ADN"])
    assert chosen.count("ADN") >= 8


def test_optimiser_is_no_worse_than_a_grid():
    rng = np.random.default_rng(4)
    y = np.stack([simulate(rng, "ANN", 200, alpha=a) for a in (0.1, 0.4, 0.8)])
    stack = ets.Stack(y, ["ANN"] * 3, 7)
    start = np.zeros((3, 6))
    _, sse = ets.least_squares(stack.residuals, y, start, ets.NO_ORDER, 7, ets.STEPS)
    sse *= stack.unit ** 2
    for i in range(3):
        best = np.inf
        for alpha in np.linspace(0.01, 0.99, 50):
            level, total = stack.level[i], 0.0
            for v in y[i]:
                total += (v - level) ** 2
                level += alpha * (v - level)
            best = min(best, total)
        assert sse[i] <= best * 1.001


def test_runs_cross_frames():
    pdf = pd.DataFrame({"k": list("aaabbbbcd"), "v": range(9)})
    for cut in (1, 2, 3, 4, 9):
        got = [(r["k"].iloc[0], r["v"].tolist()) for r in series.runs((pdf.iloc[i:i + cut] for i in range(0, 9, cut)), "k")]
        assert got == [("a", [0, 1, 2]), ("b", [3, 4, 5, 6]), ("c", [7]), ("d", [8])]
    assert [len(b) for b in series.batches(iter([pdf, pdf.iloc[:0]]), "k", 3)] == [3, 1]


def test_every_series_gets_a_forecast(spark):
    rng = np.random.default_rng(5)
    start = dt.date(2020, 1, 1)
    rows = [("season", start + dt.timedelta(days=t), float(v)) for t, v in enumerate(simulate(rng, "AAA", 120))]
    rows += [("zeros", start + dt.timedelta(days=t), 0.0) for t in range(50)] + [("one", start, 3.0), ("two", start, 1.0), ("two", start + dt.timedelta(days=1), 3.0)]
    rows += [("none", start, None), (None, start, 1.0)] + [("gap", start + dt.timedelta(days=t), None if t % 3 else 2.0) for t in range(30)]
    df = spark.createDataFrame(rows, "item_id string, date date, sales_amount double").repartition(3)
    got = ets.fc_ets(df, h=7).toPandas()
    assert set(got["item_id"]) == {"season", "zeros", "one", "two", "gap"} and len(got) == 35 and got["mean"].notna().all()
    mean = got.groupby("item_id")["mean"].mean()
    assert np.isclose(mean["one"], 3) and np.isclose(mean["two"], 2) and np.isclose(mean["zeros"], 0, atol=1e-6) and np.isclose(mean["gap"], 2, atol=1e-6)
    assert got[got["item_id"] == "season"]["form"].iloc[0][2] == "A" and got[got["item_id"] == "one"]["form"].isna().all()
    assert ets.fc_ets(df.where("false"), h=7).count() == 0
