"""Vector codes against brute force and SQL, cover trees against exhaustive comparison."""

import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from tillcast.llm import vector_codes
from tillcast.llm.vector_codes import CoverTree

SF = "/root/testdata/sf0.01"


def brute_codes(rows, entries, rounds):
    """(vec_id, code, error, label_error, sha) by plain loops, lengths apart."""
    kept = [(i, lab, [math.floor(1024 * x) for x in v]) for i, v, lab in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out, by_label = [], {}
    for dims in {len(v) for *_, v in kept}:
        own = [r for r in kept if len(r[2]) == dims]
        cuts = [(k * dims // 4, (k + 1) * dims // 4) for k in range(4)]
        first = sorted(own, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
        books = [[r[2][a:b] for r in first] for a, b in cuts]
        dist = lambda x, e: sum((p - q) ** 2 for p, q in zip(x, e, strict=True))
        best = lambda x, book: min((dist(x, e), k) for k, e in enumerate(book))
        for _ in range(rounds):
            for part, (a, b) in enumerate(cuts):
                groups = {}
                for *_, v in own:
                    groups.setdefault(best(v[a:b], books[part])[1], []).append(v[a:b])
                for k, xs in groups.items():
                    books[part][k] = [sum(c) // len(xs) for c in zip(*xs, strict=True)]
        sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
        for i, lab, v in own:
            found = [best(v[a:b], books[p]) for p, (a, b) in enumerate(cuts)]
            error = sum(d for d, _ in found)
            by_label[lab] = by_label.get(lab, 0) + error
            out.append((i, "".join(f"{k:02x}" for _, k in found), min(error, 2 ** 63 - 1), lab, sha))
    return sorted(((i, c, e, min(by_label[lab], 2 ** 63 - 1), s) for i, c, e, lab, s in out), key=str)


def vectors(seed, n, dims):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.4) for _ in range(dims)] for _ in range(6)]
    rows = [(i, [c + rng.choice([0.0, 0.01, rng.gauss(0, 0.1)]) for c in rng.choice(centres)], rng.choice([0, 1, None])) for i in range(n)]
    return rows + [(10_000 + k, centres[0], 7) for k in range(60)]  # one very common vector


@pytest.mark.parametrize("kw", [{}, {"block": 37}])
def test_codes_against_brute_force(spark, kw):
    rows = vectors(1, 260, 16) + vectors(2, 30, 6) + [(None, [0.1] * 16, 1), (3, [0.2] * 16, 1), (3, [0.2] * 16, 1), (5, None, 2), (6, [None] * 16, 2),
                                                      (7, [float("nan")] + [0.0] * 15, 2), (8, [float("inf")] + [0.0] * 15, 2), (9, [], 3), (10, [1.0], 3)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, label int, code string, dims int").repartition(4)
    got = vector_codes.compress(df, entries=20, rounds=3, **kw)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, 20, 3)
    assert vector_codes.compress(df.limit(0)).count() == 0


def test_codes_beyond_floats(spark):
    rows = [(k, [3e12 * (k % 5), -1e30 * (k % 3), 0.5, k / 7.0], 1) for k in range(40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = vector_codes.compress(df, entries=4, rounds=2)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_codes(rows, 4, 2)


@pytest.mark.parametrize("seed", range(4))
def test_cover_tree(seed):
    rng = np.random.default_rng(seed)
    centres = np.floor(rng.normal(0, 300, (8, 5)))
    rows = np.floor(centres[rng.integers(0, 8, 900)] + rng.normal(0, [1, 30][seed % 2], (900, 5)))
    tree = CoverTree.load(CoverTree.build(rows).dump())
    for (lo, hi, centre, first, children), r in zip(tree.nodes, tree.radius, strict=True):  # covering, nesting
        assert np.sqrt(((tree.points[lo:hi] - tree.points[centre]) ** 2).sum(1)).max() <= r
        below = tree.nodes[first:first + children]
        assert not children or (below[0, 0], below[-1, 1]) == (lo, hi) and (below[1:, 0] == below[:-1, 1]).all()
    entries = np.vstack([rows[:40], rows[:3]])  # repeated entries: ties to the lower
    code, error = tree.codes(entries)
    square = ((rows[:, None] - entries[None]) ** 2).sum(2)
    assert (code == square.argmin(1)).all() and (error == square.min(1)).all()
    n, total = tree.sums(entries)
    assert (n == np.bincount(code, minlength=len(entries))).all()
    assert all((total[e] == rows[code == e].sum(0)).all() for e in range(len(entries)))
    if seed % 2 == 0:  # tight groups: most points are never compared
        assert len(tree.assign(centres)[0]) < len(tree.points) / 4


def test_codes_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(vector_codes.SQL).fetchall()
    got = vector_codes.compress(spark.read.parquet(f"{SF}/embeddings.parquet"))
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
