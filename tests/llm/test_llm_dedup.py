"""Exact dedup, repeated strings and the shingle join against brute force."""

import hashlib
import random
import re

import pyspark.sql.functions as F
import pytest

from tillcast.llm import exact_dedup, jaccard, repeats

SCHEMA = "doc_id long, text string, keep_id string, name string, row string, n string"


def frame(spark, rows, parts=3):
    """Rows (doc_id, text) with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "x", None, "y", "z") for i, t in rows], SCHEMA).repartition(parts)


def brute_exact(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = {}
    for i, t in norm:
        groups.setdefault(t, []).append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        flags = [False] * len(ids)
        flags[ids.index(keep)] = True
        out += [(i, keep, len(ids), f, hashlib.sha256(t.encode()).hexdigest()) for i, f in zip(ids, flags, strict=True)]
    return sorted(out, key=str)


def edge_rows():
    rng = random.Random(1)
    long = "".join(rng.choice("abc \n") for _ in range(900))
    rows = [(1, None), (2, ""), (3, " "), (4, "\n\t"), (5, "a b"), (6, "a\t\nb"), (6, "a b"), (7, long), (8, long + "x"),
            (9, "y" + long), (10, long), (None, "a b"), (None, "only"), (None, "only"), (11, "é" * 300), (12, "é" * 299 + "e")]
    return rows + [(100 + k, long[: rng.randint(0, 40)]) for k in range(60)]


@pytest.mark.parametrize("block", [4, 16, 4096])
def test_exact_dedup_is_grouping_by_normalised_text(spark, block):
    rows = edge_rows()
    got = exact_dedup.exact_dedup(frame(spark, rows), block_bytes=block).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_exact(rows)


def test_exact_dedup_empty_table(spark):
    assert exact_dedup.exact_dedup(frame(spark, [(1, "a")]).limit(0)).count() == 0


def test_keep_first_keeps_rows_and_columns(spark):
    rows = edge_rows()
    kept = exact_dedup.keep_first(frame(spark, rows))
    assert kept.columns == ["doc_id", "text", "keep_id", "name", "row", "n"]
    texts = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({r[4] for r in brute_exact(rows)})


def brute_links(rows, percent, width):
    sets = {}
    for i, t in rows:
        words = [bytes(c + 32 if 65 <= c <= 90 else c for c in w) for w in re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())]
        sets[i] = set() if not words else {tuple(words[k:k + width]) for k in range(max(1, len(words) - width + 1))}
    up = {i: i for i in sets}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if y < x and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                up[max(a, b)] = min(a, b)
    return sorted((i, len(sets[i]), find(i)) for i in ids)


def near_rows():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)] + ["É", "été", "A", "a"]
    rows = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(rng.choice([1, 2, 3, 20, 60, 200]))]
        for _ in range(rng.choice([1, 2, 12])):
            d = list(base)
            for _ in range(rng.choice([0, 1, 2, len(base) // 20])):
                d[rng.randrange(len(d))] = rng.choice(words)
            rows.append((len(rows) * 7 % 1009, rng.choice([" ", "\n", " \t"]).join(d)))
    return rows + [(2001, None), (2002, ""), (2003, " \n"), (2004, " lead"), (2005, "LEAD ")]


@pytest.mark.parametrize("percent, kw", [(90, {}), (90, {"slice_sets": 3}), (60, {"slice_sets": 4, "slice_shingles": 400})])
def test_jaccard_components(spark, percent, kw):
    rows = near_rows()
    got = jaccard.jaccard_components(frame(spark, rows), percent=percent, **kw).collect()
    assert sorted(tuple(r) for r in got) == brute_links(rows, percent, 3)


def test_jaccard_repeated_and_missing_ids(spark):
    text = " ".join(f"t{i}" for i in range(40))
    got = jaccard.jaccard_components(frame(spark, [(5, text), (5, text), (None, text + " end"), (9, "other")])).collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted([(5, 38, 5), (5, 38, 5), (None, 39, 5), (9, 1, 9)], key=str)
    assert jaccard.jaccard_components(frame(spark, [(1, "a")]).limit(0)).count() == 0


def near_copies(n, words=200, seed=1):
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(words)]
    out = []
    for _ in range(n):
        d = list(base)
        d[rng.randrange(words)] = f"v{rng.randrange(10 ** 6)}"
        out.append(" ".join(d))
    return out


def test_near_copies_give_a_link_each(spark):
    rows = list(enumerate(near_copies(600)))
    links = jaccard.candidate_links(frame(spark, rows, 24), 90)
    assert links.count() < 2 * 600
    assert jaccard.components(links).select("comp").distinct().count() == 1


def test_keep_one_goes_by_row(spark):
    a, b, c = near_copies(3)
    other = " ".join(f"o{i}" for i in range(50))
    rows = [(7, a), (7, other), (None, b), (None, "alone"), (3, c), (3, c), (3, "short"), (4, None), (4, None), (5, ""), (None, None)]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key_0 string, place_0 int").repartition(3)
    got = jaccard.keep_one(df)
    assert got.columns == df.columns
    want = [(7, other), (None, "alone"), (3, c), (3, "short"), (4, None), (4, None), (5, ""), (None, None)]
    assert sorted(((r[0], r[1]) for r in got.collect()), key=str) == sorted(want, key=str)
    assert jaccard.keep_one(df.limit(0)).count() == 0


def test_many_texts_under_one_id(spark):
    texts = near_copies(60) + [f"only {k} words here now" for k in range(40)]
    rows = [(1, t) for t in texts] + [(None, t) for t in texts]
    got = jaccard.jaccard_components(frame(spark, rows))
    assert got.count() == 200 and got.where("component_id = 1 or component_id is null").count() == 200
    assert jaccard.keep_one(frame(spark, rows)).count() == 41


def test_linked_sets_share_a_part():
    import numpy as np

    rng = np.random.default_rng(0)
    for _ in range(300):
        n = int(rng.integers(5, 400))
        a = np.unique(rng.integers(0, 1 << 62, n, dtype=np.uint64))
        b = np.unique(np.concatenate([a[rng.random(len(a)) > rng.random() * 0.1], rng.integers(0, 1 << 62, int(rng.integers(0, 1 + n // 12)), dtype=np.uint64)]))
        i = jaccard.common(a, b)
        if 100 * i < 90 * (len(a) + len(b) - i) or i == len(a) == len(b):
            continue
        named = []
        for s in (a, b):
            k = jaccard.size_class(len(s), 90)
            named.append({int(x) for scheme in (k, k + 1) if jaccard.part_count(scheme, 90)[1] for x in jaccard.part_names(s, scheme, 90)})
        assert named[0] & named[1]


def brute_repeats(rows, length):
    texts = [(i, (t or "").encode()) for i, t in rows]
    times = {}
    for _, b in texts:
        for s in range(len(b) - length + 1):
            times[b[s:s + length]] = times.get(b[s:s + length], 0) + 1
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if times[b[s:s + length]] > 1:
                gone[s:s + length] = b"\1" * length
        spans = sum(1 for j in range(len(b)) if gone[j] and (j == 0 or not gone[j - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)))
    return sorted(out, key=str)


def repeat_rows():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefg h") for _ in range(n))
    passages = [text(rng.randint(10, 120)) for _ in range(20)]
    rows = []
    for i in range(150):
        parts = []
        for _ in range(rng.randint(0, 8)):
            p = rng.choice(passages)
            parts.append(p[rng.randint(0, len(p) // 2):] if rng.random() < 0.6 else text(rng.randint(0, 60)))
        rows.append((i, "".join(parts)))
    return rows + [(1000, None), (1001, ""), (1002, "a" * 300), (1003, "ab" * 100), (1004, "é" * 90), (1004, "é" * 90), (None, rows[5][1])]


@pytest.mark.parametrize("length, gram, sizes", [(40, 12, {}), (20, 20, {}), (50, 3, {}), (40, 12, {"chunk_bytes": 500, "slot_chunks": 2}),
                                                 (40, 12, {"chunk_bytes": 1, "slot_chunks": 1})])
def test_repeats(spark, length, gram, sizes):
    rows = repeat_rows()
    out = repeats.remove_repeats(frame(spark, rows, 7), length, gram, **sizes)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    got = out.select("doc_id", "n_bytes", removed, F.size("spans"), "kept").collect()
    assert sorted(((r[0], r[1], r[2], r[3], bytes(r[4])) for r in got), key=str) == brute_repeats(rows, length)


def test_repeats_one_byte_short_is_not_removed(spark):
    rng = random.Random(8)
    word = "".join(rng.choice("abcdefghij") for _ in range(200))
    rows = [(1, "1" + word + "2"), (2, "3" + word), (3, "4" + word[:199] + "5")]
    got = {r["doc_id"]: r["n_removed"] for r in repeats.query(frame(spark, rows)).collect()}
    assert got == {1: 200, 2: 200, 3: 0}
    assert repeats.query(frame(spark, rows).limit(0)).count() == 0
