"""Conversation prefix trie against brute force and SQL."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from tillcast.llm import conv_trie

SF = "/root/testdata/sf0.01"
SCHEMA = "conv_id long, turn long, role string, text string, depth string, path int, id int"


def brute_trie(rows):
    """Node rows by plain dictionaries of whole prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]
            convs.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    members = {}
    ends = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        turns = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
        ends.setdefault(tuple(turns), []).append(c)
    out = []
    for node, ids in members.items():
        below = [m for m in members if m[:len(node)] == node]
        leaf = [m for m in below if not any(len(x) == len(m) + 1 and x[:len(m)] == m for x in below)]
        saved = sum((len(members[m]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", m[-1][1])) for m in below if m)
        digest = hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest()
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids),
                    sum(len(m) == len(node) + 1 for m in below), len(leaf), saved, digest))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("kw", [{}, {"shard_turns": 3, "piece_ids": 2}])
def test_trie_against_brute_force(spark, kw):
    rng = random.Random(4)
    rows = []
    for c in range(-30, 130):
        for t in range(rng.choice([0, 1, 1, 2, 3, 4, 6])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "assistant", None]), rng.choice(["a b", "a  b\tc", "", None, "é x"])))
    rows += [(1000 + k, t, "user", "copy of one") for k in range(60) for t in range(5)]  # a hot conversation
    rows += [(5000, t, "user", f"long {t % 7}") for t in range(120)]
    rows += [(None, 0, "user", "nobody"), (7, 3, "user", "twice"), (7, 3, "user", "twice")]
    got = sorted((tuple(r) for r in conv_trie.prefix_trie(table(spark, rows), **kw).collect()), key=str)
    assert got == brute_trie(rows)


def test_empty_and_turnless(spark):
    assert conv_trie.prefix_trie(table(spark, []).limit(0)).count() == 0
    only = [(3, 0, "u", "gone")]  # crc32 takes turns of an absent first conversation
    assert zlib.crc32(b"3") % 4 > 0
    assert [tuple(r)[:7] for r in conv_trie.prefix_trie(table(spark, only)).collect()] == [(3, 0, None, 1, 0, 1, 0)]


def test_splitters_cover_shared_nodes():
    paths = sorted([[bytes([a, b])] * n for a in range(5) for b in range(5) for n in range(4)])
    cuts = conv_trie.splitters([(p, k) for k, p in enumerate(paths)], 7)
    assert 1 <= len(cuts) <= 6 and cuts == sorted(cuts)
    trie = conv_trie.skeleton([p for p, _ in cuts])
    assert all(parent < child for (parent, _), child in trie.items())


def test_trie_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    want = con.execute(conv_trie.SQL).fetchall()
    got = conv_trie.prefix_trie(spark.read.parquet(f"{SF}/conversations.parquet"))
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
