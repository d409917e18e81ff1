"""Secret scans against brute force and SQL."""

import hashlib
import math
import random
import re
import string
from collections import Counter

import duckdb
import pytest

from tillcast.llm import secrets

SF = "/root/testdata/sf0.01"
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
PLAIN = [("access", re.compile("AKIA[A-Z0-9]+"), 16), ("hex", re.compile("[0-9a-f]+"), 32)]


def base_spans(text):
    out = [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    for k, (_, p, least) in enumerate(PLAIN, 1):
        out += [(m.start(), k, m.end(), m.group()) for m in p.finditer(text) if len(m.group()) >= least]
    return sorted(out)


def brute(texts, margin=secrets.MARGIN):
    kinds = ["assign", "access", "hex", "markov"]
    found = []
    for text in texts:
        base = base_spans(text or "")
        rest = list(text or "")
        for a, _, b, _ in base:
            rest[a:b] = " " * (b - a)
        found.append((base, [(m.start(), m.end(), m.group()) for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", "".join(rest))]))
    strings = {1: Counter(s for b, _ in found for *_, s in b), 0: Counter(t for _, ts in found for *_, t in ts if 3 * len(re.findall("[A-Z]?[a-z]+|[A-Z]+|[0-9]+", t)) <= len(t))}
    code = lambda c: secrets.ALPHABET.find(c) + 1
    n = secrets.CODES
    logs = {}
    for cls, ss in strings.items():
        count = [[0] * n for _ in range(n)]
        for s, times in ss.items():
            for a, b in zip(" " + s, s, strict=False):
                count[code(a)][code(b)] += times.bit_length()
        even = secrets.EVEN * cls
        logs[cls] = [[math.log((1 - even) * (x + secrets.SMOOTHING / n) / (sum(r) + secrets.SMOOTHING) + even / n) for x in r] for r in count]
    least = margin + math.log((len(strings[0]) + 1) / (len(strings[1]) + 1))
    ratio = lambda s: sum(logs[1][code(a)][code(b)] - logs[0][code(a)][code(b)] for a, b in zip(" " + s, s, strict=False))
    out = []
    for base, tokens in found:
        added = [(a, 3, b) for a, b, s in tokens if ratio(s) >= least]
        show = lambda spans: ",".join(f"{kinds[k]}:{a}:{b}" for a, k, b in sorted(spans))
        base = [x[:3] for x in base]
        out.append((*(sum(x[1] == k for x in base) for k in range(3)), hashlib.sha256(show(base).encode()).hexdigest(), show(base + added), len(added)))
    return out


def corpus(seed=3):
    rng = random.Random(seed)
    pick = lambda alphabet, n: "".join(rng.choices(alphabet, k=n))
    word = lambda: rng.choice(["internationalization", "getElementsByClassName", "some_long_identifier", "é", "a", "face", "b4d", "antidisestablishment", "🙂 x", "HTTPConnectionPool", "secret", "token"])
    parts = ["get", "set", "user", "name", "value", "index", "buffer", "stream", "handler", "request", "result", "manager", "config", "module", "service"]
    identifier = lambda: rng.choice(["_", "", "-"]).join(rng.choice([str, str.title])(rng.choice(parts)) for _ in range(5))
    kinds = [lambda: f"password={pick(string.ascii_letters + string.digits, rng.choice([5, 8, 20]))}", lambda: f'API_key" :  "{pick(string.hexdigits, 18)}"',
             lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, rng.choice([3, 11, 12, 16])), lambda: pick("0123456789abcdef", rng.choice([31, 32, 40])),
             lambda: "ghp" + pick(string.ascii_letters + string.digits, 36) if rng.random() < 0.3 else "none", lambda: "secret:token:abcdefghij", lambda: "Token = 'abc.def-ghi'", lambda: "xAKIAAKIA" + pick("AKI", 9)]
    texts = [" ".join(rng.choice(kinds)() if rng.random() < 0.2 else rng.choice([word, identifier])() for _ in range(rng.choice([0, 1, 5, 40, 90]))) for _ in range(150)]
    texts += [None, "", " ", "é" * 50 + "password=abcdefgh", "ſecret=abcdefghijk passworD:abcdefghi", "toKen=12345678\n" * 300, texts[3], texts[3]]
    texts.append("".join(f"{pick(string.ascii_lowercase, 3)} {pick('0123456789abcdef', 33)} " for _ in range(1200)))  # a long text with many matches
    return texts


def test_secrets_against_brute_force(spark):
    texts = corpus()
    ids = [None if i == 7 else min(i, 20) for i in range(len(texts))]
    rows = [(d, t, 5, "x", i) for i, (d, t) in enumerate(zip(ids, texts, strict=True))]
    df = spark.createDataFrame(rows, "doc_id long, text string, base int, rest string, kind int").repartition(3)
    want = brute(texts)
    got = secrets.find_secrets(df).collect()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(str((d, *w)) for d, w in zip(ids, want, strict=True))
    planted = [w for t, w in zip(texts, want, strict=True) if t and re.search(r"(?<![a-z])ghp[A-Za-z0-9]{36}", t)]
    assert len(planted) > 20 and all(w[5] for w in planted)
    assert not any(w[5] for t, w in zip(texts, want, strict=True) if t and not re.search("ghp|[0-9a-f]{31}|AKIA|ſecret=", t))  # ordinary words


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string"
    assert secrets.find_secrets(spark.createDataFrame([], schema)).count() == 0
    got = secrets.find_secrets(spark.createDataFrame([(1, "plain words"), (2, None)], schema)).collect()
    assert sorted(tuple(r) for r in got) == [(d, *w) for d, w in zip((1, 2), brute(["plain words", None]), strict=True)]


def test_no_python_in_plan(spark):
    df = spark.createDataFrame([(1, "password=abcdefgh0")], "doc_id long, text string")
    for frame in (secrets.scanned(df), secrets.find_secrets(df)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|MapIn", plan)


@pytest.mark.parametrize("token, random_like", [("getElementsByClassName", False), ("wJalrXUtnFEMIK7MDENGbPxRfiCYzEXA", True)])
def test_ratio_tells_apart(spark, token, random_like):
    from pyspark.sql import functions as F
    found = secrets.scanned(spark.createDataFrame([(i, t) for i, t in enumerate(corpus())], "doc_id long, text string"))
    counts, strings = secrets.pair_counts(found)
    r = spark.range(1).select(secrets.ratio(F.lit(token), secrets.log_ratios(counts))).head()[0]
    assert (r >= secrets.threshold(strings)) == random_like


def test_secrets_equal_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    want = con.execute(secrets.SQL).fetchall()
    got = secrets.find_secrets(spark.read.parquet(f"{SF}/documents.parquet"))
    assert got.columns == [d[0] for d in con.description]
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got.collect())
