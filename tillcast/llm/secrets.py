"""Secret scans: fixed patterns, and character Markov models by log-likelihood ratio (DataFrame functions only).

Two models of character pairs are counted from labelled strings of the corpus
itself: what the patterns catch (passwords, keys, hexadecimal digests) stands
for random strings, other long tokens made of words or numbers of some length
for ordinary identifiers; tokens in between label nothing. Any token outside
the pattern matches is a secret where its
log-likelihood ratio reaches a margin above the odds of the two classes.

Scale: a text is scanned once, in its own row, and only tokens and positions
are kept, in a written table. Labelled strings are shuffled
(counted map-side) and then pair counts, at most two tables of
CODES x CODES numbers; these come to the driver and go back as one literal.
Positions are running sums of piece lengths taken in blocks, so a text with a
million matches costs a few hundred additions for each of them, not a million.
"""

from __future__ import annotations

import math
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import written


def any_case(word: str) -> str:
    """A pattern for ``word`` with ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# Fixed values of the base patterns: (kind, pattern, counted group, its least length). Where the whole match counts, the
# length stands in the pattern, which finds the same spans: a run that is too short holds no longer one.
WORDS = "|".join(any_case(w) for w in ("password", "passwd", "secret", "token", "api_?key"))
BASE = [
    ("assign", rf"""({WORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", "AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", "[0-9a-f]{32,}", 0, 32),
]

#: Strings of which every match of a kind holds one, and where to look for them.
HINTS = {
    "assign": [("lower", w) for w in ("passw", "secret", "token", "api")],
    "access": [("text", "AKIA")],
}

#: Kind of the spans that the models add.
MODEL = "markov"
#: Characters of a token, the least length of one that is judged.
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
MIN_TOKEN = 16
TOKEN = rf"[A-Za-z0-9+/_=-]{{{MIN_TOKEN},}}"
#: States of the chains: 0 stands before the first character and for characters outside the alphabet.
CODES = len(ALPHABET) + 1
#: Pairs added to each state's counts, spread evenly; nats that a ratio must reach above the odds of the classes.
SMOOTHING, MARGIN = 32.0, 10.0
#: Share of the even chain in the model of random strings: those that no pattern labels may use any alphabet.
EVEN = 0.25

#: Parts of an identifier (a word, capitals, a number); a token labels itself ordinary where its parts are LONG characters on average.
PARTS, LONG = "[A-Z]?[a-z]+|[A-Z]+|[0-9]+", 3

_BLOCK = 64


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def _blocks(values: Column) -> Column:
    """Sums of runs of _BLOCK values."""
    count = F.ceil(F.size(values) / _BLOCK).cast("int")
    one = lambda b: _sum(F.slice(values, b * _BLOCK + 1, _BLOCK))
    return F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), one)).otherwise(F.array().cast("array<int>"))


def _before(values: Column, ones: Column, twos: Column, i: Column) -> Column:
    """Sum of the first i values; ``ones`` are sums of _BLOCK values, ``twos`` sums of _BLOCK of those."""
    one, two = F.floor(i / _BLOCK).cast("int"), F.floor(i / _BLOCK ** 2).cast("int")
    return (_sum(F.slice(twos, F.lit(1), two)) + _sum(F.slice(ones, two * _BLOCK + 1, one - two * _BLOCK))
            + _sum(F.slice(values, one * _BLOCK + 1, i - one * _BLOCK)))


def with_matches(df: DataFrame, text: str, pattern: str, name: str, group: int = 0) -> DataFrame:
    """``df`` with an array ``name`` of (start, end, text, part): all leftmost non-overlapping matches, in code points.

    ``part`` is the given group of the pattern. The pieces between the matches
    stay in a column ``name_pieces``, which is null where there is no match.
    A null text has no matches.
    """
    pieces, whole, step, ones, twos = (f"{name}_{x}" for x in ("pieces", "whole", "step", "ones", "twos"))
    lit = F.lit(pattern)
    df = df.withColumn(whole, F.coalesce(F.regexp_extract_all(text, lit, F.lit(0)), F.array().cast("array<string>")))
    some = F.size(whole) > 0
    part = F.regexp_extract_all(text, lit, F.lit(group)) if group else F.col(whole)
    both = F.zip_with(whole, part, lambda m, p: F.struct(m.alias("text"), p.alias("part")))
    df = df.withColumns({pieces: F.when(some, F.split(text, pattern, -1)), name: F.when(some, both).otherwise(F.array().cast("array<struct<text:string,part:string>>"))})
    # a piece and the match after it; arrays meet by zip_with, since an expression inside a lambda runs once an element
    df = df.withColumn(step, F.coalesce(F.zip_with(pieces, whole, lambda p, m: F.length(p) + F.coalesce(F.length(m), F.lit(0))), F.array().cast("array<int>")))
    df = df.withColumn(ones, _blocks(F.col(step)))
    df = df.withColumn(twos, _blocks(F.col(ones)))

    def place(m, i):
        end = _before(F.col(step), F.col(ones), F.col(twos), i + 1)
        return F.struct((end - F.length(m["text"])).alias("start"), end.alias("end"), m["text"].alias("text"), m["part"].alias("part"))
    return df.withColumn(name, F.transform(name, place)).drop(whole, step, ones, twos)


def blanked(pieces: Column, matches: Column, least: int) -> Column:
    """The text with all matches whose part has ``least`` characters replaced by as many blanks."""
    fill = lambda m: F.when(F.length(m["part"]) >= least, F.repeat(F.lit(" "), F.length(m["text"]))).otherwise(m["text"])
    return F.array_join(F.zip_with(pieces, matches, lambda p, m: F.concat(p, F.coalesce(fill(m), F.lit("")))), "")


def _long_enough(matches: Column, least: int, kind: int) -> Column:
    """(start, kind, end, secret) of the matches whose part has ``least`` characters."""
    kept = F.filter(matches, lambda m: F.length(m["part"]) >= least)
    return F.transform(kept, lambda m: F.struct(m["start"].alias("start"), F.lit(kind).alias("kind"), m["end"].alias("end"), m["part"].alias("secret")))


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, base array of (start, kind, end, secret), tokens array of (start, end, text)), one row per document.

    kind is the position in BASE; tokens lie outside all base spans.
    """
    df = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    df = df.withColumns({"rest": F.col("text"), "lower": F.lower("text")})
    spans = []
    for k, (kind, pattern, group, least) in enumerate(BASE):
        # a plain search tells most texts apart before the pattern is tried
        hints = [F.col(c).contains(w) for c, w in HINTS.get(kind, [])]
        df = df.withColumn("tried", F.when(reduce(or_, hints), F.col("text")) if hints else F.col("text"))
        df = with_matches(df, "tried", pattern, kind, group)
        spans.append(_long_enough(F.col(kind), least, k))
        if k == 0:
            df = df.withColumn("rest", F.coalesce(blanked(F.col(f"{kind}_pieces"), F.col(kind), least), "rest"))
        else:  # the later kinds are blanked in what the earlier ones left
            df = with_matches(df.withColumn("again", F.when(F.size(kind) > 0, F.col("rest"))), "again", pattern, f"{kind}_rest", group)
            df = df.withColumn("rest", F.coalesce(blanked(F.col(f"{kind}_rest_pieces"), F.col(f"{kind}_rest"), least), "rest"))
    df = with_matches(df, "rest", TOKEN, "found")
    tokens = F.transform("found", lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"), m["text"].alias("text")))
    return df.select("doc_id", F.sort_array(F.concat(*spans)).alias("base"), tokens.alias("tokens"))


def _numbers(values: list) -> Column:
    """A literal array, folded once a query."""
    return F.split(F.lit(",".join(map(repr, values))), ",").cast("array<double>")


def codes(text: Column) -> Column:
    """The states of a string's characters."""
    place = {c: k + 1 for k, c in enumerate(ALPHABET)}
    of = F.split(F.lit(",".join(str(place.get(chr(b), 0)) for b in range(128))), ",").cast("array<int>")
    return F.transform(F.split(text, ""), lambda c: F.coalesce(F.get(of, F.ascii(c)), F.lit(0)))


def pair_counts(found: DataFrame) -> tuple[dict[tuple[int, int, int], int], dict[int, int]]:
    """Counts of (class, state, next state), and of distinct strings per class; class 1: caught by a pattern, 0: ordinary tokens.

    A string that occurs n times weighs as much as n has binary digits: words
    that recur are ordinary, but copies of one document must not make the
    model. At most 2 x CODES x CODES numbers come back.
    """
    of = lambda column, field, cls: found.select(F.lit(cls).alias("cls"), F.explode(F.transform(column, lambda x: x[field])).alias("s"))
    ordinary = of("tokens", "text", 0).where(F.regexp_count("s", F.lit(PARTS)) * LONG <= F.length("s"))
    labelled = of("base", "secret", 1).unionByName(ordinary).groupBy("cls", "s").agg(F.length(F.bin(F.count("*"))).alias("weight"))
    state = codes(F.col("s"))
    step = F.transform(state, lambda c, i: F.coalesce(F.when(i > 0, F.get(F.col("state"), i - 1)), F.lit(0)) * CODES + c)
    pairs = labelled.withColumn("state", state).select("cls", "weight", F.explode(step).alias("pair"))
    rows = pairs.groupBy("cls", "pair").agg(F.sum("weight").alias("count")).collect()
    strings = {r[0]: r[1] for r in labelled.groupBy("cls").count().collect()}
    return {(r["cls"], *divmod(r["pair"], CODES)): r["count"] for r in rows}, strings


def log_ratios(counts: dict[tuple[int, int, int], int]) -> list[float]:
    """ln P(next | state) of random strings minus that of identifiers, at state * CODES + next."""
    def chain(cls, even):
        out = []
        for a in range(CODES):
            row = [counts.get((cls, a, b), 0) for b in range(CODES)]
            total = sum(row) + SMOOTHING
            out += [math.log((1 - even) * (n + SMOOTHING / CODES) / total + even / CODES) for n in row]
        return out
    return [r - w for r, w in zip(chain(1, EVEN), chain(0, 0.0), strict=True)]


def threshold(strings: dict[int, int], margin: float = MARGIN) -> float:
    """The margin above the log odds of an ordinary token."""
    return margin + math.log((strings.get(0, 0) + 1) / (strings.get(1, 0) + 1))


def ratio(token: Column, table: list[float]) -> Column:
    """Log-likelihood ratio of a token: the sum over its characters, in order."""
    numbers = _numbers(table)
    start = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("sum"))
    return F.aggregate(codes(token), start, lambda s, c: F.struct(c.alias("at"), (s["sum"] + F.get(numbers, s["at"] * CODES + c)).alias("sum")),
                       lambda s: s["sum"])


def _joined(spans: Column) -> Column:
    names = [k for k, *_ in BASE] + [MODEL]
    name = F.array(*map(F.lit, names))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"], s["end"])), ",")


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: float = MARGIN) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov``.

    A span is kind:start:end over the whole match, in code points, end
    exclusive; spans go by start, then by kind in the order of BASE, the
    models' own last. Base matches are leftmost and non-overlapping for each
    kind; those that are too short are dropped (what they covered is still
    judged as a token). Null text is empty. Rows that repeat an id, or have
    none, are documents of their own. Without any labelled string the random
    model is uniform; without tokens nothing is added; an empty table gives
    an empty result. Other columns are not read, so their names cannot clash.
    """
    found = written(scanned(docs, id_col, text_col), "secrets")
    counts, strings = pair_counts(found)
    table, least = log_ratios(counts), threshold(strings, margin)
    added = F.filter("tokens", lambda t: ratio(t["text"], table) >= least)
    span = lambda s, k: F.struct(s["start"].alias("start"), k.alias("kind"), s["end"].alias("end"))
    out = found.select("doc_id", F.transform("base", lambda s: span(s, s["kind"])).alias("base"),
                       F.transform(added, lambda t: span(t, F.lit(len(BASE)))).alias("added"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    return out.select("doc_id", *(count(k).alias(f"n_{kind}") for k, (kind, *_) in enumerate(BASE)),
                      F.sha2(_joined(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                      _joined(F.sort_array(F.concat("base", "added"))).alias("spans"), F.size("added").cast("long").alias("n_markov"))


def _sql() -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"

    def matched(name, source, pattern, group):
        """Pieces, matches and parts of a text, one row per document."""
        part = f"regexp_extract_all(text, {quote(pattern)}, {group})"
        return (f"{name} AS MATERIALIZED (SELECT row, regexp_extract_all(text, {quote(pattern)}) AS ms, {part} AS gs, "
                f"regexp_split_to_array(text, {quote(pattern)}) AS ps FROM {source})")

    def placed(name, source):
        return (f"{name} AS MATERIALIZED (SELECT row, m, g, stop - length(m) AS start, stop FROM (SELECT *, sum(length(p) + length(m)) OVER (PARTITION BY row ORDER BY i) AS stop "
                f"FROM (SELECT row, unnest(range(len(ms))) AS i, unnest(ms) AS m, unnest(gs) AS g, unnest(ps[:len(ms)]) AS p FROM {source} WHERE len(ms) > 0)))")

    parts, rest = ["d AS MATERIALIZED (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS text FROM documents)"], "d"
    for k, (_, pattern, group, least) in enumerate(BASE):
        parts += [matched(f"m{k}", "d", pattern, group), placed(f"h{k}", f"m{k}"), matched(f"q{k}", rest, pattern, group),
                  f"r{k} AS MATERIALIZED (SELECT row, array_to_string(list_transform(range(1, len(ps) + 1), lambda i: ps[i] || CASE WHEN i > len(ms) THEN '' "
                  f"WHEN length(gs[i]) >= {least} THEN repeat(' ', length(ms[i])) ELSE ms[i] END), '') AS text FROM q{k})"]
        rest = f"r{k}"
    base = " UNION ALL ".join(f"SELECT row, start, {k} AS kind, stop, g FROM h{k} WHERE length(g) >= {least}" for k, (*_, least) in enumerate(BASE))
    names = " ".join(f"WHEN {k} THEN '{n}'" for k, n in enumerate([b[0] for b in BASE] + [MODEL]))
    parts += [
        matched("mt", rest, TOKEN, 0), placed("tok", "mt"), f"base AS ({base})",
        f"strings AS (SELECT cls, s, length(bin(count(*))) AS weight FROM (SELECT 1 AS cls, g AS s FROM base UNION ALL SELECT 0, m FROM tok WHERE len(regexp_extract_all(m, '{PARTS}')) * {LONG} <= length(m)) GROUP BY ALL)",
        f"chars AS (SELECT cls, s, weight, unnest(range(length(s))) AS i, unnest(list_transform(string_split(s, ''), lambda c: strpos({quote(ALPHABET)}, c))) AS b FROM strings)",
        "pairs AS (SELECT cls, s, weight, coalesce(lag(b) OVER (PARTITION BY cls, s ORDER BY i), 0) AS a, b FROM chars)",
        "counts AS (SELECT cls, a, b, sum(weight)::BIGINT AS n FROM pairs GROUP BY ALL)",
        f"grid AS (SELECT c.range AS cls, a.range AS a, b.range AS b FROM range(2) c, range({CODES}) a, range({CODES}) b)",
        f"logs AS (SELECT cls, a, b, ln((1 - {EVEN}::DOUBLE * cls) * (coalesce(n, 0) + {SMOOTHING}::DOUBLE / {CODES}) / (sum(coalesce(n, 0)) OVER (PARTITION BY cls, a) + {SMOOTHING}::DOUBLE)"
        f" + {EVEN}::DOUBLE * cls / {CODES}) AS l FROM grid LEFT JOIN counts USING (cls, a, b))",
        "llr AS (SELECT a, b, sum(CASE cls WHEN 1 THEN l ELSE -l END) AS l FROM logs GROUP BY a, b)",
        f"least AS (SELECT {MARGIN}::DOUBLE + ln((count(*) FILTER (cls = 0) + 1) / (count(*) FILTER (cls = 1) + 1)) AS least FROM strings)",
        f"seen AS (SELECT s, unnest(range(length(s))) AS i, unnest(list_transform(string_split(s, ''), lambda c: strpos({quote(ALPHABET)}, c))) AS b FROM (SELECT DISTINCT m AS s FROM tok))",
        "judged AS (SELECT s FROM (SELECT s, coalesce(lag(b) OVER (PARTITION BY s ORDER BY i), 0) AS a, b FROM seen) JOIN llr USING (a, b) GROUP BY s HAVING sum(l) >= (SELECT least FROM least))",
        f"spans AS (SELECT row, start, kind, stop FROM base UNION ALL SELECT row, start, {len(BASE)}, stop FROM tok JOIN judged ON m = s)",
        f"text AS (SELECT row, kind, start, (CASE kind {names} END) || ':' || start::BIGINT || ':' || stop::BIGINT AS t FROM spans)",
    ]
    counts = ", ".join(f"count(*) FILTER (kind = {k}) AS n_{kind}" for k, (kind, *_) in enumerate(BASE))
    joined = "coalesce(string_agg(t, ',' ORDER BY start, kind){}, '')"
    return (f"WITH {', '.join(parts)} SELECT any_value(doc_id) AS doc_id, {counts}, sha256({joined.format(f' FILTER (kind < {len(BASE)})')}) AS base_sha256, "
            f"{joined.format(' FILTER (kind IS NOT NULL)')} AS spans, count(*) FILTER (kind = {len(BASE)}) AS n_markov FROM d LEFT JOIN text USING (row) GROUP BY row")


SQL = _sql()
