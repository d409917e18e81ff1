"""Quality classifier from weak labels.

Several overlapping heuristics vote good, bad or nothing on each document.
Expectation-maximisation estimates, without any true label, how often each
heuristic is right (and the share of good documents); the posterior of each
pattern of votes labels the documents. A linear scorer over hashed byte
trigrams and the votes is trained on those posteriors and scores every
document.

Scale: the votes of all documents are counted by pattern (at most 3^10 rows
reach the driver, whatever the input), so the estimate covers the corpus. The
scorer is fitted on a bounded sample chosen by hash. Scoring is one pass
without a shuffle; the weights (BUCKETS numbers) are broadcast.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import BYTE_NUMBERS, pieces, span_hashes, text_buffers

GOOD, BAD, NONE = 1, 0, 2
#: Hashed features; documents that the scorer is fitted on; rounds of EM and Newton steps.
BUCKETS, TRAIN_ROWS, EM_ROUNDS, FIT_ROUNDS = 1024, 4096, 50, 8

#: Where EM starts: share of bad votes on bad and on good documents.
START = {BAD: 0.35, GOOD: 0.01}

# The heuristics: a measure of the text, bad beyond one bound, good within the other, nothing between. Documented settings.
HEURISTICS = [
    ("symbols", "share of bytes that are signs other than , . ; : ' and -", 0.06, 0.03),
    ("capitals", "share of A-Z among ASCII letters", 0.40, 0.15),
    ("bars", "bars (|) for each word", 0.10, 0.01),
    ("repeats", "share of words equal to the word before", 0.15, 0.02),
    ("digits", "share of digits", 0.15, 0.05),
    ("lines", "share of lines met before in the text", 0.40, 0.10),
    ("ends", "share of lines that do not end in . ! ? or :", 0.80, 0.30),
    ("pairs", "share of pairs of neighbouring words met before in the text", 0.50, 0.25),
    ("marked", "share of words that end in a sign other than , . ; : ' and -", 0.30, 0.05),
    ("short", "10 / words", 4.0, 0.40),
]


def _flags() -> dict[str, np.ndarray]:
    b = np.arange(256)
    letter = ((b >= 65) & (b <= 90)) | ((b >= 97) & (b <= 122))
    space = np.isin(b, [9, 10, 11, 12, 13, 32])
    digit = (b >= 48) & (b <= 57)
    plain = np.isin(b, [ord(c) for c in ",.;:'-"])
    return {"letter": letter, "space": space, "digit": digit, "upper": (b >= 65) & (b <= 90),
            "symbol": (b < 128) & ~letter & ~space & ~digit & ~plain & (b >= 32)}


_FLAGS = _flags()


def measures(offsets: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """rows x heuristics: the measure each heuristic looks at; not a number where it cannot be taken."""
    raw, offsets = raw[offsets[0]:offsets[-1]], offsets - offsets[0]
    rows = len(offsets) - 1
    size = np.diff(offsets)

    def per_row(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag, dtype=np.int64)])
        return total[offsets[1:]] - total[offsets[:-1]]

    first = np.zeros(len(raw) + 1, bool)
    first[offsets[:-1]] = True
    first = first[:-1]
    space = _FLAGS["space"][raw]
    start = ~space
    start[1:] &= space[:-1] | first[1:]
    starts = np.flatnonzero(start)
    numbers = BYTE_NUMBERS[raw]
    numbers[space] = 0
    words = span_hashes(numbers, starts)
    word_row = np.searchsorted(offsets, starts, side="right") - 1
    n_words = np.bincount(word_row, minlength=rows)
    same = (words[1:] == words[:-1]) & (word_row[1:] == word_row[:-1])
    repeats = np.bincount(word_row[1:][same], minlength=rows)

    ends = np.append(starts[1:], len(raw))[:len(starts)] - 1  # last byte of each word: the blanks before the next one go
    gap = np.flatnonzero(~space)
    ends = gap[np.searchsorted(gap, ends, side="right") - 1] if len(gap) else ends
    marked = np.bincount(word_row[_FLAGS["symbol"][raw[ends]]], minlength=rows)
    pair = words[1:] * np.uint64(3) + words[:-1] * np.uint64(5)
    inside = word_row[1:] == word_row[:-1]
    pair, pair_row = pair[inside], word_row[1:][inside]
    order = np.lexsort((pair, pair_row))
    again = (pair[order][1:] == pair[order][:-1]) & (pair_row[order][1:] == pair_row[order][:-1])
    pairs = np.bincount(pair_row[order][1:][again], minlength=rows)

    line = first.copy()
    line[1:] |= raw[:-1] == 10
    lines = np.flatnonzero(line)
    numbers = BYTE_NUMBERS[raw]
    numbers[raw == 10] = 0
    names = span_hashes(numbers, lines)
    line_row = np.searchsorted(offsets, lines, side="right") - 1
    n_lines = np.bincount(line_row, minlength=rows)
    order = np.lexsort((names, line_row))
    again = (names[order][1:] == names[order][:-1]) & (line_row[order][1:] == line_row[order][:-1])
    met = np.bincount(line_row[order][1:][again], minlength=rows)
    last = np.append(lines[1:], len(raw))[:len(lines)] - 1
    newline = (last > 0) & (raw[last] == 10) if len(last) else np.zeros(0, bool)
    last = last - newline
    ended = np.isin(raw[last], [ord(c) for c in ".!?:"]) if len(last) else np.zeros(0, bool)
    not_ended = n_lines - np.bincount(line_row[ended], minlength=rows)

    with np.errstate(divide="ignore", invalid="ignore"):
        return np.stack([
            per_row(_FLAGS["symbol"][raw]) / size, per_row(_FLAGS["upper"][raw]) / per_row(_FLAGS["letter"][raw]),
            per_row(raw == ord("|")) / n_words, repeats / n_words, per_row(_FLAGS["digit"][raw]) / size,
            met / n_lines, not_ended / n_lines, pairs / np.maximum(n_words - 1, 1), marked / n_words,
            np.where(n_words > 0, 10 / n_words, 99.0)], 1)


def votes(measured: np.ndarray) -> np.ndarray:
    bad = np.array([h[2] for h in HEURISTICS])
    good = np.array([h[3] for h in HEURISTICS])
    return np.where(measured >= bad, BAD, np.where(measured <= good, GOOD, NONE)).astype(np.int64)


def _codes(v: np.ndarray) -> np.ndarray:
    return v @ (3 ** np.arange(v.shape[1]))


def expectation_maximisation(patterns: np.ndarray, counts: np.ndarray, rounds: int = EM_ROUNDS) -> tuple[float, np.ndarray, np.ndarray]:
    """(share of good, accuracies, posteriors) from patterns of votes (rows x heuristics) and how often each occurs.

    accuracies[y, j, v]: how often heuristic j votes v on documents of class
    y, v of bad, good, nothing. It starts from what the heuristics are made
    for: each finds one kind of bad document (START of them) and seldom errs
    on a good one. That settles which class is the good one.
    """
    m = patterns.shape[1]
    weight = counts / max(counts.sum(), 1)
    one_hot = np.stack([patterns == v for v in (BAD, GOOD, NONE)], 2).astype(float)
    silent = np.einsum("p,pjv->jv", weight, one_hot)[:, NONE]
    acc = np.zeros((2, m, 3))
    for y in (BAD, GOOD):
        acc[y, :, NONE] = silent
        acc[y, :, BAD] = START[y] * (1 - silent)
        acc[y, :, GOOD] = (1 - START[y]) * (1 - silent)
    share = 0.8
    posterior = np.zeros(len(patterns))
    for _ in range(rounds):
        logs = np.einsum("pjv,yjv->py", one_hot, np.log(acc + 1e-9))
        odds = logs[:, GOOD] - logs[:, BAD] + np.log(share + 1e-9) - np.log(1 - share + 1e-9)
        posterior = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
        share = float(np.clip((weight * posterior).sum(), 0.01, 0.99))
        for y, p in ((GOOD, posterior), (BAD, 1 - posterior)):
            got = np.einsum("p,pjv->jv", weight * p, one_hot) + 1e-4
            acc[y] = got / got.sum(1, keepdims=True)
    return share, acc, posterior


def features(offsets: np.ndarray, raw: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """rows x buckets: square roots of the shares of hashed byte trigrams (case and signs kept), length one."""
    raw, offsets = raw[offsets[0]:offsets[-1]], offsets - offsets[0]
    rows = len(offsets) - 1
    out = np.zeros(rows * buckets)
    if len(raw) >= 3:
        b = raw.astype(np.uint32)
        key = ((b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]) * np.uint32(0x9E3779B1) >> np.uint32(32 - int(buckets).bit_length() + 1)
        row = np.repeat(np.arange(rows), np.diff(offsets))
        inside = row[2:] == row[:-2]
        out = np.bincount(row[2:][inside] * buckets + key[inside], minlength=rows * buckets).astype(float)
    out = np.sqrt(out.reshape(rows, buckets))
    norm = np.sqrt((out ** 2).sum(1, keepdims=True))
    return out / np.maximum(norm, 1e-12)


def described(offsets: np.ndarray, raw: np.ndarray, v: np.ndarray, buckets: int = BUCKETS) -> np.ndarray:
    """The scorer's features: hashed trigrams, then each heuristic's vote (bad, good, nothing)."""
    shown = (v[:, :, None] == np.array([BAD, GOOD, NONE])).reshape(len(v), -1)
    return np.hstack([features(offsets, raw, buckets), 0.5 * shown])


def fit_scorer(x: np.ndarray, y: np.ndarray, rounds: int = FIT_ROUNDS, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression on soft labels by Newton steps; the last weight is the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    penalty = np.full(len(w), ridge)
    penalty[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        bend = (x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty)
        w = w - np.linalg.solve(bend, x.T @ (p - y) + penalty * w)
    return w


def vote_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(pattern, count) over all documents; counted within batches before the shuffle."""
    def run(batches):
        total: dict[int, int] = {}
        for piece in pieces(batches, 0):
            for c, n in zip(*np.unique(_codes(votes(measures(*text_buffers(piece.column(0))))), return_counts=True), strict=True):
                total[int(c)] = total.get(int(c), 0) + int(n)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["pattern", "n"])
    return (docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "pattern long, n long")
            .groupBy("pattern").agg(F.sum("n").alias("n")))


def fit(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", train_rows: int = TRAIN_ROWS, buckets: int = BUCKETS) -> tuple[np.ndarray, dict]:
    """The scorer's weights and what EM found (share of good documents, accuracies by heuristic)."""
    got = sorted(tuple(r) for r in vote_counts(docs, text_col).collect())
    if not got:
        return np.zeros(buckets + 3 * len(HEURISTICS) + 1), {"good": None, "accuracies": {}}
    codes = np.array([c for c, _ in got])
    counts = np.array([n for _, n in got], float)
    patterns = codes[:, None] // 3 ** np.arange(len(HEURISTICS)) % 3
    share, acc, posterior = expectation_maximisation(patterns, counts)
    label = dict(zip(codes.tolist(), posterior.tolist(), strict=True))

    # thinned by hash to about twice the bound, then the smallest hashes: the sample depends on ids and texts alone
    place = F.pmod(F.xxhash64(F.lit("quality"), F.col(id_col), F.col(text_col).cast("string")), F.lit(1 << 30))
    most = min(1 << 30, int((1 << 30) * 2 * train_rows / counts.sum()) + 1)
    placed = docs.select(place.alias("place"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for piece in pieces(batches, 1):
            buffers = text_buffers(piece.column(1))
            v = votes(measures(*buffers))
            x = described(*buffers, v, buckets).astype(np.float32)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(_codes(v)), pa.array([r.tobytes() for r in x], pa.binary())],
                                             names=["place", "pattern", "x"])

    def smallest(rows: DataFrame) -> list:
        return rows.mapInArrow(run, "place long, pattern long, x binary").orderBy("place", "pattern", "x").limit(train_rows).collect()
    # no place below the cut: nearly all rows are one document, repeated
    sample = smallest(placed.where(F.col("place") < most)) or smallest(placed)
    x = np.stack([np.frombuffer(r[2], np.float32) for r in sample]).astype(float)
    y = np.array([label[r[1]] for r in sample])
    names = [h[0] for h in HEURISTICS]
    right = {n: {"bad": float(acc[BAD, j, BAD]), "good": float(acc[GOOD, j, GOOD])} for j, n in enumerate(names)}
    return fit_scorer(x, y), {"good": share, "accuracies": right}


def score(docs: DataFrame, weights: np.ndarray, text_col: str = "text", id_col: str = "doc_id", least: float = 0.5) -> DataFrame:
    """(doc_id, score, keep), one row per row: score is the chance that the document is good, keep that it is at least ``least``.

    A null or empty text, and one under three bytes, has no features: score 0,
    not kept. Repeated rows and null ids stay; other columns are not read.
    Without any document to fit on, every other score is 0.5.
    """
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches):
        w = shared.value
        for piece in pieces(batches, 1):
            offsets, raw = text_buffers(piece.column(1))
            x = described(offsets, raw, votes(measures(offsets, raw)), len(w) - 1 - 3 * len(HEURISTICS))
            p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            p = np.where(np.diff(offsets) < 3, 0.0, p)
            yield pa.RecordBatch.from_arrays([piece.column(0), pa.array(p), pa.array(p >= least)], names=["doc_id", "score", "keep"])
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "doc_id long, score double, keep boolean")


def query(docs: DataFrame) -> DataFrame:
    return score(docs, fit(docs)[0])
