"""Removal of repeated byte strings by depth-limited radix passes over suffixes.

A string of ``length`` bytes that starts at two places at least is repeated;
every byte that a repeated string covers goes. To find them, the suffixes are
told apart most significant digit first and no deeper than ``length`` bytes;
a suffix whose group has one member leaves, and the groups that reach the
full depth are exactly the repeated windows.

Sorting every suffix would move several times the corpus, so the first digit
is taken where all equal windows agree to take it: at the window's anchor,
its ``gram``-byte string of smallest hash (leftmost of equal ones). Windows
with one anchor start at neighbouring places, so a run of windows goes
through the passes as one suffix:

1. the anchor's gram: a run whose gram occurs once anywhere leaves;
2. the bytes of the whole run, from the first window's start to the last
   one's end: if they occur again, all windows of the run are repeated;
3. what is left open is split into its single windows, compared whole.

Pass 1 uses 64-bit hashes (a collision only keeps a run in play), pass 2
128-bit and pass 3 96-bit ones. Every pass sends one row for each distinct
value of a chunk of text, so a passage that a third of all documents hold
costs a row a chunk; verdicts go back to the chunks.

Texts are stored once, compressed, as chunks of a table bucketed by slot, a
few neighbouring chunks of one map task. All passes read that table where it lies; only keys and
verdicts are shuffled.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import BASE, BYTE_NUMBERS, mix64, pieces, powers, prepare, ragged, shuffle_parts, text_buffers, written
from tillcast.session import checkpoint_dir

LENGTH, GRAM = 200, 64
#: Bytes of text in a chunk; each chunk sends a key once.
CHUNK_BYTES = 2 << 20
#: Chunks of a slot, which a pass loads as one group; bits of a slot's number within its map task (beyond them the last slot takes the rest).
SLOT_CHUNKS, SLOT_BITS = 4, 9

_CHUNK = "slot int, chunk int, blob binary, sizes binary, ids array<long>"
_GRAM = "k1 long, slot int, code long"
_RUN = "k1 long, k2 long, low long, high long, slot int, code long"
_WINDOW = "k1 long, k2 int, slot int, code long"
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}


def _weights(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, kept between chunks."""
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 21)
        _powers["up"] = powers(size)
        down = np.full(size, _INVERSE, np.uint64)
        down[0] = 1
        _powers["down"] = np.multiply.accumulate(down)
    return _powers["up"][:n], _powers["down"][:n]


def runs(offsets: np.ndarray, raw: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor: start of the first and of the last window, and the hash of the anchor's gram."""
    none = np.zeros(0, np.int64)
    size = np.diff(offsets)
    long = size >= length
    if not long.any():
        return none, none, np.zeros(0, np.uint64)
    n = len(raw)
    up, down = _weights(n)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_NUMBERS[raw] * up, out=total[1:])
    grams = mix64((total[gram:] - total[:-gram]) * down[:n - gram + 1])
    del total
    low = np.uint64(0xFFFFFFFF)
    key = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        key = np.minimum(key[:-have], key[have:])
        have *= 2
    if have < width:
        key = np.minimum(key[:len(key) - (width - have)], key[width - have:])
    starts = ragged(offsets[:-1][long], size[long] - length + 1)
    anchor = (key[starts] & low).astype(np.int64)
    new = np.ones(len(anchor), bool)
    new[1:] = anchor[1:] != anchor[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    return starts[first], starts[last], grams[anchor[first]]


def digests(view: memoryview, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """128-bit hashes of byte ranges, two numbers each."""
    from xxhash import xxh3_128_digest

    if not len(starts):
        return np.zeros((0, 2), np.int64)
    got = b"".join([xxh3_128_digest(view[a:b]) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)])
    return np.frombuffer(got, np.int64).reshape(-1, 2)


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First place of every distinct key (a row of numbers), which key each row has, and how many rows have it."""
    if keys.ndim == 2:
        keys = np.ascontiguousarray(keys).view([("a", keys.dtype), ("b", keys.dtype)]).ravel()
    _, first, which, count = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
    return first, which.ravel(), count


def _store(chunk_bytes: int, slot_chunks: int):
    def store(batches):
        from pyspark import TaskContext
        from zstandard import ZstdCompressor

        pack = ZstdCompressor(level=3)
        task = TaskContext.get().partitionId()
        for chunk, piece in enumerate(pieces(batches, 1, chunk_bytes)):
            slot = (task << SLOT_BITS) + min(chunk // slot_chunks, (1 << SLOT_BITS) - 1)
            offsets, raw = text_buffers(piece.column(1))
            blob = pack.compress(raw[offsets[0]:offsets[-1]].tobytes())
            yield pa.RecordBatch.from_arrays(
                [pa.array([slot], pa.int32()), pa.array([chunk], pa.int32()), pa.array([blob], pa.binary()),
                 pa.array([np.diff(offsets).astype(np.int64).tobytes()], pa.binary()),
                 pa.array([piece.column(0).to_pylist()], pa.list_(pa.int64()))], names=["slot", "chunk", "blob", "sizes", "ids"])
    return store


def _load(blob: bytes, sizes: bytes) -> tuple[np.ndarray, np.ndarray]:
    from zstandard import ZstdDecompressor

    size = np.frombuffer(sizes, np.int64)
    offsets = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    raw = np.frombuffer(ZstdDecompressor().decompress(blob, max_output_size=max(int(offsets[-1]), 1)), np.uint8)
    return offsets, raw


def _spread(which: np.ndarray, groups: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the largest of ``values`` in each group."""
    low, high = np.full(groups, np.iinfo(np.int64).max), np.full(groups, np.iinfo(np.int64).min)
    np.minimum.at(low, which, values)
    np.maximum.at(high, which, values)
    return low, high


class Chunk:
    """A chunk's text and how far the passes have told its windows apart.

    Verdicts are numbers of runs (or starts of windows) of this chunk whose
    key another chunk holds too; equal keys inside the chunk are found here.
    """

    def __init__(self, blob: bytes, sizes: bytes, length: int, gram: int):
        self.offsets, self.raw = _load(blob, sizes)
        self.view, self.length = memoryview(self.raw), length
        self.first, self.last, self.grams = runs(self.offsets, self.raw, length, gram)
        self.ranges = [np.zeros((0, 2), np.int64)]

    def gram_keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Pass 1: the distinct grams, and the first run that has each."""
        at, _, _ = distinct(self.grams)
        return self.grams[at].astype(np.int64), at

    def after_grams(self, shared: np.ndarray) -> None:
        """Runs whose gram occurs again stay."""
        _, of, count = distinct(self.grams)
        again = count > 1
        again[of[shared]] = True
        self.alive = np.flatnonzero(again[of])
        _, self.gram_of, _ = distinct(self.grams[self.alive])
        self.whole = digests(self.view, self.first[self.alive], self.last[self.alive] + self.length)
        groups = int(self.gram_of.max()) + 1 if len(self.alive) else 0
        self.low, self.high = _spread(self.gram_of, groups, self.whole[:, 0])

    def run_keys(self):
        """Pass 2: (k1, k2, low, high, none, code): the grams with the least and largest run below them (code even),
        and the distinct runs (code odd), numbered by the first living run that has them."""
        g, _, _ = distinct(self.gram_of)
        w, _, _ = distinct(self.whole)
        blank = np.zeros(len(w), np.int64)
        return (np.concatenate([self.grams[self.alive[g]].astype(np.int64), self.whole[w, 0]]),
                np.concatenate([np.zeros(len(g), np.int64), self.whole[w, 1] | 1]),
                np.concatenate([self.low, blank]), np.concatenate([self.high, blank]),
                np.concatenate([np.zeros(len(g), bool), np.ones(len(w), bool)]), np.concatenate([g * 2, w * 2 + 1]))

    def after_runs(self, code: np.ndarray, mixed: np.ndarray, chosen: np.ndarray) -> None:
        """Runs that occur again are repeated ranges. In play stay the others and, below grams that several
        different runs share, one copy of each repeated run (that of the ``chosen`` chunk): an open run may repeat part of it."""
        several = self.low < self.high
        several[self.gram_of[code[mixed & (code % 2 == 0)] // 2]] = True
        at, of, count = distinct(self.whole)
        again, mine = count > 1, np.ones(len(count), bool)
        odd = code % 2 == 1
        again[of[code[odd] // 2]] = True
        mine[of[code[odd & ~chosen] // 2]] = False
        done = again[of] if len(of) else np.zeros(0, bool)
        runs_done = self.alive[done]
        self.ranges.append(np.stack([self.first[runs_done], self.last[runs_done] + self.length], 1))
        one = np.zeros(len(self.alive), bool)
        one[at[mine]] = True
        left = self.alive[~done | (one & several[self.gram_of])]
        self.starts = ragged(self.first[left], self.last[left] - self.first[left] + 1)
        self.keys = digests(self.view, self.starts, self.starts + self.length)

    def window_keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pass 3: the distinct windows in play, and where each starts first."""
        at, _, _ = distinct(self.keys)
        return self.keys[at, 0], self.keys[at, 1].astype(np.int32), self.starts[at]

    def after_windows(self, shared: np.ndarray) -> None:
        """Windows that occur again are repeated ranges."""
        _, of, count = distinct(self.keys)
        again = count > 1
        again[of[np.searchsorted(self.starts, shared)]] = True
        starts = self.starts[again[of]] if len(of) else self.starts
        self.ranges.append(np.stack([starts, starts + self.length], 1))

    def gone(self) -> np.ndarray:
        """Which bytes a repeated window covers."""
        step = np.zeros(len(self.raw) + 1, np.int32)
        ranges = _merge(np.concatenate(self.ranges))
        np.add.at(step, ranges[:, 0], 1)
        np.add.at(step, ranges[:, 1], -1)
        return np.cumsum(step)[:-1] > 0


def _chunks(stored: pa.Table, verdicts: pa.Table | None, passes: int, length: int, gram: int):
    """The chunks of a slot, taken through the first ``passes`` passes."""
    if verdicts is not None:
        level, code = verdicts.column("level").to_numpy(), verdicts.column("code").to_numpy()
        order = np.lexsort((code, level))
        level, code = level[order], code[order]
        flags = [verdicts.column(c).to_numpy(zero_copy_only=False).astype(bool)[order] for c in ("mixed", "chosen")]
        part = np.searchsorted(level, np.arange(1, 5))  # where each level starts
    for row, (number, blob, sizes) in enumerate(zip(*(stored.column(c).to_pylist() for c in ("chunk", "blob", "sizes")), strict=True)):
        c = Chunk(blob, sizes, length, gram)
        if passes and len(c.first):
            mine = []
            for k in range(3):
                low, high = np.searchsorted(code[part[k]:part[k + 1]], [number << 32, (number + 1) << 32]) + part[k]
                mine.append(slice(low, high))
            own = [code[m] & 0xFFFFFFFF for m in mine]
            c.after_grams(own[0])
            if passes > 1:
                c.after_runs(own[1], flags[0][mine[1]], flags[1][mine[1]])
            if passes > 2:
                c.after_windows(own[2])
        yield row, number, c


def _grams(length: int, gram: int):
    def grams(batches):
        for batch in batches:
            stored = pa.Table.from_batches([batch])
            slots = stored.column("slot").to_pylist()
            for row, number, c in _chunks(stored, None, 0, length, gram):
                k, at = c.gram_keys()
                yield pa.RecordBatch.from_arrays([pa.array(k), pa.array(np.full(len(k), slots[row], np.int32)), pa.array((number << 32) | at)],
                                                 names=["k1", "slot", "code"])
    return grams


def _slot_rows(columns: list[list[np.ndarray]], names: list[str], types: list[pa.DataType], slot: int | None) -> pa.Table:
    """One table from the columns of each chunk; the slot is the same for all."""
    joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns]
    out = {n: pa.array(c, t) for n, c, t in zip(names, joined, types, strict=True)}
    out["slot"] = pa.array([slot] * len(joined[0]), pa.int32())
    return pa.table(out)


def _runs(length: int, gram: int):
    def run_rows(stored: pa.Table, verdicts: pa.Table) -> pa.Table:
        cols: list[list] = [[], [], [], [], [], []]
        for _, number, c in _chunks(stored, verdicts, 1, length, gram):
            if len(c.first):
                k1, k2, low, high, no, code = c.run_keys()
                for col, x in zip(cols, (k1, k2, low, high, no, (number << 32) | code), strict=True):
                    col.append(x)
        slot = stored.column("slot")[0].as_py() if stored.num_rows else None
        t = _slot_rows([cols[0], cols[1], cols[5]], ["k1", "k2", "code"], [pa.int64()] * 3, slot)
        no = np.concatenate(cols[4]) if cols[4] else np.zeros(0, bool)
        for n, c in (("low", cols[2]), ("high", cols[3])):
            t = t.append_column(n, pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64(), mask=no))
        return t.select(["k1", "k2", "low", "high", "slot", "code"])
    return run_rows


def _windows(length: int, gram: int):
    def window_rows(stored: pa.Table, verdicts: pa.Table) -> pa.Table:
        cols: list[list] = [[], [], []]
        for _, number, c in _chunks(stored, verdicts, 2, length, gram):
            if len(c.first):
                k1, k2, start = c.window_keys()
                for col, x in zip(cols, (k1, k2, (number << 32) | start), strict=True):
                    col.append(x)
        slot = stored.column("slot")[0].as_py() if stored.num_rows else None
        return _slot_rows(cols, ["k1", "k2", "code"], [pa.int64(), pa.int32(), pa.int64()], slot).select(["k1", "k2", "slot", "code"])
    return window_rows


def _merge(ranges: np.ndarray) -> np.ndarray:
    """Overlapping ranges (start, stop) made one; sorted."""
    if not len(ranges):
        return ranges
    ranges = ranges[np.argsort(ranges[:, 0], kind="stable")]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.ones(len(ranges), bool)
    new[1:] = ranges[1:, 0] >= reach[:-1]
    at = np.flatnonzero(new)
    return np.stack([ranges[at, 0], reach[np.append(at[1:], len(ranges)) - 1]], 1)


def _cut(length: int, gram: int):
    def cut(stored: pa.Table, verdicts: pa.Table) -> pa.Table:
        """The documents of a slot without the repeated bytes."""
        out: dict[str, list] = {"doc_id": [], "n_bytes": [], "spans": [], "kept": []}
        for row, _, c in _chunks(stored, verdicts, 3, length, gram):
            gone = c.gone()
            for doc_id, a, b in zip(stored.column("ids")[row].as_py(), c.offsets[:-1].tolist(), c.offsets[1:].tolist(), strict=True):
                mask = gone[a:b]
                edge = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0)) if mask.any() else np.zeros(0, np.int64)
                out["doc_id"].append(doc_id)
                out["n_bytes"].append(b - a)
                out["spans"].append([{"start": s, "stop": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)])
                out["kept"].append(c.raw[a:b][~mask].tobytes() if len(edge) else c.raw[a:b].tobytes())
        span = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
        return pa.table({"doc_id": pa.array(out["doc_id"], pa.int64()), "n_bytes": pa.array(out["n_bytes"], pa.int64()),
                         "spans": pa.array(out["spans"], span), "kept": pa.array(out["kept"], pa.binary())})
    return cut


def _stored(src: DataFrame, chunk_bytes: int, slot_chunks: int) -> DataFrame:
    """The chunks as a table bucketed by slot, in the shared folder: passes read a slot where it lies, without an exchange."""
    spark = src.sparkSession
    prepare(spark)
    name = f"tillcast_chunks_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    (src.mapInArrow(_store(chunk_bytes, slot_chunks), _CHUNK).write.format("parquet").option("compression", "none").bucketBy(shuffle_parts(spark), "slot")
     .option("path", path).saveAsTable(name))
    return spark.table(name)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, id_col: str = "doc_id", text_col: str = "text",
                   chunk_bytes: int = CHUNK_BYTES, slot_chunks: int = SLOT_CHUNKS) -> DataFrame:
    """(doc_id, n_bytes, spans, kept), one row per row: the removed byte ranges and the bytes that stay.

    Null counts as empty; a text shorter than ``length`` holds no window.
    Rows that repeat are documents like any other, so both lose what they
    share; a null doc_id stays null. Other columns are not read.
    """
    if not 1 <= gram <= length:
        raise ValueError("gram must be between 1 and length")
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    stored = _stored(src, chunk_bytes, slot_chunks)
    lean = stored.select("slot", "chunk", "blob", "sizes")
    no = F.lit(False)

    def advance(verdicts: DataFrame, function, schema: str) -> DataFrame:
        return lean.groupBy("slot").cogroup(verdicts.groupBy("slot")).applyInArrow(function(length, gram), schema)

    # a row for each chunk at most, so the groups of these windows are small
    group = Window.partitionBy("k1")
    grams = lean.mapInArrow(_grams(length, gram), _GRAM).withColumn("times", F.count("*").over(group)).where("times > 1")
    verdicts = written(grams.select("slot", F.lit(1).alias("level"), "code", no.alias("mixed"), no.alias("chosen")), "grams")

    group = Window.partitionBy("k1", "k2")
    place = F.struct("slot", "code")
    found = (advance(verdicts, _runs, _RUN)
             .withColumns({"times": F.count("*").over(group), "mixed": F.coalesce(F.min("low").over(group) < F.max("high").over(group), no),
                           "chosen": place == F.min(place).over(group)}).where("times > 1"))
    verdicts = verdicts.unionByName(written(found.select("slot", F.lit(2).alias("level"), "code", "mixed", "chosen"), "runs"))

    found = advance(verdicts, _windows, _WINDOW).withColumn("times", F.count("*").over(group)).where("times > 1")
    verdicts = verdicts.unionByName(written(found.select("slot", F.lit(3).alias("level"), "code", no.alias("mixed"), no.alias("chosen")), "windows"))
    return stored.groupBy("slot").cogroup(verdicts.groupBy("slot")).applyInArrow(
        _cut(length, gram), "doc_id long, n_bytes long, spans array<struct<start:long,stop:long>>, kept binary")


def query(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))
