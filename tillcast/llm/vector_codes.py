"""Vector code compression: product quantisation by Lloyd rounds over cover trees.

Vectors are cut into PARTS parts; each part has a codebook of at most ENTRIES
whole-number vectors, fitted by Lloyd rounds with integer means. A block of
vectors of one partition keeps a cover tree for each part: a node covers the
distinct points of a run of positions from its centre within its radius, its
children with a smaller radius each. With running sums over the positions, the
count and sum of a whole subtree are two differences. A round compares node
centres with the entries: where the second nearest is further than the nearest
by more than twice the radius, the triangle inequality gives the whole subtree
to the nearest entry; only ambiguous nodes go on to their children, and single
points are compared exactly, ties to the lower entry.

Scale: trees are built once, in place, and written to the shared folder; a
round reads them and exchanges one row for each task, part and entry, so
neither vectors nor trees are ever shuffled. The driver holds the codebooks
(ENTRIES vectors for each vector length).
"""

from __future__ import annotations

import hashlib
import io

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import prepare, written

#: Parts of a vector, entries of a codebook, Lloyd rounds, units of a component.
PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Vectors of one block; radius of a node over that of its children; points below which a node's children are single points.
BLOCK, SHRINK, BUCKET = 4_096, 1.3, 8

_SUMS = "dims int, part int, entry int, n long, total array<string>"


def cut(dims: int) -> list[tuple[int, int]]:
    """Bounds of the parts; equal where the length divides by PARTS."""
    return [(k * dims // PARTS, (k + 1) * dims // PARTS) for k in range(PARTS)]


def whole(values: np.ndarray) -> np.ndarray:
    """floor(SCALE x) as float64 while squared distances are exact in it, else as Python integers."""
    scaled = np.floor(values * SCALE)
    if scaled.size == 0 or values.shape[1] * (2 * np.abs(scaled).max()) ** 2 < 2.0 ** 52:
        return scaled
    out = np.empty(values.shape, object)
    for place, x in np.ndenumerate(values):
        top, bottom = float(x).as_integer_ratio()
        out[place] = SCALE * top // bottom
    return out


def squares(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances, exact."""
    if points.dtype != object and entries.dtype != object:
        # products of whole numbers below 2^52 in sum: no rounding
        return (points ** 2).sum(1)[:, None] - 2 * (points @ entries.T) + (entries ** 2).sum(1)
    points, entries = points.astype(object), entries.astype(object)
    if points.shape[1] == 0:
        return np.zeros((len(points), len(entries)), object)
    return np.stack([((points - e) ** 2).sum(1) for e in entries], 1)


class CoverTree:
    """Distinct points in tree order, their weights, and nodes (lo, hi, centre, first child, children) with radii, parents first.

    ``place`` gives the position of each input row among the points.
    """

    def __init__(self, points, weight, place, nodes, radius):
        self.points, self.weight, self.place, self.nodes, self.radius = points, weight, place, nodes, radius

    @classmethod
    def build(cls, rows: np.ndarray) -> CoverTree:
        points, first, inverse = _distinct(rows)
        weight = np.bincount(inverse, minlength=len(points)).astype(np.int64)
        if points.dtype == object:  # beyond exact floats: no bounds, a root over single points
            n = len(points)
            nodes = np.array([[0, n, 0, 1, n], *([k, k + 1, k, 0, 0] for k in range(n))], np.int64)
            return cls(points, weight, inverse, nodes, np.r_[np.inf, np.zeros(n)])
        nodes, radius = [[0, len(points), 0, 0, 0]], [0.0]
        # breadth first: the members of a node's children replace its own run, so runs stay contiguous
        order = np.arange(len(points))
        at = 0
        while at < len(nodes):
            lo, hi, centre = nodes[at][:3]
            members = order[lo:hi].copy()
            own = np.sqrt(((points[members] - points[centre]) ** 2).sum(1))
            radius[at] = float(own.max()) * (1 + 1e-12)
            if hi - lo > 1:
                centres, owner = cls._net(points[members], int(np.flatnonzero(members == centre)[0]), own)
                by = np.argsort(owner, kind="stable")
                order[lo:hi] = members[by]
                cuts = lo + np.r_[0, np.cumsum(np.bincount(owner, minlength=len(centres)))]
                nodes[at][3:] = [len(nodes), len(centres)]
                nodes += [[int(cuts[k]), int(cuts[k + 1]), int(members[c]), 0, 0] for k, c in enumerate(centres)]
                radius += [0.0] * len(centres)
            at += 1
        nodes = np.array(nodes, np.int64)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        nodes[:, 2] = rank[nodes[:, 2]]
        return cls(points[order], weight[order], rank[inverse], nodes, np.array(radius))

    @staticmethod
    def _net(points: np.ndarray, centre: int, distance: np.ndarray) -> tuple[list[int], np.ndarray]:
        """Centres, each further than the children's radius from those before it, until all points are covered; and each point's centre."""
        if len(points) <= BUCKET:
            return list(range(len(points))), np.arange(len(points))
        reach = distance.max() / SHRINK
        centres, owner, distance = [centre], np.zeros(len(points), np.int64), distance.copy()
        while True:
            far = int(distance.argmax())
            if distance[far] <= reach:
                return centres, owner
            new = np.sqrt(((points - points[far]) ** 2).sum(1))
            closer = new < distance
            owner[closer] = len(centres)
            distance[closer] = new[closer]
            centres.append(far)

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(lo, hi, entry) of runs that cover all points: whole subtrees by the triangle inequality, the rest point by point."""
        runs, at = [], np.zeros(1, np.int64)
        while len(at):
            lo, hi, centre, first, children = self.nodes[at].T
            square = squares(self.points[centre], entries)
            best = square.argmin(1).astype(np.int64)  # the first of equals is the lowest entry
            sure = hi - lo == 1
            if square.dtype != object:
                near = np.sqrt(square[np.arange(len(at)), best])
                square[np.arange(len(at)), best] = np.inf
                sure |= np.sqrt(square.min(1)) * (1 - 1e-12) > near * (1 + 1e-12) + 2 * self.radius[at] + 1e-9
            runs.append(np.stack([lo[sure], hi[sure], best[sure]]))
            first, children = first[~sure], children[~sure]
            ends = np.cumsum(children)
            at = np.repeat(first - (ends - children), children) + np.arange(ends[-1] if len(ends) else 0)
        return tuple(np.concatenate(runs, 1))

    def sums(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Weight and weighted sum of the points of each entry, from running sums over the tree order."""
        lo, hi, entry = self.assign(entries)
        kind = object if self.points.dtype == object else np.int64
        points = self.points.astype(kind)
        count = np.r_[0, np.cumsum(self.weight)]
        total = np.zeros((len(points) + 1, points.shape[1]), kind)
        np.cumsum(points * self.weight[:, None].astype(kind), axis=0, out=total[1:])
        n, t = np.zeros(len(entries), np.int64), np.zeros((len(entries), points.shape[1]), kind)
        np.add.at(n, entry, count[hi] - count[lo])
        np.add.at(t, entry, total[hi] - total[lo])
        return n, t

    def codes(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry and squared distance of every input row."""
        lo, hi, entry = self.assign(entries)
        code = np.zeros(len(self.points), np.int64)
        order = np.argsort(lo)
        code[:] = np.repeat(entry[order], (hi - lo)[order])
        kind = object if object in (self.points.dtype, entries.dtype) else np.int64
        gap = (self.points.astype(kind) - entries.astype(kind)[code]) ** 2
        error = gap.sum(1) if gap.shape[1] else np.zeros(len(gap), kind)
        return code[self.place], error[self.place]

    def dump(self) -> bytes:
        to = io.BytesIO()
        points = self.points if self.points.dtype != object else np.array([[str(x) for x in r] for r in self.points])
        np.savez(to, points=points, weight=self.weight, place=self.place, nodes=self.nodes, radius=self.radius)
        return to.getvalue()

    @classmethod
    def load(cls, data: bytes) -> CoverTree:
        with np.load(io.BytesIO(data)) as z:
            points = z["points"]
            if points.dtype.kind == "U":
                points = np.array([[int(x) for x in r] for r in points], object)
            return cls(points, z["weight"], z["place"], z["nodes"], z["radius"])


def _distinct(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct rows, one position of each, and for each row its distinct one."""
    if rows.shape[1] == 0:
        return rows[:1], np.zeros(1, np.int64), np.zeros(len(rows), np.int64)
    if rows.dtype != object:
        points, first, inverse = np.unique(rows, axis=0, return_index=True, return_inverse=True)
        return points, first, inverse.reshape(-1)
    names: dict[tuple, int] = {}
    inverse = np.array([names.setdefault(tuple(r), len(names)) for r in rows.tolist()], np.int64)
    first = np.unique(inverse, return_index=True)[1]
    return rows[first], first, inverse


def _matrix(lists: pa.Array, dims: int) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), dims)


def _blocks(block: int):
    """Batches of (id, label, v) to rows of (dims, ids, labels, trees): one for each run of ``block`` vectors of a length."""
    def flush(rows: list[pa.RecordBatch], dims: int):
        t = pa.Table.from_batches(rows).combine_chunks()
        n = t.num_rows
        one = lambda name: pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), t.column(name).chunk(0))
        v = whole(_matrix(t.column("v").chunk(0), dims))
        trees = [CoverTree.build(v[:, a:b]).dump() for a, b in cut(dims)]
        return pa.RecordBatch.from_arrays([pa.array([dims], pa.int32()), one("id"), one("label"), pa.array([trees], pa.list_(pa.binary()))],
                                          names=["dims", "ids", "labels", "trees"])

    def blocks(batches):
        held: dict[int, list] = {}
        for b in batches:
            size = b.column("v").value_lengths().to_numpy(zero_copy_only=False)
            for dims in np.unique(size).tolist():
                own = b.filter(pa.array(size == dims))
                rows = held.setdefault(dims, [])
                while own.num_rows:
                    room = block - sum(r.num_rows for r in rows)
                    rows.append(own.slice(0, room))
                    own = own.slice(room)
                    if sum(r.num_rows for r in rows) == block:
                        yield flush(rows, dims)
                        rows.clear()
        for dims, rows in held.items():
            if rows:
                yield flush(rows, dims)
    return blocks


def _rounds(books):
    """Sums of a task's blocks: one row for each (length, part, entry) that got a point."""
    def sums(batches):
        held: dict[tuple[int, int], tuple] = {}
        for b in batches:
            for dims, trees in zip(b.column("dims").to_pylist(), b.column("trees"), strict=True):
                for part, data in enumerate(trees):
                    n, t = CoverTree.load(data.as_buffer()).sums(books.value[dims][part])
                    n0, t0 = held.get((dims, part), (0, 0))
                    held[dims, part] = (n0 + n, t0 + t.astype(object))
        rows = [(dims, part, e, int(n[e]), [str(x) for x in t[e]]) for (dims, part), (n, t) in held.items() for e in np.flatnonzero(n).tolist()]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.string())), strict=True)],
                                             names=["dims", "part", "entry", "n", "total"])
    return sums


def _add(t: pa.Table) -> pa.Table:
    """One entry's sums over all tasks, as whole numbers of any size."""
    columns = zip(*t.column("total").to_pylist(), strict=True)
    total = [str(sum(map(int, c))) for c in columns]
    head = {k: [t.column(k)[0].as_py()] for k in ("dims", "part", "entry")}
    return pa.table({**head, "n": [sum(t.column("n").to_pylist())], "total": [total]},
                    pa.schema([("dims", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("total", pa.list_(pa.string()))]))


_LONG = (1 << 63) - 1


def _encode(books, label_type: pa.DataType):
    def encode(batches):
        for b in batches:
            for dims, ids, labels, trees in zip(*(b.column(c) for c in ("dims", "ids", "labels", "trees")), strict=True):
                found = [CoverTree.load(t.as_buffer()).codes(e) for t, e in zip(trees, books.value[dims.as_py()], strict=True)]
                code = ["".join(f"{c:02x}" for c in row) for row in zip(*(c.tolist() for c, _ in found), strict=True)]
                error = [min(_LONG, sum(row)) for row in zip(*(e.tolist() for _, e in found), strict=True)]
                ids, labels = ids.values, labels.values
                for k in range(0, len(ids), 10_000):
                    m = min(10_000, len(ids) - k)
                    yield pa.RecordBatch.from_arrays([ids.slice(k, m), labels.slice(k, m), pa.array(code[k:k + m]), pa.array(error[k:k + m], pa.int64()),
                                                      pa.array([dims.as_py()] * m, pa.int32())], names=["vec_id", "label", "code", "error", "dims"])
    return encode


def fit(blocks: DataFrame, books: dict[int, list[np.ndarray]], rounds: int) -> dict[int, list[np.ndarray]]:
    """Codebooks after ``rounds`` of assignment and integer means; entries without a point stay."""
    sc = blocks.sparkSession.sparkContext
    for _ in range(rounds):
        sums = (blocks.select("dims", "trees").mapInArrow(_rounds(sc.broadcast(books)), _SUMS)
                .groupBy("dims", "part", "entry").applyInArrow(_add, _SUMS))
        books = {d: [list(map(list, e.tolist())) for e in parts] for d, parts in books.items()}
        for r in sums.collect():  # at most PARTS x ENTRIES rows for each vector length
            books[r["dims"]][r["part"]][r["entry"]] = [int(t) // r["n"] for t in r["total"]]
        books = {d: [_entries(e, b - a) for e, (a, b) in zip(parts, cut(d), strict=True)] for d, parts in books.items()}
    return books


def _entries(rows: list[list], width: int) -> np.ndarray:
    out = np.array([[int(x) for x in r] for r in rows], object).reshape(len(rows), width)
    return out.astype(np.float64) if out.size == 0 or max(abs(x) for x in out.flat) < 1 << 24 else out


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
             rounds: int = ROUNDS, entries: int = ENTRIES, block: int = BLOCK) -> DataFrame:
    """One row per vector that takes part: ``vec_id, code, error, label_error, codebooks_sha256``.

    Vectors that are null or hold a null or non-finite component take no part.
    Vectors of each length have codebooks of their own, which start from the
    rows of the smallest vec_ids (rows that repeat an id by their vectors, rows
    without id last); ``label_error`` sums over all lengths. A length that does
    not divide by four is cut as evenly as it can be; a part without components
    is at distance 0 from entry 0. Rows that repeat an id are vectors of their
    own. Distances are exact whole numbers, an error beyond a long is its
    largest value. An empty table gives an empty result. Other columns are not
    read, so their names cannot clash.
    """
    spark = vectors.sparkSession
    prepare(spark)
    v = F.col(vector_col).cast("array<double>")
    fine = ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    use = vectors.where(v.isNotNull() & fine).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), v.alias("v"))
    label = use.schema["label"].dataType.simpleString()
    blocks = written(use.mapInArrow(_blocks(block), f"dims int, ids array<bigint>, labels array<{label}>, trees array<binary>"), "trees")
    books = {}
    for (dims,) in blocks.select("dims").distinct().collect():
        first = use.where(F.size("v") == dims).orderBy(F.asc_nulls_last("id"), "v").select("v").limit(entries).collect()
        start = whole(np.array([r["v"] for r in first], np.float64).reshape(len(first), dims))
        books[dims] = [_entries(start[:, a:b].tolist(), b - a) for a, b in cut(dims)]
    books = fit(blocks, books, rounds)
    digest = {d: hashlib.sha256(",".join(str(int(x)) for e in parts for row in e for x in row).encode()).hexdigest() for d, parts in books.items()}
    sc = spark.sparkContext
    coded = written(blocks.mapInArrow(_encode(sc.broadcast(books), None), f"vec_id long, label {label}, code string, error long, dims int"), "codes")
    # written, so that a label of a third of all rows is a plain join that Spark can split
    by_label = written(coded.groupBy("label").agg(F.sum(F.col("error").cast("decimal(38,0)")).alias("e"))
                       .select(F.col("label").alias("of"), F.least("e", F.lit(_LONG)).cast("long").alias("label_error")), "label-errors")
    sha = F.coalesce(*(F.when(F.col("dims") == d, F.lit(x)) for d, x in digest.items())) if digest else F.lit(None).cast("string")
    return (coded.join(by_label, coded["label"].eqNullSafe(by_label["of"]))
            .select("vec_id", "code", "error", "label_error", sha.alias("codebooks_sha256")))


def _sql() -> str:
    steps = [
        f"e AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings "
        "WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"p AS MATERIALIZED (SELECT r, part, v[part * len(v) // {PARTS} + 1 : (part + 1) * len(v) // {PARTS}] AS x, row_number() OVER (PARTITION BY part ORDER BY vec_id, v) - 1 AS n FROM e, range({PARTS}) t(part))",
        f"c0 AS MATERIALIZED (SELECT part, n AS entry, x AS c FROM p WHERE n < {ENTRIES})",
    ]
    for k in range(ROUNDS + 1):
        steps.append(f"a{k} AS MATERIALIZED (SELECT r, part, any_value(x) AS x, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': entry}}) AS m "
                     f"FROM p JOIN c{k} USING (part) GROUP BY r, part)")
        if k < ROUNDS:
            steps += [
                f"s{k} AS (SELECT part, m.e AS entry, i, sum(x[i])::BIGINT AS s, count(*) AS n FROM a{k}, range(1, 1 + (SELECT max(len(x)) FROM p)) t(i) WHERE i <= len(x) GROUP BY ALL)",
                f"u{k} AS (SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{k} GROUP BY part, entry)",
                f"c{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(u{k}.c, c{k}.c) AS c FROM c{k} LEFT JOIN u{k} USING (part, entry))",
            ]
    last = ROUNDS
    steps += [
        f"f AS (SELECT r, string_agg(lower(printf('%02x', m.e)), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{last} GROUP BY r)",
        f"b AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM c{last})",
    ]
    return (f"WITH {', '.join(steps)} SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256 FROM e JOIN f USING (r), b")


SQL = _sql()
