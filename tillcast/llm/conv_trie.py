"""Prefix trie of conversations, by a skeleton of splitter paths and sorted shards.

Every conversation is a path of turn digests. The paths are dealt by range
into shards of about equal size; a splitter is a whole (path, conv_id), so
copies of one conversation can lie in several shards. All prefixes of the
splitters form the skeleton, a small trie that every task gets: a node whose
members lie in more than one shard is always a prefix of a splitter. A shard is
sorted and walked once. Nodes off the skeleton have all members in it and are
finished there; for skeleton nodes a shard only hands on partial aggregates,
which are added up and folded upwards.

Scale: texts become 16-byte digests in the first pass and never move. A shard
is streamed, holding one path and the finished nodes below one parent. The
skeleton has at most (shards x path length) nodes. The ids that end at a
skeleton node (thousands of copies of one conversation, say) are joined up in
pieces by the shards, and hashed piece after piece in one stream, as SHA-256
has to read them in order. A conversation is one row of 20 bytes a turn.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillcast.llm.common import prepare, shuffle_parts, written

#: Conversations share turns with the first of each run of BASE ids; at most HEADS - 1 turns are taken from it.
BASE, HEADS = 20, 4
#: Turns of a shard to aim at, rows of the splitter sample for each shard, ids of one piece of a hashed list.
SHARD_TURNS, SAMPLE, PIECE_IDS = 100_000, 30, 8_192
WORD = r"[^\x20\x09-\x0D]+"

_EMPTY = hashlib.sha256(b"").hexdigest()
_NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
         "saved_tokens long, ends_sha256 string")
#: What a shard emits: finished nodes (sk null), partial aggregates of skeleton nodes, pieces of their end lists (first_id set).
_SHARD = f"{_NODE}, sk int, parent_sk int, words long, first_id long, ids binary"
_ARROW = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()), ("n_convs", pa.int64()),
                    ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()), ("ends_sha256", pa.string()),
                    ("sk", pa.int32()), ("parent_sk", pa.int32()), ("words", pa.int64()), ("first_id", pa.int64()), ("ids", pa.binary())])


def taken(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its run: crc32 of its decimal id, modulo HEADS."""
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def rebuilt(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """(id, path array<binary>, words array<int>): one row per conversation, its rebuilt turns in order."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("id"), F.col(turn_col).alias("turn"), digest.alias("digest"),
        F.size(F.regexp_extract_all(text, F.lit(WORD), F.lit(0))).alias("words"))
    order = Window.partitionBy("id").orderBy(F.asc_nulls_first("turn"), "digest")
    own = written(rows.withColumn("pos", F.row_number().over(order) - 1).drop("turn"), "turns")
    convs = own.where("pos = 0").select("id", taken(F.col("id")).alias("h"), (F.col("id") - F.col("id") % BASE).alias("base"))
    heads = own.where((F.col("pos") < HEADS - 1) & (F.col("id") % BASE == 0)).withColumnRenamed("id", "base")
    borrowed = convs.where("h > 0").join(heads, "base").where("pos < h").select("id", F.lit(0).alias("src"), "pos", "digest", "words")
    kept = own.where(F.col("pos") >= taken(F.col("id"))).select("id", F.lit(1).alias("src"), "pos", "digest", "words")
    # every conversation has a row even where no turn is left to it
    there = convs.select("id", *(F.lit(None).cast(t).alias(c) for c, t in (("src", "int"), ("pos", "int"), ("digest", "binary"), ("words", "int"))))
    turn = F.when(F.col("src").isNotNull(), F.struct("src", "pos", "digest", "words"))
    return (borrowed.unionByName(kept).unionByName(there).groupBy("id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
            .select("id", F.col("t.digest").alias("path"), F.col("t.words").alias("words")))


def splitters(sample: list[tuple[list[bytes], int]], shards: int) -> list[tuple[list[bytes], int]]:
    """At most shards - 1 (path, id) of the sorted sample, with about equal numbers of turns between them."""
    sample = sorted(sample)
    total, done, out = sum(len(p) + 1 for p, _ in sample), 0, []
    for path, conv in sample:
        if done * shards >= total * (len(out) + 1) and len(out) < shards - 1:
            out.append((path, conv))
        done += len(path) + 1
    return out


def skeleton(paths: list[list[bytes]]) -> dict[tuple[int, bytes], int]:
    """The trie of the splitter paths: (number of a node, turn digest) -> number of the child. The root is 0, parents come first."""
    out: dict[tuple[int, bytes], int] = {}
    for path in paths:
        at = 0
        for d in path:
            at = out.setdefault((at, d), len(out) + 1)
    return out


def _deal(cuts):
    def deal(batches):
        for b in batches:
            paths, ids = b.column("path").to_pylist(), b.column("id").to_pylist()
            at = [bisect_right(cuts.value, (p, i)) for p, i in zip(paths, ids, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=[*b.schema.names, "shard"])
    return deal


class _Open:
    """A node whose members are being read."""

    __slots__ = ("sk", "low", "n", "children", "leaves", "saved", "words", "ends", "held", "waiting")

    def __init__(self, sk, words):
        self.sk, self.words = sk, words
        self.low, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        self.ends = None if sk is not None else hashlib.sha256()
        self.held: list[int] = []  # ids of a skeleton node that are not handed on yet
        self.waiting: list[tuple] = []  # finished children, which lack the smallest member of this node


def _walk(trie, piece_ids: int):
    def piece(node):
        ids = ",".join(map(str, node.held)).encode()
        return (*[None] * 8, node.sk, None, None, node.held[0], ids)

    def close(stack, out):
        node, depth = stack.pop(), len(stack)
        parent = stack[-1] if stack else None
        if node.sk is not None:
            if node.held:
                out.append(piece(node))
            out.append((node.low, depth, None, node.n, node.children, node.leaves, node.saved, None, node.sk, None, node.words, None, None))
        else:
            out.extend((*r[:2], node.low, *r[3:]) for r in node.waiting)
            node.leaves = node.leaves or 1
            node.saved += (node.n - 1) * node.words
            row = (node.low, depth, None, node.n, node.children, node.leaves, node.saved, node.ends.hexdigest(), None, parent.sk, None, None, None)
            (parent.waiting if parent.sk is None else out).append(row)
            parent.children += 1
            parent.leaves += node.leaves
            parent.saved += node.saved
        if parent is not None:
            parent.n += node.n
            parent.low = node.low if parent.low is None else min(parent.low, node.low)

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)

    def walk(batches):
        children = trie.value
        shard, last, stack, out = None, [], [], []
        for b in batches:
            for s, path, words, conv in zip(*(b.column(c).to_pylist() for c in ("shard", "path", "words", "id")), strict=True):
                same = 0
                if s != shard:
                    while stack:
                        close(stack, out)
                    shard = s
                    stack.append(_Open(0, 0))
                else:
                    while same < len(last) and same < len(path) and last[same] == path[same]:
                        same += 1
                    while len(stack) > same + 1:
                        close(stack, out)
                for d in range(same, len(path)):
                    up = stack[-1].sk
                    stack.append(_Open(None if up is None else children.get((up, path[d])), words[d]))
                node, last = stack[-1], path
                node.n += 1
                node.low = conv if node.low is None else min(node.low, conv)
                if node.sk is None:
                    node.ends.update(f"{',' if node.n > 1 else ''}{conv}".encode())
                else:
                    node.held.append(conv)
                    if len(node.held) == piece_ids:
                        out.append(piece(node))
                        node.held = []
                if len(out) >= 4096:
                    yield batch(out)
                    out = []
        while stack:
            close(stack, out)
        for k in range(0, len(out), 4096):
            yield batch(out[k:k + 4096])
    return walk


def _hash(batches):
    """(sk, ends_sha256) from the pieces of id lists, sorted by node and first id."""
    at, digest = None, None
    for b in batches:
        for sk, ids in zip(b.column("sk").to_pylist(), b.column("ids"), strict=True):
            if sk != at:
                if at is not None:
                    yield pa.RecordBatch.from_pydict({"sk": pa.array([at], pa.int32()), "ends": [digest.hexdigest()]})
                at, digest = sk, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_buffer())
    if at is not None:
        yield pa.RecordBatch.from_pydict({"sk": pa.array([at], pa.int32()), "ends": [digest.hexdigest()]})


def fold(trie: dict[tuple[int, bytes], int], parts: dict[int, tuple]) -> list[tuple]:
    """Skeleton nodes from their summed partial aggregates (low, depth, n, children, leaves, saved, words), children before parents."""
    up = {child: parent for (parent, _), child in trie.items()}
    total = {k: list(v) for k, v in parts.items()}
    for k in sorted(total, reverse=True):
        low, depth, n, children, leaves, saved, words = total[k]
        leaves = leaves or 1
        saved += (n - 1) * words
        total[k] = [low, depth, n, children, leaves, saved, words]
        if k:
            parent = total[up[k]]
            parent[3] += 1
            parent[4] += leaves
            parent[5] += saved
    return [(k, t[0], t[1], total[up[k]][0] if k else None, *t[2:6]) for k, t in sorted(total.items())]


def prefix_trie(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                text_col: str = "text", shard_turns: int = SHARD_TURNS, piece_ids: int = PIECE_IDS) -> DataFrame:
    """One row per node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Conversations are rebuilt first (``rebuilt``). Null role or text is empty.
    Rows of one conversation are ordered by turn, null first; rows of equal
    turn by the SHA-256 of role and text; equal rows are turns of their own.
    Rows without conv_id belong to no conversation. c % 20 has the sign of c,
    as in SQL. A conversation without a turn left ends at the root. Without
    any conversation there is no root, so the result is empty. Other columns
    are not read, so their names cannot clash.
    """
    spark = turns.sparkSession
    prepare(spark)
    paths = written(rebuilt(turns, conv_col, turn_col, role_col, text_col), "paths")
    convs, length = paths.agg(F.count("*"), F.sum(F.size("path") + 1)).head()
    if not convs:
        return spark.createDataFrame([], _NODE)
    shards = min(convs, max(shuffle_parts(spark), -(-length // shard_turns)))
    places = 1 << 30
    share = min(places, -(-places * SAMPLE * shards // convs))
    sample = paths.where(F.pmod(F.xxhash64("id"), F.lit(places)) < share).select("path", "id").collect()
    cuts = splitters([([bytes(d) for d in r["path"]], r["id"]) for r in sample], shards)
    trie = skeleton([p for p, _ in cuts])
    sc = spark.sparkContext
    dealt = paths.mapInArrow(_deal(sc.broadcast(cuts)), "id long, path array<binary>, words array<int>, shard int")
    walked = written(dealt.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "id")
                     .mapInArrow(_walk(sc.broadcast(trie), piece_ids), _SHARD), "shards")

    part = walked.where("sk is not null and first_id is null").groupBy("sk").agg(
        F.min("conv_id"), F.max("depth"), F.sum("n_convs"), F.sum("n_children"), F.sum("n_leaves"), F.sum("saved_tokens"), F.max("words"))
    nodes = fold(trie, {r[0]: tuple(r)[1:] for r in part.collect()})
    bones = spark.createDataFrame(nodes, "sk int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long")
    ends = (walked.where("first_id is not null").select("sk", "first_id", "ids").repartition("sk").sortWithinPartitions("sk", "first_id")
            .select("sk", "ids").mapInArrow(_hash, "sk int, ends string"))
    top = bones.join(ends, "sk", "left").withColumn("ends_sha256", F.coalesce("ends", F.lit(_EMPTY)))
    # the skeleton is bounded (module docstring), so the parents on it are looked up map-side
    low = F.broadcast(bones.select(F.col("sk").alias("parent_sk"), F.col("conv_id").alias("low")))
    rest = walked.where("sk is null").join(low, "parent_sk", "left").withColumn("parent_conv_id", F.coalesce("low", "parent_conv_id"))
    columns = [f.split()[0] for f in _NODE.split(", ")]
    return rest.select(columns).unionByName(top.select(columns))


SQL = r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT conv_id, turn, left(sha256(strlen(role) || ':' || role || text), 32) AS digest,
             len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words FROM t),
o AS (SELECT conv_id, digest, words, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS pos FROM g),
c AS (SELECT conv_id, conv_id - conv_id % 20 AS base,
             xor(4294967295, list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
               lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS src, pos, digest, words FROM c JOIN o ON o.conv_id = base AND pos < h
      UNION ALL SELECT conv_id, 1, pos, digest, words FROM o JOIN c USING (conv_id) WHERE pos >= h),
p AS (SELECT conv_id, words, row_number() OVER w AS depth, sha256(string_agg(digest, '') OVER w) AS key, count(*) OVER (PARTITION BY conv_id) AS turns
      FROM r WINDOW w AS (PARTITION BY conv_id ORDER BY src, pos)),
m AS (SELECT conv_id, depth, key, words, depth = turns AS ends FROM p
      UNION ALL SELECT conv_id, 0, '', 0, NOT EXISTS (SELECT 1 FROM r WHERE r.conv_id = c.conv_id) FROM c),
n AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(words) AS words,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY key, depth),
u AS (SELECT n.*, pm.key AS parent, pn.conv_id AS parent_conv_id FROM n
      LEFT JOIN m pm ON pm.conv_id = n.conv_id AND pm.depth = n.depth - 1 LEFT JOIN n pn ON pn.key = pm.key AND pn.depth = pm.depth),
k AS (SELECT parent AS key, count(*) AS n_children FROM u WHERE parent IS NOT NULL GROUP BY parent),
v AS (SELECT u.*, coalesce(k.n_children, 0) AS n_children FROM u LEFT JOIN k USING (key)),
s AS (SELECT a.key, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((v.n_convs - 1) * v.words) AS saved_tokens
      FROM v JOIN m a ON a.conv_id = v.conv_id AND a.depth <= v.depth GROUP BY a.key)
SELECT conv_id::BIGINT AS conv_id, depth::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id, n_convs::BIGINT AS n_convs,
       n_children::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, ends_sha256
FROM v JOIN s USING (key)
"""
