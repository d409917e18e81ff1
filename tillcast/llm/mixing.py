"""Mixing sources to target weights by Poisson replication (DataFrame functions only).

Every document draws how often it appears from a Poisson distribution whose
mean is the repetition rate of its source: target share x target size /
present size of the source. The draw inverts the distribution at a number
hashed from (seed, doc_id), so it depends on nothing but the document, and
the copies are dealt out by another hash of (seed, doc_id, copy), a global
shuffle that a lost executor repeats exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Mean of one inverted draw; a larger rate is the sum of independent draws of at most this mean.
MAX_MEAN = 16.0
#: Terms of the distribution that are tabulated: beyond 80 a mean of 16 has less than 2^-53.
TERMS = 80
OTHER = "*"


def uniform(seed: int, *parts: Column) -> Column:
    """A number of [0, 1) with 52 bits from the md5 of seed and parts."""
    digest = F.md5(F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def cumulative(mean: Column) -> Column:
    """P(X <= k) for k = 0 ... TERMS of a Poisson distribution, as an array."""
    start = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("c"), F.array(F.exp(-mean)).alias("a"))

    def step(s, k):
        p = s["p"] * mean / k
        c = s["c"] + p
        return F.struct(p.alias("p"), c.alias("c"), F.concat(s["a"], F.array(c)).alias("a"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, step, lambda s: s["a"])


def rates(docs: DataFrame, weights: dict[str, float], total: float | None = None,
          other_weight: float = 0.0, source_col: str = "source") -> DataFrame:
    """(key, rate, draws, cdf) per weighted source; ``*`` stands for all sources not in ``weights``.

    A source without rows gets no share; the others keep theirs. One row per
    entry of ``weights`` at most, whatever the data.
    """
    listed = [s for s in weights if weights[s] > 0]
    size = (docs.groupBy(source_key(docs, listed, source_col).alias("key")).agg(F.count("*").alias("size")))
    spark = docs.sparkSession
    share = spark.createDataFrame([(s, float(weights[s])) for s in listed] + [(OTHER, float(other_weight))],
                                  "key string, weight double")
    stat = size.join(F.broadcast(share), "key")
    target = F.lit(float(total)) if total is not None else size.agg(F.sum("size").cast("double")).scalar()
    summed = stat.agg(F.sum("weight")).scalar()
    rate = F.when(F.col("weight") > 0, F.col("weight") / summed * target / F.col("size")).otherwise(0.0)
    return (stat.select("key", rate.alias("rate"))
            .withColumn("draws", F.greatest(F.ceil(F.col("rate") / MAX_MEAN), F.lit(1)).cast("int"))
            .withColumn("cdf", cumulative(F.col("rate") / F.col("draws"))))


def source_key(docs: DataFrame, listed: list[str], source_col: str) -> Column:
    src = docs[source_col].cast("string")
    return F.when(src.isin(listed), src).otherwise(F.lit(OTHER))


def mix(docs: DataFrame, weights: dict[str, float], total: float | None = None, other_weight: float = 0.0,
        seed: int = 0, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """All columns of ``docs`` plus ``copy`` (from 0) and ``rate``, once per drawn copy, globally shuffled.

    total: rows to expect (default: as many as ``docs`` has). Sources that
    ``weights`` does not list, and null, share ``other_weight``; at 0 they are
    left out, as the target says. Rows that repeat a doc_id draw the same
    count. A null doc_id draws as the empty id. Columns named ``copy`` or
    ``rate`` are replaced.

    Only the size of each source is gathered (partial sums). The broadcast
    rates hold one row per entry of ``weights``, so a hot source is not
    shuffled by its key; the copies go to partitions by a hash of the document.
    """
    listed = [s for s in weights if weights[s] > 0]
    per = rates(docs, weights, total, other_weight, source_col)
    id_text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    numbers = F.transform(F.sequence(F.lit(1), F.col("__draws")), lambda j: uniform(seed, id_text, j))
    count = F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter(F.col("__cdf"), lambda c: c <= u)))
    cols = [c for c in docs.columns if c not in ("copy", "rate")]
    out = (docs.withColumn("__key", source_key(docs, listed, source_col))
           .join(F.broadcast(per.select(F.col("key").alias("__key"), F.col("rate").alias("__rate"),
                                        F.col("draws").alias("__draws"), F.col("cdf").alias("__cdf"))), "__key")
           .withColumn("__count", count).where("__count > 0")
           .select(*cols, F.explode(F.sequence(F.lit(0), F.col("__count") - 1)).alias("copy"), F.col("__rate").alias("rate")))
    place = F.xxhash64(F.lit(seed), id_text, F.col("copy"))
    return out.withColumn("__place", place).repartition("__place").sortWithinPartitions("__place").drop("__place")


#: Production weights: half of what the hot source holds by size, the rest evenly; unlisted sources stay with a small share.
WEIGHTS = {"src0": 0.20, **{f"src{i}": 0.04 for i in range(1, 20)}}
OTHER_WEIGHT = 0.04
SEED = 20

SQL = f"""
WITH RECURSIVE w(key, weight) AS (VALUES {", ".join(f"('{k}', {v!r}::DOUBLE)" for k, v in WEIGHTS.items())}, ('*', {OTHER_WEIGHT!r}::DOUBLE)),
d AS (SELECT doc_id, source, n_chars, lang, text, CASE WHEN source IN ({", ".join(f"'{k}'" for k in WEIGHTS)}) THEN source ELSE '*' END AS key FROM documents),
s AS (SELECT key, count(*) AS size FROM d GROUP BY key),
r AS (SELECT key, weight / (SELECT sum(weight) FROM s JOIN w USING (key)) * (SELECT sum(size)::DOUBLE FROM s) / size AS rate FROM s JOIN w USING (key)),
m AS (SELECT key, rate, greatest(ceil(rate / {MAX_MEAN}), 1)::INT AS draws FROM r),
c(key, k, p, cum) AS (
  SELECT key, 0, exp(-(rate / draws)), exp(-(rate / draws)) FROM m
  UNION ALL
  SELECT c.key, k + 1, p * (rate / draws) / (k + 1), cum + p * (rate / draws) / (k + 1) FROM c JOIN m USING (key) WHERE k < {TERMS}),
cdf AS (SELECT key, list(cum ORDER BY k) AS a FROM c GROUP BY key),
n AS (SELECT d.*, m.rate,
  list_sum(list_transform(range(1, draws + 1), lambda j: len(list_filter(a, lambda x: x <= ('0x' || md5('{SEED}|' || doc_id || '|' || j)[1:13])::BIGINT / {float(1 << 52)!r}))))::INT AS n
  FROM d JOIN m USING (key) JOIN cdf USING (key))
SELECT doc_id, text, lang, source, n_chars, copy::INT AS copy, round(rate, 9) AS rate FROM n, unnest(range(n)) AS u(copy)
"""


def query(docs: DataFrame) -> DataFrame:
    return mix(docs, WEIGHTS, other_weight=OTHER_WEIGHT, seed=SEED).withColumn("rate", F.round("rate", 9))
