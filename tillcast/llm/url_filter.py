"""URL filters: fixed rules, and a path-template tree for what no rule covers.

Tree. Per host, the segments of the urls' paths form a tree. Going down,
segments that vary by form (digits, hexadecimal runs) become wildcards, and the
children of a node are merged with each other where they are alike: sorted by
their labelled share of bad urls, each joins the branch before it unless a
two-proportion z test tells it from that branch. So segments that are seen once
meet in one branch for each share, and a small bad branch stays apart from the
good ones, however large the host. The branch with most labelled urls takes the
children without labels. A template is rejected when its
smoothed purity, (bad + strength * base rate) / (labelled + strength), is at
least ``threshold``.

Labels come from a frame of (page_id, bad); by default from words in host and
path that name what a corpus does not want.

Scale: the tree is built level by level with grouped counts over distinct
generalised paths, not over pages; every count is summed before it is shuffled
and only nodes' counts are joined back. What meets in one row of a node is one
entry for each different share of its children: shares of small counts coincide, so
a node over N urls has at most some N^(2/3) of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.llm.common import written

# The rules of the production filter, (verdict, host, path).
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]
# Words that label a url as bad.
BAD_WORDS = ["adult", "bet", "bets", "casino", "gambling", "pills", "poker", "porn", "sex", "viagra", "xxx"]

#: Levels of the tree (deeper segments join the last one).
DEPTH = 6
#: z of siblings that are alike; weight of the base rate; purity from which a template is rejected.
ALIKE, STRENGTH, THRESHOLD = 1.96, 2.0, 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct (verdict, rule), or null."""
    out = F.lit(None).cast("struct<verdict:string,rule:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(verdict).alias("verdict"), F.lit(h + p).alias("rule"))).otherwise(out)
    return out


def segments(path: Column, depth: int = DEPTH) -> Column:
    """Segments of a path with variable forms replaced: runs of digits by {n}, long hexadecimal runs by {h}."""
    form = F.regexp_replace(F.regexp_replace(path, r"(?i)\b(?=[0-9a-f-]*[0-9])(?=[0-9a-f-]*[a-f])[0-9a-f-]{8,}\b", "{h}"), r"[0-9]+", "{n}")
    parts = F.filter(F.split(form, "/"), lambda s: s != "")
    deep = F.array_join(F.slice(parts, depth, 1 << 30), "/")
    return F.when(F.size(parts) < depth, parts).otherwise(F.concat(F.slice(parts, 1, depth - 1), F.array(deep)))


def weak_labels(host: Column, path: Column) -> Column:
    """1 where a whole word of host or path is one of BAD_WORDS, else 0."""
    return F.arrays_overlap(F.split(F.concat_ws("/", host, path), r"[^a-z]+"), F.array(*map(F.lit, BAD_WORDS))).cast("int")


def alike(a: Column, b: Column) -> Column:
    """Whether the bad shares of two structs (labelled, bad) pass for one (two-proportion z test with the pooled share)."""
    rate = (a["bad"] + b["bad"]) / (a["labelled"] + b["labelled"])
    error = F.sqrt(rate * (1 - rate) * (1 / a["labelled"] + 1 / b["labelled"]))
    return F.abs(a["bad"] / a["labelled"] - b["bad"] / b["labelled"]) <= ALIKE * error


def branches(shares: Column) -> Column:
    """Branches (share, labelled, bad, kids) of a node, in order of share, from its children summed by share: each
    share joins the branch before it where both are alike; ``share`` is the branch's least."""
    empty = F.filter(shares, lambda s: F.lit(False))

    def join(acc, s):
        last = F.element_at(acc, -1)
        both = F.struct(last["share"].alias("share"), (last["labelled"] + s["labelled"]).alias("labelled"),
                        (last["bad"] + s["bad"]).alias("bad"), (last["kids"] + s["kids"]).alias("kids"))
        return (F.when(F.size(acc) == 0, F.array(s))
                .when(alike(last, s), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(both)))
                .otherwise(F.concat(acc, F.array(s))))

    return F.aggregate(shares, empty, join)


def templates(urls: DataFrame, depth: int = DEPTH) -> DataFrame:
    """(host, path, template, labelled, bad): the template of every distinct (host, path) of ``urls``
    (host, path, bad) and the labelled and bad urls of the whole template. In a template ``*`` is the branch with
    most labelled urls, ``*k`` the k-th by share; a branch of one segment keeps its name."""
    level = written(urls.groupBy("host", "path").agg(F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
                    .withColumn("segs", segments(F.col("path"), depth)).withColumn("template", F.lit("")), "paths")
    for k in range(1, depth + 1):
        here = level.withColumn("seg", F.when(F.size("segs") >= k, F.get("segs", F.lit(k - 1))))
        child = (here.where("seg is not null").groupBy("host", "template", "seg").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
                 .withColumn("share", F.when(F.col("labelled") > 0, F.col("bad") / F.col("labelled"))))
        by_share = (child.groupBy("host", "template", "share")
                    .agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"), F.count("*").alias("kids")))
        entry = F.struct("share", "labelled", "bad", "kids")
        node = (by_share.groupBy("host", "template")
                .agg(F.sort_array(F.collect_list(F.when(F.col("share").isNotNull(), entry))).alias("shares"),
                     F.coalesce(F.sum(F.when(F.col("share").isNull(), F.col("kids"))), F.lit(0)).alias("loose"))
                .select("host", "template", "loose", branches(F.col("shares")).alias("found"))
                .withColumn("main", -F.array_max(F.transform("found", lambda b, i: F.struct(b["labelled"].alias("n"), (-i - 1).alias("at"))))["at"]))
        c = child.join(node, ["host", "template"])
        place = F.when(F.col("share").isNull(), F.coalesce("main", F.lit(0))).otherwise(F.size(F.filter("found", lambda b: b["share"] <= F.col("share"))))
        c = c.withColumn("place", place)
        first = F.col("place") == F.coalesce("main", F.lit(0))
        kids = F.coalesce(F.get("found", F.col("place") - 1)["kids"], F.lit(0)) + F.when(first, F.col("loose")).otherwise(0)
        to = c.select("host", "template", "seg", F.when(kids == 1, F.col("seg")).when(first, "*").otherwise(F.concat(F.lit("*"), F.col("place").cast("string"))).alias("to"))
        level = (here.join(to, ["host", "template", "seg"], "left")
                 .withColumn("template", F.when(F.col("to").isNull(), F.col("template")).otherwise(F.concat("template", F.lit("/"), "to")))
                 .drop("seg", "to"))
        level = written(level, f"level-{k}")
    total = level.groupBy("host", "template").agg(F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad"))
    return level.select("host", "path", "template").join(total, ["host", "template"])


def judge(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, labels: DataFrame | None = None, id_col: str = "page_id",
          url_col: str = "url", threshold: float = THRESHOLD, strength: float = STRENGTH, depth: int = DEPTH) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, purity), one row per row of ``pages``.

    A rule's verdict comes first; else the template's: block where its
    smoothed purity reaches ``threshold``. A url that is null or has no
    ``://`` has empty host and path and template; such urls are judged like
    any other host's. ``labels`` (page_id, bad 0/1) replaces the word labels;
    urls without a label count in no purity. With no labelled url at all
    every purity is 0. Repeated rows and null ids stay as they are.
    """
    host, path = host_and_path(F.col(url_col).cast("string"))
    seen = pages.select(F.col(id_col).cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    if labels is None:
        marked = seen.withColumn("bad", weak_labels(F.col("host"), F.col("path")))
    else:
        one = labels.groupBy("page_id").agg(F.max("bad").cast("int").alias("bad"))
        marked = seen.join(one, "page_id", "left")
    found = templates(marked, depth)
    base = found.select("host", "template", "labelled", "bad").distinct().agg(F.try_divide(F.sum("bad"), F.sum("labelled")).alias("base")).head()[0] or 0.0
    purity = (F.col("bad") + F.lit(strength * base)) / (F.col("labelled") + F.lit(strength))
    judged = found.select("host", "path", "template", purity.alias("purity"))
    rule = rule_for(F.col("host"), F.col("path"), rules)
    return (seen.join(judged, ["host", "path"], "left").withColumn("__rule", rule)
            .select("page_id", "host", "path", F.col("__rule.rule").alias("rule"),
                    F.coalesce("__rule.verdict", F.when(F.col("purity") >= threshold, "block").otherwise("allow")).alias("verdict"),
                    "template", "purity"))
