"""Top-k search, page text, url filter and quality."""

import random

import duckdb
import numpy as np
import pytest

from tillcast.llm import html_text, quality, topk, url_filter

SF = "/root/testdata/sf0.01"


def brute_top(rows, k, every):
    used = [(i, [int(np.floor(256 * x)) for x in v]) for i, v in rows
            if i is not None and v is not None and not any(x is None or not np.isfinite(x) for x in v)]
    fit = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
    out = []
    for q in {i for i, _ in used if i % every == 0}:
        scored = sorted((-fit(sum(a * b for a, b in zip(w, v, strict=True))), c) for i, w in used if i == q for c, v in used if c != q and len(v) == len(w))
        out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("kw", [{}, {"candidates": 50, "queries": 3}])
def test_top_k(spark, kw):
    rng = random.Random(2)
    rows = [(i, [rng.choice([rng.gauss(0, 0.3), 0.5, -0.25]) for _ in range(24)]) for i in range(300)]
    rows += [(1000, rows[10][1]), (1001, rows[10][1]), (2000, None), (2050, [None] * 24), (2100, [float("nan")] + [0.0] * 23),
             (2150, [float("inf")] + [0.0] * 23), (0, rows[0][1]), (0, rows[9][1]), (77, rows[3][1]), (77, [2.0] * 24), (None, rows[1][1]), (3000, [1.0, 2.0]), (3001, [1.0, 1.0]), (3050, []), (3051, [])]
    df = spark.createDataFrame([(i, v, 7) for i, v in rows], "vec_id long, embedding array<double>, score int").repartition(4)
    got = sorted(tuple(r) for r in topk.top_k(df, 5, 50, **kw).collect())
    ok = [(i, v) for i, v in rows]
    want = brute_top([r for r in ok if r[1] is not None and len(r[1]) == 24], 5, 50) + [(3000, 1, 3001, 256 * 256 * 3), (3050, 1, 3051, 0)]
    assert got == sorted(want)
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_beyond_float(spark):
    rows = [(0, [3e7, 1.0]), (1, [3e7, 1.5]), (2, [-1e30, 0.0]), (50, [2e7, 0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in topk.top_k(df, 2).collect()) == brute_top(rows, 2, 50)


def test_top_k_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{SF}/embeddings.parquet'")
    want = con.execute(f"SELECT query_id, rank, vec_id, score FROM ({topk.SQL}) ORDER BY ALL").fetchall()
    assert sorted(tuple(r) for r in topk.top_k(spark.read.parquet(f"{SF}/embeddings.parquet")).collect()) == want


PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var t="</p>";</script><style>p{}</style></head><body>
<header><p>Site, header, with, many, commas, in, a, long, line, of, text</p></header><nav><ul><li><a href="/x">Menu</a></ul></nav>
<div class="ad">Buy this, now, and that, and more, of the same things again.</div>
<div id="wrap"><article><h1>Title &amp; more</h1><p><b>First para&shy;graph, with commas, and enough text to count.<br><p>Second
  one&nbsp;here, also long enough to be scored as a paragraph.<p>To.<ul><li>item one<li>item two</ul></article>
<div class="comments"><p>A reader, writes, a very long comment, which is not, part of the article at all.</p></div></div>
<aside><p>Side, bar, text, that, is, long, enough, to, win, by, commas</p></aside><form><p>Fill, in, this, form, please, now, thanks</p></form>
<footer>&copy; site</footer></body></html>"""


def test_page_text():
    assert html_text.main_text(PAGE) == "\n\n".join([
        "Title & more", "First para\xadgraph, with commas, and enough text to count.", "Second one here, also long enough to be scored as a paragraph.",
        "To.", "item one", "item two"])


PARAGRAPHS = "<p>Paragraph one, which has commas, and quite a lot of text in it to score well.</p>" * 3


@pytest.mark.parametrize("name", ["with-sidebar", "page has-sidebar", "wrapper no-comments", "layout ad-free", "comments-open post", "hasSidebar"])
def test_wrapper_names_drop_nothing(name):
    want = html_text.main_text(f"<article>{PARAGRAPHS}</article>")
    assert want.count("Paragraph") == 3
    aside = '<div class="sidebar"><p>Side, text, is long enough to count, yes it is.</p></div><div class="comments"><p>Reader, text, is long enough to count.</p></div>'
    assert html_text.main_text(f'<div class="{name}"><article>{PARAGRAPHS}</article>{aside}</div>') == want
    assert html_text.main_text(f'<body><div class="{name}"><div>{PARAGRAPHS}</div>{aside}</div>') == want
    assert html_text.main_text(f'<form action="/x"><div class="{name}"><div>{PARAGRAPHS}</div>{aside}</div></form>') == want


def test_what_stands_between_parts_stays():
    html = (f"<body><div id=c><h1>Title</h1><div>{PARAGRAPHS}</div><h2>Second</h2><ul><li>one<li>two</ul>bare text"
            f"<ul><li><a href=a>Linked</a><li><a href=b>menu</a></ul><div>{PARAGRAPHS}</div><ul><li>after</ul></div>")
    p = html_text.main_text(PARAGRAPHS)
    assert html_text.main_text(html) == "\n\n".join(["Title", p, "Second", "one", "two", "bare text", p])


@pytest.mark.parametrize("html", ["<div>" * 100_000 + "some text, that is here" + "</div>" * 100_000, "<span>" * 100_000 + PARAGRAPHS + "</i>" * 50_000,
                                  "<b><p>" * 30_000 + "text, here", "<p>a, b<button>" * 30_000, "<ul><li>x, y" * 50_000, "<table><tr><td>y" * 30_000 + "</b>" * 30_000])
def test_deep_nesting_takes_linear_time(html):
    import time

    start = time.process_time()
    assert html_text.main_text(html)
    assert time.process_time() - start < 15


def test_very_long_page():
    text = html_text.main_text(f"<article>{PARAGRAPHS * 20_000}</article>")
    assert text.count("Paragraph") == 60_000


def test_page_without_article_element():
    inner = "".join(f"<p>Paragraph {k}, which has commas, and quite a lot of text in it to score.</p>" for k in range(4))
    html = f"<body><div class=menu><a href=a>One</a><a href=b>Two</a></div><div><div>{inner}</div></div><div class='footer'><p>Foot, note, text, which is long, as well</p></div>"
    assert html_text.main_text(html) == "\n\n".join(f"Paragraph {k}, which has commas, and quite a lot of text in it to score." for k in range(4))


def test_links_discount():
    links = "".join(f"<p><a href='{k}'>Linked text, with commas, that is long enough to be a paragraph</a></p>" for k in range(9))
    html = f"<body><div>{links}</div><div><p>Real text, with commas, that is long enough to be a paragraph.</p></div>"
    assert html_text.main_text(html).startswith("Real text")


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "<p title=\"x>y", "<!-- open", "<script>x", "<nav>a</nav>", "</div></p>"])
def test_broken_pages(html):
    assert isinstance(html_text.main_text(html), str)
    assert html_text.main_text("<p>" * 3000 + "x" + "</div>" * 50) == "x"
    assert html_text.main_text("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"


@pytest.mark.parametrize("html, text", [
    ("<p>One.</p><p class=x\">Two.</p><p>Three.</p>", "One.\n\nTwo.\n\nThree."),
    ("<p class=it's>Two.</p><p>don't <b>stop</b></p>", "Two.\n\ndon't stop"),
    ("<p \">One.</p><p>Two.</p>", "One.\n\nTwo."),
    ("<p>One.</p><p title=\"x>Two.</p><p>Three.</p>", "One.\n\nTwo.\n\nThree."),
    ("<p class=x'hidden>One.</p><p title=\"a>b\" lang = 'c>d'>Two.</p>", "One.\n\nTwo."),
    ("<p>One.</p><p title=\"two", "One.")])
def test_text_after_a_stray_quote_stays(html, text):
    assert html_text.main_text(html) == text


def test_pages_query_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "u", PAGE, "c"), (1, "u", PAGE, "c"), (None, None, None, None), (3, "v", "<p>short</p>", "c")],
                               "page_id long, url string, html string, text string")
    got = html_text.extract(df).collect()
    assert len(got) == 4 and sorted(r["n_chars"] for r in got)[0] == 0 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_text.extract(df.limit(0)).count() == 0
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    import re
    from html import unescape

    want = {}
    for r in pages.collect():
        article = re.search(r"<article>(.*)</article>", r["html"], re.S).group(1)
        blocks = [re.sub(r"\s+", " ", unescape(re.sub(r"<[^>]+>", " ", b))).strip() for b in re.split(r"</?(?:p|h1)>", article)]
        want[r["page_id"]] = "\n\n".join(b for b in blocks if b)
    assert {r["page_id"]: r["text"] for r in html_text.extract(pages).collect()} == want


def split_url(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, path = rest[:cut], rest[cut:]
    end = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(c.lower() if c.isascii() else c for c in host), path[:end]


def test_url_rules(spark):
    urls = ["http://a.example.org/es/1", "https://EXAMPLE.org/en/17?x=/es/", "http://example.org/en/2", "http://x.org/", "http://x.org", "http://notexample.org/es/",
            "http://b.com/fr/", "http://b.com/de/x#y", "http://b.com/en/", "ftp://user@h.com:80/de/", None, "no url", "http://?q", "x://h.com/fr/://", "http://b.com//de/", "http://ÄB.com/de/"]
    df = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)] + [(0, urls[0], "h"), (None, urls[0], "h")], "page_id long, url string, host string")
    got = {r["page_id"]: r for r in url_filter.judge(df).collect()}
    assert url_filter.judge(df).count() == len(urls) + 2
    rules = sorted(url_filter.RULES, key=lambda r: -len(r[1] + r[2]))
    for k, u in enumerate(urls):
        host, path = split_url(u)
        fit = next((r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])), None)
        assert (got[k]["host"], got[k]["path"], got[k]["rule"]) == (host, path, fit and fit[1] + fit[2])
        if fit:
            assert got[k]["verdict"] == fit[0]
    assert url_filter.judge(df.limit(0)).count() == 0


def test_url_templates(spark):
    rows = [(k, f"http://big.net/shop/item{k}") for k in range(200)]
    rows += [(1000 + k, f"http://mix.net/casino/game-{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(60)]
    rows += [(2000 + k, f"http://mix.net/news/{k}") for k in range(60)] + [(3000 + k, f"http://mix.net/sport/{k}") for k in range(60)]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=[]).collect()}
    assert got[0]["template"] == "/*/*" or got[0]["template"] == "/shop/item{n}"
    assert len({got[k]["template"] for k in range(200)}) == 1
    assert {got[1000 + k]["verdict"] for k in range(60)} == {"block"} and len({got[1000 + k]["template"] for k in range(60)}) == 1
    assert {got[2000 + k]["verdict"] for k in range(60)} == {"allow"} and {got[3000 + k]["verdict"] for k in range(60)} == {"allow"}
    label = spark.createDataFrame([(2000 + k, 1) for k in range(60)], "page_id long, bad int")
    own = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=[], labels=label).collect()}
    assert {own[2000 + k]["verdict"] for k in range(60)} == {"block"}


def test_rare_bad_branch_of_a_wide_host(spark):
    names = [f"sec{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(29)] + ["casino"]
    rows = [(100 * k + j, f"http://wide.net/{name}/page-{chr(97 + j % 26)}{chr(97 + j // 26)}") for k, name in enumerate(names) for j in range(40)]
    rows += [(10000 + k, f"http://wide.net/once{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(50)]
    got = {r["page_id"]: r for r in url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=[]).collect()}
    assert {(got[2900 + j]["template"], got[2900 + j]["verdict"]) for j in range(40)} == {("/casino/*", "block")}
    assert {got[i]["verdict"] for i, _ in rows if not 2900 <= i < 3000} == {"allow"}
    assert {got[10000 + k]["template"] for k in range(50)} == {"/*"}


def template_tree(rows):
    """Brute force: {(host, path): template} by recursion over the tree's nodes, rows (host, path segments, bad or None)."""
    out = {}

    def down(rows, depth, template):
        children = {}
        for r in rows:
            if len(r[1]) <= depth:
                out[(r[0], r[1])] = template
            else:
                children.setdefault(r[1][depth], []).append(r)
        counts = {seg: (sum(r[2] is not None for r in own), sum(r[2] or 0 for r in own)) for seg, own in children.items()}
        found = []
        for share in sorted({b / n for n, b in counts.values() if n}):
            segs = [s for s, (n, b) in counts.items() if n and b / n == share]
            n, b = (sum(counts[s][k] for s in segs) for k in (0, 1))
            if found:
                n0, b0, before = found[-1]
                rate = (b + b0) / (n + n0)
                if abs(b / n - b0 / n0) <= url_filter.ALIKE * (rate * (1 - rate) * (1 / n + 1 / n0)) ** 0.5:
                    found[-1] = (n + n0, b + b0, before + segs)
                    continue
            found.append((n, b, segs))
        main = max(range(len(found)), key=lambda i: (found[i][0], -i)) if found else 0
        groups = [list(f[2]) for f in found] or [[]]
        groups[main] += [s for s, (n, _) in counts.items() if not n]
        for i, segs in enumerate(groups):
            name = segs[0] if len(segs) == 1 else "*" if i == main else f"*{i + 1}"
            down([r for s in segs for r in children[s]], depth + 1, f"{template}/{name}") if segs else None

    for host in {r[0] for r in rows}:
        down([r for r in rows if r[0] == host], 0, "")
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_templates_equal_brute_force_tree(spark, seed):
    import random

    rng = random.Random(seed)
    rows = []
    for _ in range(900):
        segs = tuple(rng.choice("abcdefghijklmnop"[:rng.choice([3, 16])]) for _ in range(rng.randint(0, 3)))
        odds = 0.9 if segs[:1] == ("b",) else 0.5 if segs[1:2] == ("c",) else 0.05
        rows.append((rng.choice(["h.org", "g.org"]), segs, None if rng.random() < 0.1 else int(rng.random() < odds)))
    urls = spark.createDataFrame([(h, "/" + "/".join(s), b) for h, s, b in rows], "host string, path string, bad int")
    want = template_tree(rows)
    got = {(r["host"], r["path"]): r for r in url_filter.templates(urls, 3).collect()}
    assert {k: r["template"] for k, r in got.items()} == {(h, "/" + "/".join(s)): t for (h, s), t in want.items()}
    for (host, path), r in got.items():
        own = [b for h, s, b in rows if h == host and want[(h, s)] == r["template"]]
        assert r["labelled"] == sum(b is not None for b in own) and r["bad"] == sum(b or 0 for b in own)


def test_small_bad_siblings_are_merged_and_blocked(spark):
    rows = [(f"http://h.net/good{a}/x", 0) for a in "abcde" for _ in range(20)] + [(f"http://h.net/bad{a}/x", 1) for a in "abcde"]
    rows += [(f"http://w.net/page-{chr(97 + i % 26)}{chr(97 + i // 26)}", 0) for i in range(60)] + [("http://w.net/odd", 1)]
    rows = [(k, u, b) for k, (u, b) in enumerate(rows)]
    label = spark.createDataFrame([(k, b) for k, _, b in rows], "page_id long, bad int")
    got = url_filter.judge(spark.createDataFrame([r[:2] for r in rows], "page_id long, url string"), rules=[], labels=label).collect()
    verdict = {r["page_id"]: r["verdict"] for r in got}
    assert all(verdict[k] == ("block" if "/bad" in u else "allow") for k, u, _ in rows)
    assert len({r["template"] for r in got if r["path"].startswith("/bad")}) == 1 and len({r["template"] for r in got if r["path"].startswith("/page")}) == 1


def test_long_paths_and_unlabelled_urls(spark):
    rows = [(k, "http://h.net/" + "a/" * 20_000 + str(k)) for k in range(3)] + [(3, "http://h.net/" + "x" * 100_000)]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=[], labels=spark.createDataFrame([], "page_id long, bad int")).collect()
    assert sorted(r["page_id"] for r in got) == [0, 1, 2, 3] and all(r["verdict"] == "allow" and not r["purity"] for r in got)


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    truth = (rng.random(20000) < 0.85).astype(int)
    finds = np.array([0.5, 0.6, 0.4, 0.7])
    v = np.where(truth[:, None] == 0, np.where(rng.random((20000, 4)) < finds, 0, 1), np.where(rng.random((20000, 4)) < 0.02, 0, 1))
    patterns, counts = np.unique(v, axis=0, return_counts=True)
    share, acc, _ = quality.expectation_maximisation(patterns, counts.astype(float), 400)
    assert abs(share - 0.85) < 0.03 and np.abs(acc[0, :, 0] - finds).max() < 0.06 and acc[1, :, 0].max() < 0.04


def test_quality_agrees_with_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = quality.query(docs).join(labels, "doc_id").collect()
    good = [r for r in rows if r["quality"] == 1]
    assert sum(r["keep"] for r in good) >= 0.97 * len(good)
    assert sum(r["keep"] == (r["quality"] == 1) for r in rows) >= 0.95 * len(rows)


def test_quality_edges(spark):
    df = spark.createDataFrame([(1, None, 1), (2, "", 1), (3, "ok then, this is a sentence.", 1), (None, "another sentence here.", 1), (3, "ok then, this is a sentence.", 1)],
                               "doc_id long, text string, score int")
    got = quality.query(df).collect()
    assert len(got) == 5 and {r["score"] for r in got if r["doc_id"] in (1, 2)} == {0.0}
    assert quality.query(df.limit(0)).count() == 0


def test_quality_without_ids_or_with_one_text(spark):
    good, bad = "ok then, this is sentence number {} of the text.", "{} {} buy buy buy $$$ ###"
    texts = [(good if k % 4 else bad).format(k, k) for k in range(400)]
    for rows in ([(None, t) for t in texts], [(7, t) for t in texts], [(None, texts[1])] * 400, [(7, None)] * 400):
        for more in (2, 5):
            weights, found = quality.fit(spark.createDataFrame(rows, "doc_id long, text string"), train_rows=more)
            assert np.isfinite(weights).all() and found["good"] is not None
