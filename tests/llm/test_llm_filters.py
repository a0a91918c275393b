"""URL filter, quality classifier, decontamination and HTML extraction."""

import hashlib
import random
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from llm_cases import brute_hits, docs
from quarry.llm import decontaminate as D
from quarry.llm import html_text as H
from quarry.llm import quality as Q
from quarry.llm import urls as U

SF = "/root/testdata/sf0.01"


# --- URLs -----------------------------------------------------------------------

def url_brute(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for h, p, v in U.RULES:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[0])):
            best = (h + p, v)
    return host, path, best


URLS = [None, "", "x", "http://A.NET", "http://a.net/", "https://EXAMPLE.net/en/", "http://xexample.net/en/x?y", "ftp://org/fr/",
        "http://q.example.com/de/?a#b", "x://y://z/p", "http://h?x://k/", "a\nb://net/x\ny?q", "http://É.ORG/fr/", "://", "://net/",
        "http://org/fr", "http://www.org/fr/" + "a/" * 20000, "http://example.net/EN/", "http://net/", "http://net/"]


def test_urls_hosts_paths_and_rules(spark):
    pages = spark.createDataFrame([(i, u, "clash", 1) for i, u in enumerate(URLS)], "page_id long, url string, host string, rule int")
    got = {r.page_id: r for r in U.filter_urls(pages).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, best = url_brute(u)
        r = got[i]
        assert (r.host, r.path, r.rule) == (host, path, best and best[0])
        assert r.verdict == best[1] if best else r.verdict in ("allow", "block")


def test_urls_trees_learn_labels(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url")
    block = F.col("verdict") == "block"
    got, share = U.filter_urls(pages, rows=400).filter("rule is not null").agg(
        F.avg(((F.col("block_chance") > 0.5) == block).cast("int")), F.avg(block.cast("int"))).first()
    assert got > max(share, 1 - share) + 0.1           # most of these URLs are outside the sample


@pytest.mark.parametrize("urls", [[], [None], ["http://x.com/"], ["http://a.net/", "http://b.net/"], ["http://org/fr/"]])
def test_urls_without_two_classes(spark, urls):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = U.filter_urls(pages).collect()
    assert len(got) == len(urls) and all(r.verdict in ("allow", "block") for r in got)


def test_url_suffix_statistics_cover_all_labels(spark):
    rows = [(i, f"http://h{i}.example.net/{'en' if i % 3 else 'xx'}/{i}") for i in range(900)]
    rows += [(5000 + i, f"http://h{i}.org/fr/{i}") for i in range(300)]
    df = U.lexical(spark.createDataFrame(rows, "page_id long, url string"))
    _, by_rule = U.match_rules(F.col("host"), F.col("path"))
    labelled = df.withColumn("y", (by_rule == "block").cast("double")).withColumn("half", F.pmod(F.hash("url"), F.lit(2)))
    counts = U.suffix_counts(labelled)
    got = {r.suffix: (r.b0 + r.b1, r.n0 + r.n1) for r in counts.collect()}
    assert got == {"net": (300.0, 900.0), "org": (0.0, 300.0)}
    half = {(r.suffix, r.half): (r.b, r.n) for r in labelled.groupBy("suffix", "half").agg(F.sum("y").alias("b"), F.count("*").alias("n")).collect()}
    totals = tuple(float(sum(n for (_, h), (_, n) in half.items() if h == i)) for i in (0, 1))
    seen = U.with_suffixes(labelled, counts, totals, 0.25, learning=True).select("suffix", "half", "f_suffix_share").distinct().collect()
    for r in seen:                                          # a URL to learn from sees the other half only
        b, n = half[r.suffix, 1 - r.half]
        assert abs(r.f_suffix_share - (b + 5.0) / (n + 20.0)) < 1e-12
    assert len(seen) == 4


def test_url_rare_class_is_learnt(spark):
    """Three blocked URLs among thousands: a draw over all classes together would miss them."""
    rows = [(i, f"http://h{i}.org/fr/{i}") for i in range(4000)] + [(9000 + i, f"http://a{i}.net/x/{i}") for i in range(3)]
    rows += [(9100, "http://b.com/x/1"), (9101, None)]
    got = U.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), rows=100)
    assert got.select("block_chance").distinct().count() > 1 and got.count() == len(rows)


def test_url_features(spark):
    r = U.lexical(spark.createDataFrame([("https://a.b-c.org/x/yy/?p=1&q=%20#z",)], "url string")).first()
    assert (r.f_params, r.f_equals, r.f_depth, r.f_labels, r.f_secure, r.f_fragment, r.f_longest) == (2, 2, 3, 2, 1, 1, 2)
    r = U.lexical(spark.createDataFrame([("aabb",)], "url string")).first()
    assert r.f_entropy == pytest.approx(1.0) and r.f_digits == 0


# --- quality ----------------------------------------------------------------------

def test_quality_trees_match_a_plain_walk():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(600, len(Q.STATISTICS)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    m = Q.fit(x, y, trees=25)

    def walk(row):
        total = m.base
        for t in range(len(m.feature)):
            node = 0
            while node < m.feature.shape[1]:
                node = 2 * node + 1 + int(row[m.feature[t, node]] > m.threshold[t, node])
            total += m.value[t, node - m.feature.shape[1]]
        return total
    assert np.allclose(m.margin(x), [walk(r) for r in x])
    assert ((m.score(x) > 0.5) == (y > 0)).mean() > 0.95


def test_quality_held_out_accuracy(spark):
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    got = (Q.classify(d, labels).withColumn("held", Q.held_out(F.col("doc_id"))).filter("held")
           .join(labels, "doc_id").select((F.col("quality_predicted") == F.col("quality")).cast("int").alias("ok")).agg(F.avg("ok"), F.count("*")).first())
    assert got[1] > 50 and got[0] > 0.95


def test_quality_edges(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "word " * 30000), (None, "text without id"), (5, "a b c"), (5, "a b c"), (6, "#$%"), (7, "a\n\na")]
    labels = spark.createDataFrame([(1, 0, 0), (5, 1, 0), (5, 1, 1), (None, 1, 0), (4, None, 0)], "doc_id long, quality int, toxic int")
    got = Q.classify(docs(spark, rows, ["quality_score", "y", "x"]), labels).collect()
    assert len(got) == len(rows) and all(0 <= r.quality_score <= 1 for r in got)
    none = Q.classify(docs(spark, rows), labels.filter("false")).collect()
    assert {r.quality_score for r in none} == {0.5}
    assert Q.classify(docs(spark, []), labels).count() == 0
    assert len(Q.statistics("Ab 1!")) == len(Q.STATISTICS)
    assert not docs(spark, [(None, "x")]).select(Q.held_out(F.col("doc_id"))).first()[0]


def test_quality_ignores_held_out_labels(spark):
    d, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = Q.train(d, labels), Q.train(d, turned)
    assert np.array_equal(a.feature, b.feature) and np.array_equal(a.value, b.value)


# --- decontamination ----------------------------------------------------------------

def contamination_cases():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)] + ["Été", "ß9"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(1, text(30)), (2, text(13)), (3, "Only Four short-words"), (3, "Only Four short-words"), (4, None), (5, "..."), (None, text(14)),
             (10, "x1 " * 20), (11, text(12))]
    rows = [(i, text(200)) for i in range(4)]
    rows += [(10, text(20) + " " + items[0][1].upper() + "! " + text(5)), (11, items[1][1].replace(" ", ", ")), (12, "only four SHORT words"),
             (13, None), (14, ""), (15, "?!"), (16, "x1 " * 60), (17, items[6][1]), (18, text(4000) + items[0][1]), (None, items[1][1]),
             (11, items[1][1].replace(" ", ", ")), (19, items[0][1] + " " + items[1][1])]
    return items, rows


def check_hits(got, rows, items):
    assert len(got) == len(rows)
    key = lambda v: tuple((x is not None, x) for x in v)
    want = []
    for doc_id, text in rows:
        n, hit, ids = brute_hits(text, items)
        sha = hashlib.sha256(",".join(sorted(map(str, ids))).encode()).hexdigest()
        want.append((doc_id, n, hit, len(ids), sha, hit > 0 and 20 * hit >= n))
    assert sorted(got, key=key) == sorted(want, key=key)


def test_decontamination_brute_force(spark, monkeypatch):
    items, rows = contamination_cases()
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("n_words", F.lit(1))
    frame = docs(spark, rows, ["contamination", "n_hit"])
    for block in (D.BLOCK_WORDS, 100):
        monkeypatch.setattr(D.window_blocks, "__defaults__", (D.WINDOW, block))
        got = D.decontaminate(frame, bench).select("doc_id", "contamination.n_words", "contamination.n_hit", "contamination.n_items",
                                                   "contamination.items_sha256", "contamination.contaminated").collect()
        check_hits([tuple(r) for r in got], rows, items)
    assert D.decontaminate(docs(spark, []), bench).count() == 0
    none = D.decontaminate(frame, bench.filter("false")).select("contamination.*").collect()
    assert {r.n_hit for r in none} == {0} and not any(r.contaminated for r in none)


def test_decontamination_spans_point_into_the_original(spark):
    passage = " ".join(f"k{i}" for i in range(13))
    text = "Éx; " + passage.upper().replace(" ", " -- ") + " tail"
    (row,) = D.judge_all([text], 1, lambda i: D.automaton(D.window_blocks([(1, passage)])[0]))
    (span,) = row[-1]
    assert text[span["start"]:span["end"]].lower().replace(" -- ", " ") == passage


# --- HTML ---------------------------------------------------------------------------

@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain", "plain"), ("a &lt; b&nbsp;c &copy;", "a < b c ©"),
    ("<p>one<p>two", "one\n\ntwo"), ("<div>a</div><div>b</div>c", "a\nb\nc"), ("a<br>b<br/>c", "a\nb\nc"),
    ("<ul><li>a<li>b</ul>", "- a\n- b"), ("<ol start=4><li>a</li><li value=9>b<li>c</ol>", "4. a\n9. b\n10. c"),
    ("<ul><li>a<ul><li>b</ul><li>c</ul>", "- a\n  - b\n- c"),
    ("<head><title>t</title><script>if (a<b) '</p>'</script></head><body>x", "x"),
    ("<p hidden>no<p style='DISPLAY : none'>no<p>yes", "yes"), ("<div style='visibility:hidden'>no</div><template>no</template>ok", "ok"),
    ("<!-- c --><!doctype html><?x y>t<!-- open", "t"), ("a<b c", "a<b c"), ("1 < 2 > 0", "1 < 2 > 0"), ("</p>x</div></span>", "x"),
    ("<b>bo</b>ld and <i> spaced </i>out", "bold and spaced out"),
    ("<pre>a  b\n  c</pre>", "a  b\n  c"), ("<details><summary>s</summary>gone</details><details open>seen</details>", "s\nseen"),
    ("<table><tr><th>Name<th>N<tr><td>long name<td>1</table>", "Name       N\nlong name  1"),
    ("<table><tr><td colspan=2>wide<td>c<tr><td>a<td>b<td>d</table>", "wide     c\na     b  d"),
    ("<table><tr><td rowspan=2>x<td>a<tr><td>b</table>", "x  a\n   b"), ("<table><caption>cap</caption><tr><td>a<br>b<td>c</table>", "cap\na  c\nb"),
    ("<dl><dt>t<dd>d<dt>u</dl>", "t\n  d\nu"), ("<h1>a</h1>b<hr>c", "a\n\nb\n\nc"), ("<li>loose", "- loose"),
    ("<input type=hidden value=x><textarea><b>raw</textarea>", "<b>raw"), ("<body hidden>x</body>", ""), ("<p>a</p>" * 2, "a\n\na"),
    ('<div style="visibility:hidden">no<span style="visibility:visible">yes</span><b>no</b></div>', "yes"),
    ("<body style='visibility:collapse'>no<p style='visibility:initial'>y<i style='visibility:inherit'>es</i></body>", "yes"),
    ("<html hidden><body>no", ""), ("<html style='display:none'><body style='display:block'>no", ""),
    ("<p style='display:none;display:block'>y<p style='display:none!important;display:block'>no", "y"),
    ("""<p style='background:url("a;display:none;")'>y""", "y"),
    ("a<select><option>no<option selected>x &amp;amp; y<option>no</select>b", "a x &amp; y b"), ("<select></select>a", "a"),
    ("<select><option disabled>no<optgroup disabled label=no><option>no</optgroup><option>yes</select>", "yes"),
    ("<select multiple><optgroup label='G &lt; H'><option>x<option label=L>no<option hidden>no</select>", "G < H\nx\nL"),
    ("<select size=3><option>x<option>y</select>", "x\ny"), ("<datalist><option>no</datalist>a", "a"),
    ("a<input type=submit value='Go on'>b<input type=Password value=no><input type=checkbox value=no><input value=t>", "a Go on b t"),
])
def test_html_cases(page, text):
    assert H.page_text(page) == text


@pytest.mark.parametrize("style, seen", [
    ("backface-visibility: hidden", True), ("-webkit-backface-visibility:hidden", True), ("color:red; backface-visibility : hidden;", True),
    ("--display: none", True), ("visibility: hidden", False), ("color:red;VISIBILITY:collapse", False), (" display : none !important", False),
    ("backface-visibility:hidden;display:none", False), ("/* a */ display:/* b */none", False), ("color:red;;\nvisibility:hidden;", False),
])
def test_html_hides_by_whole_property_names(style, seen):
    assert H.page_text(f'<p>a</p><div style="{style}"><p>b</p></div>') == ("a\n\nb" if seen else "a")
    assert H.page_text(f'<body style="{style}">b</body>') == ("b" if seen else "")
    assert H.page_text(f'<html style="{style}"><body>b</body></html>') == ("b" if seen else "")


def test_html_hostile_pages_end():
    for page in ("<div>" * 20000 + "x", "<a " * 20000, "<table><tr><td>" * 60 + "x", "<ul><li>" * 3000 + "x", "<p><b>" * 5000 + "x",
                 "<td rowspan=99999 colspan=9999>a", "<script>" + "x" * 100000, '<a href="' * 3000 + ">x"):
        assert isinstance(H.page_text(page), str)


def test_html_keeps_every_visible_word(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet").withColumn("text", F.lit("clash"))
    got = H.extract_text(pages).select("page_id", "html", "text").toPandas()
    assert len(got) == pages.count()
    for page, text in zip(got["html"], got["text"]):
        body = re.sub(r"(?is)<head.*?</head>|<script.*?</script>|<style.*?</style>|<!--.*?-->", " ", page or "")
        words = H.html.unescape(re.sub(r"<[^>]*>", " ", body)).split()
        seen = set(re.findall(r"\w+", text))
        assert set(re.findall(r"\w+", " ".join(words))) <= seen | {""}


def test_html_emits_no_hidden_word(spark):
    """Every page with passages that a browser hides put in between its words: the text stays as it was."""
    pages = [r.html for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect() if r.html]
    hidden = ["<i hidden>zqx</i>", "<i style='display : none'>zqx<b style='visibility:visible'>zqx</b></i>", "<script>zqx</script>",
              "<i style='visibility:hidden'>zqx<u>zqx</u></i>", "<template><i>zqx</i></template>", "<!-- zqx -->", "<input type=hidden value=zqx>"]
    changed = 0
    for n, page in enumerate(pages):
        raw = [m.span() for m in re.finditer(r"(?is)<(script|style|textarea|title)\b.*?</\1|<!--.*?-->", page)]
        at = [m.end() for m in re.finditer(r"</?(?:p|div|li|b|i|a|span)>", page) if not any(a < m.end() <= b for a, b in raw)]
        body = page
        for k, i in enumerate(reversed(at)):
            body = body[:i] + hidden[(n + k) % len(hidden)] + body[i:]
        changed += body != page
        assert H.page_text(body) == H.page_text(page)
    assert changed > len(pages) / 2


def test_html_nulls_and_empty_table(spark):
    df = spark.createDataFrame([(1, None), (None, "<p>x"), (1, None)], "page_id long, html string")
    assert sorted(r.text for r in H.extract_text(df).collect()) == ["", "", "x"]
    assert H.extract_text(df.filter("false")).count() == 0
    assert isinstance(H.rendered.func(pd.Series([], dtype=object)), pd.Series)
