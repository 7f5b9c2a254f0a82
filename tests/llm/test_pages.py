"""URL rules, WARC archives and main text."""

import base64
import gzip
import hashlib
import io
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import extract, queries, url_filter, warc

SF = "/root/testdata/sf0.001"


def _match(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:cut].translate({c: c + 32 for c in range(65, 91)})
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=None)
    return host, path, best[2] if best else None, best[3] if best else "allow"


def test_urls_match_rule_by_rule(spark):
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"), ("a.org", "", "block"),
             ("org", "/fr/x", "block"), ("org", "/fr/xy", "allow"), ("b.a.org", "/f", "allow")]
    urls = [f"{s}{h}{p}" for s in ("http://", "x://") for h in ("net", "Example.NET", "www.example.net", "xnet", "example.com", "org", "a.org", "b.a.org", "c.b.a.org", "orgy", "")
            for p in ("", "/", "/en/", "/en", "/fr/", "/fr/x", "/fr/xyz", "/fr/y?q=/fr/x", "#/en/", "?u=http://net/", "/de/\u00e9\uffff")]
    urls += [None, "", "net/", "no scheme", "http:/net/", "://net/x", "a://b://net/", "http://net/\n/x"] + ["http://hot.net/same"] * 50
    rows = list(enumerate(urls))
    df = spark.createDataFrame(rows, "page_id long, url string").withColumn("host", F.lit("old")).withColumn("rule", F.lit(0))
    got = url_filter.match_urls(df, url_filter.rule_table(spark, rules)).collect()
    assert sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got) == [(i, *_match(u, rules)) for i, u in rows]


def test_urls_edge_tables(spark):
    rules = url_filter.rule_table(spark, [("net", "/", "block")])
    assert url_filter.match_urls(spark.createDataFrame([], "page_id long, url string"), rules).count() == 0
    one = spark.createDataFrame([(None, "http://net/")], "page_id long, url string")
    assert url_filter.match_urls(one, rules).first()["verdict"] == "block"
    assert url_filter.match_urls(one, rules.limit(0)).first()["verdict"] == "allow"
    twice = rules.union(url_filter.rule_table(spark, [("net", "/", "allow")]))
    assert url_filter.match_urls(one, twice).first()["verdict"] == "block"


@pytest.mark.parametrize("name", ["op2_url_filters", "op4_exact_top_k"])
def test_queries_equal_their_sql(spark, name):
    db = duckdb.connect()
    for t in ("pages", "embeddings"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = queries.QUERIES[name](spark, SF)
    want = db.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in df.collect())


PAGES = [(5, "http://a/", "<p>same</p>"), (3, "http://b/\r\nX: y", "<p>same</p>"), (9, None, "<p>same</p>"), (4, "http://é/", "other \u00e9 \r\n\r\n WARC/1.1"),
         (6, "u", None), (7, "u", ""), (None, "n", "<p>same</p>"), (3, "http://b/", "<p>same</p>"), (11, "big", "z" * 3_000_000)]


def _archives(spark, pages, folder, **options):
    written = warc.write_archives(pages, f"{folder}/raw", **options)
    index = warc.normalise(written, f"{folder}/members")
    return written, index, warc.read_records(index, str(folder))


def test_archives_round_trip(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("sha", F.lit(1)).withColumn("first", F.lit("f"))
    written, index, records = _archives(spark, df, tmp_path)
    got = records.collect()
    digest = lambda h: base64.b32encode(hashlib.sha1((h or "").encode()).digest()).decode()
    want = []
    for i, _, h in PAGES:
        least = min((j for j, _, g in PAGES if (g or "") == (h or "") and j is not None), default=None)
        refers = None if i is None or i == least else least
        want.append((i or -1, len((h or "").encode()), digest(h), "response" if refers is None else "revisit", refers or -1))
    assert sorted((r["page_id"] or -1, r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"] or -1) for r in got) == sorted(want)
    assert {(r["page_id"], bytes(r["payload"]).decode()) for r in got if r["record_type"] == "response" and r["page_id"]} == {(3, "<p>same</p>"), (4, PAGES[3][2]), (6, ""), (11, PAGES[8][2])}
    # every member alone, and the old file as a whole, hold the same records
    for path in {r["path"] for r in index.collect()}:
        data = open(path, "rb").read()
        parts = [gzip.decompress(data[r["offset"] : r["offset"] + r["length"]]) for r in index.where(F.col("path") == path).collect()]
        assert all(p.startswith(b"WARC/1.1\r\n") and p.endswith(b"\r\n\r\n") for p in parts)
        assert sorted(parts) == sorted(warc.split_records([gzip.decompress(data)]))
    whole = [r for m in written.collect() for r in warc.split_records([gzip.decompress(open(m["path"], "rb").read())])]
    assert len(whole) == len(PAGES)


def test_archives_without_small_revisits_and_empty(spark, tmp_path):
    df = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    _, _, records = _archives(spark, df, tmp_path / "a", least=12)
    assert {r["record_type"] for r in records.collect()} == {"response"}
    _, index, records = _archives(spark, df.limit(0), tmp_path / "b")
    assert index.count() == records.count() == 0


def test_streams_are_split_at_any_chunk_size():
    records = [warc.record(i, "u", b"x" * i + b"\r\n\r\n", "D", None) for i in range(9)]
    data = gzip.compress(b"".join(records[:4])) + gzip.compress(b"".join(records[4:]))  # members hold several records
    for chunk in (1, 7, 1 << 20):
        assert list(warc.split_records(warc.inflated(io.BytesIO(data), chunk))) == records
    with pytest.raises(ValueError):
        list(warc.split_records([records[0][:-3]]))


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/x">Menu one</a></li></ul></nav><div class="cookie-notice"><p>We use cookies on this site</p></div>
%s<h1>Head&shy;line</h1><p><b>First &lt;b&gt; para<br>graph<p>Second&nbsp;  para<!-- hidden <p>note</p> -->
 goes   on</p><aside>Aside words stand here</aside><div class="ad">Buy this now</div><form><label>Name</label><input></form>
<ul><li>item one</li><li>item two</li></ul><p>Some &#233;nd &copy; words with <a href="q">a link</a> in them.</p>%s
<section id="comments"><p>Reader says this is great and long</p></section><footer>&copy; me</footer><script>track()</script>"""
TEXT = ["Head\u00adline", "First <b> para graph", "Second para goes on", "item one", "item two", "Some \u00e9nd \u00a9 words with a link in them."]


def test_main_text_of_marked_and_unmarked_pages(spark):
    pages = [(1, PAGE % ("<article>", "</article>")), (2, PAGE % ("<main>", "</main>")), (3, PAGE % ("<div>", "</div>")), (4, PAGE % ("<div class='content'>", ""))]
    many = [(100 + i, PAGE % ("<article>", "</article>")) for i in range(30)]
    df = spark.createDataFrame(pages + many, "page_id long, html string").withColumn("text", F.lit("old"))
    got = {r["page_id"]: r["_text"] for r in extract.main_text(df).collect()}
    for i, _ in pages:
        assert got[i] == "\n\n".join(TEXT), i


def test_best_stretch_matches_all_stretches():
    r = random.Random(4)
    for n in [0, 1, 2, 3, *range(4, 60)]:
        scores = [r.choice([-2, -1, -0.5, 0, 0.5, 1, 3]) for _ in range(n)]
        start, end = extract.best_stretch(scores)
        best = max([sum(scores[a:b]) for a in range(n) for b in range(a + 1, n + 1)], default=0)
        assert sum(scores[start:end]) == max(best, 0)
        assert (start, end) == (0, 0) or (start == 0 or sum(scores[start:end]) > 0)


def test_parts_are_named_by_whole_classes_only(spark):
    """A class that only holds a part's name is judged by where the labelled pages have it."""
    body = "".join(f"<p>The body goes on in paragraph {i} with words of its own</p>" for i in range(4))
    text = [f"The body goes on in paragraph {i} with words of its own" for i in range(4)]
    names = ['section id="social-science"', 'section class="market-share"', 'div class="x related-work y"']
    pages = [f"<body><nav>menu</nav><article><h1>A title of several words</h1><{n}>{body}</{n.split()[0]}><div class='ad-slot'>buy</div></article></body>" for n in names]
    # a name that stands outside the articles of labelled pages, in one that is not labelled
    pages.append(f"<body><div>{body}<div class='promo-teaser'>Read some more of it</div>{body}</div></body>")
    many = [(100 + i, f"<body><article>{body}</article><div class='promo-teaser'><p>Read more of it elsewhere</p></div></body>") for i in range(20)]
    df = spark.createDataFrame(list(enumerate(pages)) + many, "page_id long, html string")
    got = {r["page_id"]: r["_text"] for r in extract.main_text(df).collect()}
    for i in range(3):
        assert got[i] == "\n\n".join(["A title of several words", *text]), i
    assert got[3] == "\n\n".join(text + text)
    assert all(got[100 + i] == "\n\n".join(text) for i in range(20))


def test_main_text_beside_articles_of_others(spark):
    notes = "".join(f"<article><p>Reader {i} thinks this is rather good</p></article>" for i in range(3))
    comments, aside = f'<section id="comments">{notes}</section>', f"<aside>{notes}</aside>"
    teaser = '<article class="teaser promo"><h2>More</h2><p>Short words of another page</p></article>'
    body = "".join(f"<p>The body goes on in paragraph {i} with words of its own</p>" for i in range(8))
    text = "\n\n".join(f"The body goes on in paragraph {i} with words of its own" for i in range(8))
    pages = [f"<body><div>{body}</div>{comments}</body>", f"<body>{aside}<div>{body}</div>{teaser}</body>", f"<body><article>{body}</article>{comments}</body>",
             f"<body>{teaser}<main class='no-sidebar'><article class='post share'>{body}{teaser}{aside}</article>{comments}</main></body>",
             f"<body><h2>Site</h2><div class='widget'><article>{body}</article>{comments}</div></body>", f"<body><div>{body}</div><div>{notes}</div></body>"]
    many = [(100 + i, PAGE % ("<article>", "</article>")) for i in range(30)]
    df = spark.createDataFrame(list(enumerate(pages)) + many, "page_id long, html string")
    got = {r["page_id"]: r["_text"] for r in extract.main_text(df).collect()}
    for i in range(4):
        assert got[i] == text, i
    assert text in got[4] and "Reader" not in got[4] and text in got[5]


def test_main_text_edge_rows(spark):
    schema = "page_id long, html string"
    assert extract.main_text(spark.createDataFrame([], schema)).count() == 0
    rows = [(1, None), (2, ""), (3, "<p>"), (4, "just words here"), (None, "<p>a<p>b"), (6, "<<a <b>x</b> < 3 <!-- open"), (7, "<nav>only menu</nav>"), (8, "<article></article><p>words</p>"),
            (9, "<p>" + "long words " * 300_000 + "</p>"), (4, "just words here")]
    got = extract.main_text(spark.createDataFrame(rows, schema)).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["_text"] for r in got}
    assert text[1] == text[2] == text[3] == text[7] == "" and text[4] == "just words here" and text[None] == "a\n\nb"
    assert len(text[9]) == 300_000 * 11 - 1


def test_main_text_of_the_table(spark):
    got = queries.op9_html_extraction(spark, SF).collect()
    assert got and all(r["n_chars"] == len(r["text"]) and "<" not in r["text"] for r in got)
