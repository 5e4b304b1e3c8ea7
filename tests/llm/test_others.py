"""Vectors, pages, archives, the queries with SQL, and the pipeline."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lakestar.llm import html, topk, warc
from lakestar.llm.queries import QUERIES, SQL
from tests.conftest import rows
from tests.oracle import _rows, connect

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", ["op1_exact_top_k", "op3_warc_chunks", "op4_decontamination", "op7_substring_dedup"])
def test_same_rows_as_sql(spark, name):
    df, con = QUERIES[name](spark, FOLDER), connect(FOLDER)
    cursor = con.execute(SQL[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(df.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(columns, cursor.fetchall())


def top_brute(vectors, k):
    found = []
    for q, v in vectors:
        if q is not None and q % 5 == 0 and v is not None:
            scored = [(-sum(x * y for x, y in zip(v, w)), i) for i, w in vectors if i not in (None, q) and w is not None and len(w) == len(v)]
            found += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(found, key=repr)


@pytest.mark.parametrize("spread", [0, 6])
def test_top_k(spark, monkeypatch, spread):
    monkeypatch.setattr(topk, "BLOCK", 32)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 16)
    rng = random.Random(5)
    vectors = [(i, [int(rng.gauss(0, 1) * 50 * 2 ** rng.uniform(0, spread)) for _ in range(8)]) for i in range(300)]
    vectors += [(1000 + i, [7] * 8) for i in range(100)] + [(2000, [0] * 8), (2001, None), (None, [1] * 8), (2005, [3, 4]), (2006, [1, 1]), (2010, [])]
    df = spark.createDataFrame(vectors, "vec_id long, v array<long>").withColumn("dim", F.lit(1)).repartition(3)
    assert rows(topk.top_k(df, F.col("vec_id") % 5 == 0, 4)) == top_brute(vectors, 4)


def test_top_k_of_nothing_and_of_bad_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, v array<long>")
    assert topk.top_k(empty, F.col("vec_id") % 5 == 0).count() == 0
    bad = spark.createDataFrame([([1.5, -0.1],), ([float("nan")],), ([float("inf")],), ([None],), (None,)], "e array<float>")
    assert [r[0] for r in bad.select(topk.as_integers(F.col("e"))).collect()] == [[384, -26], None, None, None, None]


def test_archive_round_trip(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "CHUNK", 64)
    rng = random.Random(3)
    line = warc.BOUNDARY.decode()
    data = [(1, ""), (2, None), (3, "\r\n"), (4, "\r\n\r\n"), (5, line), (6, line * 2 + "x" + line[:9]), (7, "é" * 500)]
    data += [(8, "a" * 1000), (9, "a" * 1000), (10, "a" * 99), (11, "a" * 99), (13, "z\r"), (13, "z\r"), (None, "q"), (None, "q"), (None, "a" * 1000)]
    data += [(14, "b" * 900), (14, "b" * 900), (15, "b" * 900), (15, "b" * 900)]
    parts = ["\r\n", "\r", "\n", "WARC/1.1", "x", "é", "\r\n\r\n", line, "WARC-Type: a"]
    data += [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 60)))) for i in range(100)]
    pages = spark.createDataFrame(data, "page_id long, html string").withColumn("origin", F.lit(1)).repartition(3)
    warc.write_warc(pages, f"{tmp_path}/w")
    got = rows(warc.check_warc(warc.read_warc(spark, f"{tmp_path}/w")))
    first = {}
    for i, t in sorted((r for r in data if r[0] is not None), key=lambda r: r[0]):
        first.setdefault((t or "").encode(), i)
    expected = []
    for i, t in data:
        b = (t or "").encode()
        again = i is not None and len(b) >= 100 and first[b] < i
        expected.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", first[b] if again else None))
    assert got == sorted(expected, key=repr)
    assert warc.read_warc(spark, f"{tmp_path}/w").where("chunk = 0").select("id", "origin", "copy").distinct().count() == len(data)
    chunks = warc.read_warc(spark, f"{tmp_path}/w")
    with pytest.raises(Exception, match="missing, doubled or damaged"):
        warc.check_warc(chunks.where("not (id = 7 and chunk = 1)")).collect()
    warc.write_warc(pages.where("false"), f"{tmp_path}/e")
    assert warc.check_warc(warc.read_warc(spark, f"{tmp_path}/e")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header>Site</header><nav><ul><li><a href="/">Home</a></li></ul></nav><!-- ad <p> --><div class="cookie-notice">Yum</div>
<article><h1>A &amp; B%d</h1><p>One <b>two</b>three<br>four&nbsp;&lt;<p>five  six%d<div class="ad">Buy</div><form>x</form>
<section id="comments"><p>First!</p></section></article><aside>side</aside><footer>&copy; us</footer></body></html>"""


def test_main_text(spark):
    data = [(i, "http://h.org/a", PAGE % (i, i)) for i in range(4)] + [(4, "http://h.org/b", None), (5, None, ""), (6, "x", "plain <b>te</b>xt &am")]
    data += [(7, "http://h.org/c", "<article>cut <p>off"), (8, "http://h.org", "<div class='x"), (8, "http://h.org", "<div class='x")]
    # Without an article: what the pages of a host share is no main text.
    data += [(20 + i, "https://n.org/", f"<html><body><div>Our motto</div><div>All rights</div><p>Story {i}</p></body></html>") for i in range(6)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("template", F.lit(1)).repartition(3)
    got = rows(html.extract(pages), "page_id", "text")
    expected = [(i, f"A & B{i} One twothree four < five six{i}") for i in range(4)]
    expected += [(4, ""), (5, ""), (6, "plain text &am"), (7, "cut off"), (8, "<div class='x"), (8, "<div class='x")]
    assert got == sorted(expected + [(20 + i, f"Story {i}") for i in range(6)], key=repr)
    assert html.extract(pages.where("false")).count() == 0


def test_pipeline_keeps_what_brute_force_keeps(spark, tmp_path):
    """The stages after toxicity on literal rows; toxicity itself is tested by held-out accuracy."""
    from tests.llm.conftest import passage

    item = passage(70, 30)
    data = [(1, passage(1, 80)), (2, passage(1, 80)), (3, passage(2, 50) + " " + item), (4, passage(3, 40) + " a@b.org"), (5, None), (None, "x")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in data], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, str(tmp_path))
        assert docs.columns == before.columns, name
    kept = {r.doc_id: r for r in docs.collect()}
    assert set(kept) == {1, 4, 5, None}
    assert kept[4].text.endswith(" [EMAIL]") and kept[4].n_chars == len(kept[4].text)
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in final} == set(kept)
    digest = {r.doc_id: r.decoded_sha256 for r in final}
    assert all(digest[i] == hashlib.sha256((r.text or "").encode()).hexdigest() for i, r in kept.items())


@pytest.mark.parametrize(
    "page",
    [
        "<div class='layout has-sidebar'><article>Whole <p>text</article></div>",
        "<div class='no-sidebar'>%s</div>" % "<main class='with-sidebar'>Whole <p>text</main>",
        "<div class='layout sidebar'><a href='#x'>Skip</a><article class='post has-comments widget'>Whole <p>text</article></div>",
        "<form id='form1'><div class='content search'><main><div class='widget'><article>Whole <p>text</article></div></main></div></form>",
        "<article><div class='entry-header'><h1>Whole</h1></div><div class='header'>text</div></article>",
        "<article>Whole <svg><path d=''/><p>text</article><footer>f</footer>",
        "<article>Whole <p>te<math><mi>x</mi></math>t<select><option>1</select></article><div class='site-footer'>f</div>",
        "<div>Whole text</div><aside><article>A teaser that is longer</article></aside>",
        "<article>Whole text</article><div class='related'><article>A teaser that is longer</article></div>",
        "<article>Whole text<div class='post-1 ad ad-1'>Buy</div><ul class='comment-list'><li>First</ul></article>",
    ],
)
def test_marks_do_not_hide_the_article(page):
    assert html.main_text(page, None) == "Whole text"


def test_copies_and_layouts_without_an_article(spark):
    box = "<html><body><div class='top'>Home %s</div><div>Menu %s</div><div>%s</div><div>All rights %s</div></body></html>"
    story = "<p>Copied one</p><p>Copied two</p><p>Copied three</p><p>Copied four</p>"
    # Four copies of one article among seven pages.
    data = [(i, "http://c.org/", box % ("c", "c", story, "c"), "Copied one Copied two Copied three Copied four") for i in range(4)]
    data += [(4 + i, "http://c.org/", box % ("c", "c", f"<p>Story {i}", "c"), f"Story {i}") for i in range(3)]
    # Three layouts of a third each, none of which says the same around its stories.
    for k in range(3):
        page = f"<html><body><div id='l{k}'>Home {k}<div>Menu {k}</div><p>%s</p><div>Rights {k}</div></div></body></html>"
        data += [(100 * k + 10 + i, "http://l.org/", page % f"Story {k} {i}", f"Story {k} {i}") for i in range(4)]
    pages = spark.createDataFrame([d[:3] for d in data], "page_id long, url string, html string").repartition(5)
    assert rows(html.extract(pages), "page_id", "text") == sorted(((d[0], d[3]) for d in data), key=repr)
