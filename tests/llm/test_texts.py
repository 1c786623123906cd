import hashlib
import pickle
import random

import pytest
from plain import RUN, WORD, base_counts, cleaned_lines, hits, windows
from pyspark.sql import functions as F

from clickloom.llm import decontaminate, html_extract, line_dedup, quality_rules
from clickloom.llm.batches import written
from clickloom.llm.decontaminate import hit_report, with_hits, without_passages
from clickloom.llm.html_extract import INSIDE, OUTSIDE, UNDECIDED, extract_pages, page_blocks
from clickloom.llm.line_dedup import with_line_spread, without_spread_lines
from clickloom.llm.quality_rules import quality_filter, with_quality

SHARED = "Nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen"


# ---- benchmark passages


@pytest.mark.parametrize(("bound", "blocks"), [("BLOCK_BYTES", 1), ("BLOCK_BYTES", 3), ("BLOCK_WORDS", 20)])
def test_hits_match_a_plain_search(table, monkeypatch, bound, blocks):
    docs, bench = table("documents").select("doc_id", "text"), table("benchmark")
    texts = [r.text or "" for r in bench.collect()]
    size = sum(len(t.encode()) if bound == "BLOCK_BYTES" else len(WORD.findall(t.lower())) for t in texts)
    monkeypatch.setattr(decontaminate, bound, -(-size // blocks))
    found = windows([(r.item_id, r.text) for r in bench.collect()])
    report = {r.doc_id: r for r in hit_report(with_hits(docs, bench, keep=["doc_id"])).collect()}
    n = 0
    for r in docs.collect():
        w, hit, items = hits(r.text, found)
        sha = hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert tuple(report[r.doc_id]) == (r.doc_id, len(w), len(hit), len(items), sha, bool(hit))
        n += bool(hit)
    assert n > 0


def test_a_set_of_windows_is_a_few_times_its_text():
    rng = random.Random(4)
    names = [f"word{n}" for n in range(60_000)]
    items = [(str(n), " ".join(rng.choices(names, k=200))) for n in range(8_500)]
    size = sum(len(t) for _, t in items)
    assert 15 << 20 < size < 17 << 20
    assert len(pickle.dumps(decontaminate.Windows(items, 10))) < 100 << 20


def test_windows_in_long_and_odd_texts():
    rng = random.Random(6)
    words = ["a", "B", "zz", "x" * 30, "é", "日本", "0"]
    items = [(f"i{n % 30}", "-".join(rng.choices(words, k=rng.randint(0, 13)))) for n in range(40)]
    items += [("repeats", "b " * 60), ("twin", "b " * 60), ("long", "y" * (1 << 21))]
    texts = ["", "...", " ".join(rng.choices(words, k=20_000)), "y" * (1 << 21), "b " * 500, "A", items[5][1]]
    texts += [("," * (1 << 20))[:-3] + " ".join(rng.choices(words, k=300)), "x" * 29 + " " + "y" * (1 << 20)]
    book, found = decontaminate.Windows(items, 10), windows(items)
    all_words = decontaminate.Words([t.encode() for t in texts])
    got = {}
    for at, size, names in book.find(all_words):
        doc = int(all_words.text[at])
        first = int((all_words.text < doc).sum())
        hit, seen = got.setdefault(doc, (set(), set()))
        hit.update(range(at - first, at - first + size))
        seen.update(names)
    for doc, text in enumerate(texts):
        w, hit, names = hits(text, found)
        assert int((all_words.text == doc).sum()) == len(w)
        assert got.get(doc, (set(), set())) == (set(hit), set(names))
    assert len(got) >= 4


def test_passages_are_cut_out(spark, make_docs):
    bench = spark.createDataFrame(
        [(1, SHARED), (2, "Short item"), (3, None), (None, "no id at all"), (4, "!!"), (1, SHARED)],
        "item_id long, text string",
    )
    rows = [
        (1, f"Before, {SHARED.upper()}! After."), (2, SHARED), (3, None), (4, ""), (5, "a SHORT-item b"),
        (6, "clean"), (6, "clean"), (None, "no id at all"), (7, "Nine ten eleven twelve"),
    ]
    docs = make_docs(rows)
    left = without_passages(docs, bench)
    assert left.columns == docs.columns
    kept = {r.doc_id: r.text for r in left.collect()}
    assert kept == {
        1: "Before, ! After.", 3: None, 4: "", 5: "a  b", 6: "clean", None: "no id at all",
        7: "Nine ten eleven twelve",
    }
    assert left.where("doc_id = 6").count() == 2
    assert without_passages(docs, bench.limit(0)).count() == len(rows)
    assert without_passages(docs.limit(0), bench).count() == 0


# ---- lines


def test_line_spread_matches_a_plain_count(table):
    docs = table("documents")
    rows = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    found = {r.doc_id: r for r in with_line_spread(docs).collect()}
    for (doc_id, *_), want in zip(rows, cleaned_lines(rows)):
        r = found[doc_id]
        assert (r._lines.n_lines, r._lines.n_removed, r.text) == want
    assert any(r._lines.n_removed for r in found.values())


def test_line_spread_edges(spark):
    line, other = "one and the same line", "only on four sites"
    rows = [(i, f"{line}\nown line number {i}\nWh.", f"s{i}") for i in range(1, 7)]
    rows += [(i, other, f"s{i}") for i in range(10, 14)] + [(20, f" one  and the\tsame line ", "s1")]
    rows += [(30, None, "s1"), (31, "", None), (6, rows[5][1], "s6"), (None, line, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = with_line_spread(docs.withColumn("doc", F.lit(1)), spread="_n")
    want = sorted(str((d, *w)) for (d, *_), w in zip(rows, cleaned_lines(rows)))
    assert sorted(str((r.doc_id, *r._n, r.text)) for r in found.collect()) == want
    kept = without_spread_lines(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 10, 11, 12, 13, 30, 31}
    assert with_line_spread(docs.limit(0)).count() == 0


def test_a_column_of_the_result_s_name_is_an_error(make_docs):
    docs = make_docs([(1, "some text")], source="s", lang="en")
    with pytest.raises(ValueError, match="_lines"):
        with_line_spread(docs)
    with pytest.raises(ValueError, match="_quality"):
        with_quality(docs)
    assert with_quality(docs, keep=["doc_id"]).count() == 1


def test_words_of_lines_are_counted_after_cleaning(spark):
    lines = ["", "a", "a b", "\ta  b \x0b c", " a b c d ", "a\rb c d e", "é ü ö"]
    docs = spark.createDataFrame([(1, "\n".join(lines), "s"), (2, None, "s")], "doc_id long, text string, source string")
    for n in range(1, 6):
        rows = line_dedup._line_rows(docs, "source", n)
        assert sorted(r["place"] for r in rows.collect()) == [i for i, x in enumerate(lines) if len(x.split()) >= n]
    tidy = docs.select("doc_id", F.lit("a b c d\na b c").alias("text"), "source")
    same = line_dedup._line_rows(tidy, "source", 3).select("h1", "h2").distinct().collect()
    messy = docs.select("doc_id", F.lit("a  b c\td \n\x0ca b   c\r").alias("text"), "source")
    assert {tuple(r) for r in same} == {tuple(r) for r in line_dedup._line_rows(messy, "source", 3).select("h1", "h2").collect()}


def test_lines_on_many_sites_are_decided_by_sketches(spark):
    rows = [(i, "a line on many sites", f"s{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert [r.doc_id for r in without_spread_lines(docs).collect()] == [0]


# ---- quality rules


def test_base_rules_match_a_plain_count(table):
    docs = table("documents")
    found = {r.doc_id: r._quality for r in with_quality(docs).collect()}
    for r in docs.collect():
        assert tuple(found[r.doc_id])[:6] == base_counts(r.text)
        assert not (found[r.doc_id].base_failed and found[r.doc_id].kept)
    quality = {r.doc_id: r.quality for r in table("labels").where("quality = 1").collect()}
    clean = [found[d] for d in quality if not found[d].base_failed]
    assert sum(q.kept for q in clean) >= 0.99 * len(clean)


def test_quality_rules_judge_by_language(spark):
    good = " ".join(f"the word{i} of item{i} in place{i} and" for i in range(40))
    shout = " ".join(f"WORD{i}!! %%%" for i in range(200))
    rows = [(i, f"{good} {i}", "en") for i in range(20)] + [(50, shout, "en"), (51, None, "en")]
    rows += [(52, "", None), (53, "too short", "en"), (54, "same thing again " * 60, "en"), (55, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    docs = docs.withColumns({"_quality": F.lit(1), "words": F.lit(2), "doc": F.lit(3)})
    kept = quality_filter(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {*range(20), 55}
    assert quality_filter(docs.limit(0)).count() == 0


def test_distance_of_histograms(spark):
    row = spark.range(1).select(
        *[
            quality_rules._distance(
                F.array(*map(F.lit, a)), F.lit(sum(a)), F.array(*map(F.lit, b)), F.lit(sum(b))
            )
            for a, b in (([1, 3], [2, 6]), ([1, 0], [0, 1]), ([1, 1], [1, 0]))
        ]
    ).head()
    assert row[0] == 0 and row[1] == pytest.approx(1) and row[2] == pytest.approx(0.5579, abs=1e-3)


# ---- pages


def zones(html):
    return page_blocks(html)


def test_blocks_of_a_page():
    page = """<!DOCTYPE html><html><head><title>t</title><script>var t="</p><article>";</script></head>
    <body><nav><ul><li>menu<li>more</ul></nav><!-- <p>no</p> --><div class="side-bar ad">buy</div>
    <article><h1>A &amp; B&nbsp;&lt;c&gt;</h1><p><b>x  <i>y</i>z.<br><p>second<form>f</form>
    <div id="comments">c</div><p hidden>h</p></article><p>open<footer>&copy; f</footer>"""
    found = zones(page)
    assert [t for z, t in found if z == INSIDE] == ["A & B <c>", "x yz.", "second"]
    assert [t for z, t in found if z == UNDECIDED] == ["open"]
    assert {t for z, t in found if z == OUTSIDE} == {"menu", "more", "buy", "f", "c", "h", "© f"}


@pytest.mark.parametrize("html", [None, "", "   ", "<", "<p", "</p>", "<a href='", "&", "<!--", "<script>"])
def test_broken_pages_do_not_fail(html):
    assert all(t for _, t in zones(html))


@pytest.mark.parametrize(
    ("html", "inside"),
    [
        ("<div class='content-sidebar-wrap'>a<article>b</article>c</div>", ["b"]),
        ("<div class='has-sidebar'><nav>n</nav><main>b<div class='ad'>x</div></main></div>", ["b"]),
        ("<form id='aspnet'>a<div><article>b<form>f</form></article></div></form>", ["b"]),
        ("<div class='page header'><div role='main'>b</div></div>", ["b"]),
        ("<div class='comments'><div class='comment-list'><article>c</article></div></div>", []),
        ("<article>b<div class='comment-list'><article>c</article></div></article>", ["b"]),
        ("<form hidden><article>c</article></form><aside><main>c</main></aside>", []),
    ],
)
def test_content_inside_a_wrapper_with_a_chrome_name(html, inside):
    found = zones(html)
    assert [t for z, t in found if z == INSIDE] == inside
    assert all(z in (INSIDE, OUTSIDE) for z, _ in found)


def test_pages_by_structure(table):
    pages = table("pages")
    found = {r.page_id: r for r in extract_pages(pages).collect()}
    for r in pages.collect():
        want = "\n".join(t for z, t in page_blocks(r.html) if z == INSIDE)
        assert (found[r.page_id].text, found[r.page_id].n_chars) == (want, len(want)) and want


@pytest.mark.parametrize("attributes", [
    'style="overflow:hidden"', 'title="the hidden gem"', 'data-id="nav"', "data-class='menu'",
    "title='class=ad'", 'aria-label="hidden"', "data-hidden", 'alt="id = nav"', 'style="x" lang=en',
])
def test_only_an_attribute_s_own_name_counts(attributes):
    page = f"<article><div {attributes}><p>Hello <b {attributes}>world</b></p></div></article>"
    assert page_blocks(page) == [(INSIDE, "Hello world")]


@pytest.mark.parametrize("attributes", [
    "hidden", 'class="x ad"', "CLASS=ad", 'id = "nav"', "data-x='1' hidden", 'aria-hidden="true"',
    'title="a" role="search"', "class='y'id='nav'",
])
def test_attributes_that_put_a_block_outside(attributes):
    page = f"<article><p>Hello</p><div {attributes}>gone</div></article>"
    assert page_blocks(page) == [(INSIDE, "Hello"), (OUTSIDE, "gone")]


def test_repeated_runs_of_a_host_go(spark):
    boiler = "subscribe now to get all of our news by mail every day"
    page = lambda i: f"<div>{boiler}</div><div>{i}th story of the host</div>"
    rows = [(i, f"http://a.example/{i}", page(i)) for i in range(5)]
    rows += [(10, "http://b.example/1", page(10)), (11, None, None), (12, "::[", "")]
    rows += [(13, "http://a.example/x", f"<article><p>{boiler}</p></article>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r.page_id: r.text for r in extract_pages(pages.withColumn("text", F.lit(1))).collect()}
    assert [found[i] for i in range(5)] == [f"{i}th story of the host" for i in range(5)]
    assert found[10] == f"{boiler}\n10th story of the host"
    assert found[11] == found[12] == "" and found[13] == boiler
    assert extract_pages(pages.limit(0)).count() == 0


def test_host_runs_are_found_where_structure_decides_all(spark, monkeypatch):
    menu = "home news sport weather travel food music film books contact"
    page = lambda i, m: f"<nav>{m}</nav><article><p>Story {i}</p></article>"
    rows = [(i, f"http://a.example/{i}", page(i, menu)) for i in range(4)]
    rows += [(i, f"http://b.example/{i}", page(i, menu)) for i in (10, 11)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    kept = {}

    def keep(df, purpose, **options):
        kept[purpose] = written(df, purpose, **options)
        return kept[purpose]

    monkeypatch.setattr(html_extract, "written", keep)
    found = {r.page_id: r.text for r in extract_pages(pages).collect()}
    assert found == {i: f"Story {i}" for i in [0, 1, 2, 3, 10, 11]}
    marked = kept["page-marks"].join(kept["page-blocks"], "row")
    assert {r.page_id: sorted(r.starts) for r in marked.collect()} == {i: [0, 1, 2, 3] for i in range(4)}
    assert [r.n_pages for r in kept["page-runs"].collect()] == [4] * 4


def test_words_of_rules():
    assert RUN.findall("a b \x1cc") == ["a b", "\x1cc"]
