"""Pages that wrap their article, hostile markup, rows without ids, clashing names, terms that prove nothing."""

import time

import pytest

pytest.importorskip("riskloom.llm")

from riskloom.llm import decontaminate, html_extract, pii, quality_lines  # noqa: E402

ARTICLE = "<h1>Title</h1><p>First paragraph of the article, with words.</p><p>Second one, long enough too.</p>"
TEXT = "Title\nFirst paragraph of the article, with words.\nSecond one, long enough too."


def article(html):
    page = html_extract.PageText(html)
    return page.article([page.path(page.best())] if page.blocks else [])


@pytest.mark.parametrize(
    "html",
    [
        f"<form>{ARTICLE}</form>",
        f"<body><form><nav><a href=x>Home</a></nav><div>{ARTICLE}</div></form></body>",
        f'<div class="layout sidebar-right">{ARTICLE}</div>',
        f'<div class="page comments-open">{ARTICLE}</div>',
        f'<div class="nav-open"><div>{ARTICLE}</div></div>',
        f'<div class="has-sidebar">{ARTICLE}</div>',
        f'<div class="w-1/2"><div class="post">{ARTICLE}</div></div>',
        f'<div class="widget"><main>{ARTICLE}</main></div>',
        f"<article>{ARTICLE}</article><form><p>Your search</p></form>",
        f'<article>{ARTICLE}</article><div class="comments"><article class="comment"><p>{"A reader says this. " * 20}</p></article></div>',
        f'<article>{ARTICLE}</article><div class="comment-list"><p>Me too</p></div><div class="cookie-notice">We use</div>',
        f'<div class="sidebar"><h1>Site</h1></div><div class="text">{ARTICLE}</div>',
    ],
)
def test_wrappers_keep_the_article(html):
    assert article(html) == TEXT


def test_names_inside_an_article():
    inner = '<div class="share-price"><p>Shares rose.</p></div><p class="notice-text">It was noticed.</p><div class="share-buttons"><p>Tweet</p></div>'
    assert article(f"<article>{ARTICLE}{inner}</article>") == f"{TEXT}\nShares rose.\nIt was noticed."


@pytest.mark.parametrize("html", ["<div>" * 200_000 + "some text", "<a b " * 200_000, '<a b="' * 150_000 + ">", "<!a" * 200_000, "<a b='x\" " * 100_000])
def test_time_is_linear_in_the_page(html):
    """Ten times the page takes about ten times as long; a quadratic scan would take a hundred."""

    def seconds(text):
        started = time.process_time()
        article(text)
        return time.process_time() - started

    assert seconds(html) < 30 * seconds(html[: len(html) // 10]) + 1


def test_clean_rows_beside_contaminated_ones_stay(spark):
    passage = " ".join(f"bench{k}" for k in range(20))
    bench = spark.createDataFrame([(1, passage)], "item_id long, text string")
    rows = [(None, passage, 1), (None, "clean words", 2), (None, None, 3), (7, passage, 4), (7, "clean too", 5), (8, "", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, contaminated_key long")
    left = decontaminate.drop_contaminated(docs, bench)
    assert left.columns == docs.columns and sorted(r.contaminated_key for r in left.collect()) == [2, 3, 5, 6]
    in_blocks = decontaminate.benchmark_matches(docs, bench.unionAll(spark.createDataFrame([(2, "a b c d")], bench.schema)), block_words=1)
    assert in_blocks.columns == decontaminate.benchmark_matches(docs, bench).columns


def test_quality_beside_clashing_names(spark):
    rows = [(1, "s", "word " * 5, 9, 9, 9, 9, 9, 9), (2, None, " ".join(f"w{k}" for k in range(80)), 9, 9, 9, 9, 9, 9)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, n_words long, grams long, words long, host long, copy long, quality_key long")
    judged = {r.doc_id: (r.n_words, r.grams, r.host, r.kept) for r in quality_lines.quality_verdicts(docs).collect()}
    assert judged == {1: (5, 9, 9, False), 2: (80, 9, 9, True)}
    left = quality_lines.keep_quality(docs)
    assert left.columns == docs.columns and [r.doc_id for r in left.collect()] == [2]


def test_terms_need_evidence(spark):
    """A word of documents with the entity only gives it away; one that also stands elsewhere by chance doesn't."""
    filler = lambda k: " ".join(f"common{j}" for j in range(30)) + f" plain{k}"
    rows = [(k, filler(k)) for k in range(40)]
    rows += [(100 + k, f"{filler(100 + k)} Ozymandias wrote from oz@desert.org") for k in range(4)]
    rows += [(200, f"{filler(200)} chancy solo x@y.org"), (201, f"{filler(201)} chancy")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    told = {}
    for r in pii.personal_spans(docs).collect():
        text = dict(rows)[r.doc_id]
        told[r.doc_id] = {(text[s.start : s.end], s.action) for s in r.spans if s.kind == "term"}
    assert all(("Ozymandias", "remove") in told[100 + k] for k in range(4))  # always beside one entity, often enough
    assert ("solo", "word") in told[200] and not told[201]  # one document of two proves nothing
    assert all(not told[k] for k in range(40)) and all("common3" not in {t for t, _ in x} for x in told.values())
    clean = pii.sanitise(docs.selectExpr("*", "1 AS personal_key", "2 AS personal_spans"))
    assert {r.doc_id: r.text for r in clean.collect()}[201] == dict(rows)[201]
