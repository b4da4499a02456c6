"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns; planted copies and passages."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import embedding_dedup, html, line_dedup, mixing, ngram_join, quality, substring_dedup, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, removed string, bucket int"
PASSAGE = "The ferry left the northern quay before dawn with forty crates of salted fish. Nobody on the pier had counted them twice that week. " \
    "The harbour master wrote the number seven in the margin of his ledger. A boy with a lantern walked behind the last cart until it stopped. " \
    "By noon the whole town spoke of nothing else but the missing crates and the boy. The captain, for once, had no answer to give."
LONG = " ".join(f"w{i}" for i in range(30_000))
ROWS = [
    (1, None, "en", "a", None), (2, "", "en", "a", 0), (3, " \n\t ", None, None, 4), (4, "one", "en", "b", 3), (4, "one", "en", "b", 3), (None, "one", "en", None, 3),
    (5, LONG, "de", "b", len(LONG)), (6, LONG + " tail", "de", "b", 1), (7, f"Opening words of seven. {PASSAGE} Closing words of seven.", "en", "a", 1),
    (8, f"Eight begins in another way. {PASSAGE} It ends otherwise too.", "en", "a", 1),
    (9, "The quick brown fox jumps over the lazy dog near the river bank\nunique nine here", "en", "a", 1),
    (10, "the quick brown fox jumps over the lazy dog near the river banks\nsomething of ten alone", "en", "a", 1),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "k", "r", 1) for r in ROWS], DOCS)


def ids(df):
    return sorted((r.doc_id is not None, r.doc_id or 0) for r in df.select("doc_id").collect())


OPERATORS = [line_dedup.line_dedup, ngram_join.ngram_join, mixing.mix_sources, substring_dedup.substring_dedup, quality.text_counts]


@pytest.mark.parametrize("operator", OPERATORS, ids=lambda f: f.__name__)
def test_all_rows_come_back_and_empty_tables_give_none(docs, operator):
    assert ids(operator(docs)) == ids(docs)
    assert operator(docs.where("false")).count() == 0


def test_lines(docs):
    rows = {r.doc_id: r for r in line_dedup.line_dedup(docs).collect()}
    assert rows[9].removed == [] and rows[10].removed == [0]
    assert rows[10].kept_text == "something of ten alone"
    assert rows[1].kept_text is None and rows[2].kept_text == ""


def test_passages(docs):
    rows = {r.doc_id: r for r in substring_dedup.substring_dedup(docs).collect()}
    assert rows[7].n_removed == 0 and rows[7].kept_text == rows[7].text
    assert rows[8].first_docs == [7] and "harbour master" not in rows[8].kept_text and rows[8].kept_text.startswith("Eight begins")


def test_passages_go_to_their_last_sentence(spark):
    def said(name, *sizes):
        return "".join(" ".join(f"{name}{i}x{j}" for j in range(n)) + ". " for i, n in enumerate(sizes))

    passage = said("p", 25, 8, 8)
    data = [(1, passage), (2, passage), (3, said("a", 12, 9) + passage + said("b", 9, 12)), (4, said("c", 5) + said("q", 22) + said("d", 9)), (9, said("q", 22) + said("g", 9))]
    data += [(5, said("e", 9, 9)), (6, said("e", 9, 9)), (7, said("f", 10, 10)), (8, said("f", 10, 10))]
    rows = {r.doc_id: r for r in substring_dedup.substring_dedup(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert rows[1].n_removed == 0 and rows[2].kept_text == "" and rows[2].first_docs == [1]
    assert rows[3].kept_text == said("a", 12, 9) + said("b", 9, 12)
    assert rows[9].n_removed == 0  # one sentence is no run
    assert rows[6].n_removed == 0 and rows[8].kept_text == ""  # 18 words are too few, 20 are enough


def test_spans_cover_what_any_repeated_run_covers():
    rng = np.random.default_rng(3)
    for _ in range(200):
        pieces = [" ".join(rng.choice(list("abcdefgh"), n)) + ". " if n else " \n" for n in rng.integers(0, 14, rng.integers(1, 12))]
        held = [i for i, p in enumerate(pieces) if p.split()]
        words = [len(p.split()) for p in pieces]
        found = list(zip(*(x.tolist() for x in substring_dedup.spans(pieces)), strict=True))
        assert len({f[:2] for f in found}) == len(found)
        for i, a in enumerate(held):
            for j in range(i + 1, len(held)):
                if sum(words[a : held[j] + 1]) >= 20:
                    within = [f for f in found if f[0] >= a and f[1] <= held[j]]
                    assert {s for s in held[i : j + 1]} <= {s for f in within for s in range(f[0], f[1] + 1)}


def test_ngrams(docs):
    rows = {r.doc_id: r for r in ngram_join.ngram_join(docs).collect()}
    assert rows[6].component_id == 5 and rows[5].n_shingles == 29_997
    assert (rows[1].n_shingles, rows[2].n_shingles, rows[4].n_shingles) == (0, 0, 1)
    assert rows[None].component_id == 4  # a copy; a null id names no component
    assert rows[7].component_id == 7 and rows[8].component_id == 8


def test_counts(spark):
    text = "a b c d e\na b c d e\n#x 1"
    row = quality.text_counts(spark.createDataFrame([(1, text, None, None)], "doc_id long, text string, lang string, source string")).first()
    assert (row.n_words, row.n_repeat_words, row.n_dup_lines, row.n_symbols, row.word_chars) == (12, 10, 1, 1, 13)


def test_vectors(spark):
    nan = float("nan")
    data = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.1], 1), (4, [0.0, 1.0], 1), (5, [1.0, 0.0], 2), (6, [1.0, 0.0], None), (7, None, 1), (8, [0.0, 0.0], 1), (9, [nan, 1.0], 1), (10, [1.0, None], 1), (11, [], 1)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, label int").withColumn("key", F.lit(1))
    rows = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.embedding_dedup(df).collect()}
    assert [rows[i] for i in (1, 2, 3)] == [(2, 1, True), (2, 1, False), (2, 1, False)]
    assert all(rows[i] == (0, i, True) for i in range(4, 12))
    assert embedding_dedup.embedding_dedup(df.where("false")).count() == 0


def test_archives(spark, tmp_path):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    data = [(1, "http://a/", "<p>é</p>"), (2, "http://b/", "<p>é</p>"), (3, None, None), (4, "http://c/", ""), (5, "http://d/", inner + "WARC/1.0\r\n"), (6, "http://e/", "x" * 300_000)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    rows = {r.page_id: r for r in warc.archive_pages(pages, str(tmp_path / "w")).collect()}
    assert sorted(rows) == [1, 2, 3, 4, 5, 6]
    assert {k: r.payload_bytes for k, r in rows.items()} == {k: len((h or "").encode()) for k, _, h in data}
    assert rows[2].record_type == "revisit" and rows[2].refers_to == 1 and rows[4].refers_to == 3
    assert rows[3].payload_digest == "3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"  # of nothing
    assert warc.archive_pages(pages.where("false"), str(tmp_path / "none")).count() == 0


def test_main_text(spark):
    page = '<html><head><style>p{{}}</style></head><body><nav class="menu"><a href="/">Home</a></nav><div class="story"><h1>Title {0}</h1><p>The first  paragraph of {0} &amp; more, with enough words to count.</p><p>A second one follows here, and is as long as it should be.</p></div><div class="sidebar"><a href="/x">Other</a></div><footer>Imprint</footer><script>var a = "no";</script></body></html>'
    data = [(i, f"http://h.example/{i}", page.format(i)) for i in range(4)] + [(9, None, None), (10, "http://h.example/e", "")]
    rows = {r.page_id: r.text for r in html.extract_pages(spark.createDataFrame(data, "page_id long, url string, html string")).collect()}
    assert rows[2] == "Title 2 The first paragraph of 2 & more, with enough words to count. A second one follows here, and is as long as it should be."
    assert rows[9] == "" and rows[10] == ""


@pytest.mark.parametrize("size", [10, 5000, 100_000])
def test_attributes_of_any_length_are_no_text(size):
    body = "The story has words enough to be the main text of this page, and then a few more."
    data = "{&quot;hidden&quot;: 1} class='nav' <b>x</b> > " + "y" * size
    shown = f'<html><body><div data-x="{data}" class="story"><p>{body}</p></div><nav title="{"<i>" * size}"><p>{body} Menu</p></nav><p don\'t>Don\'t{" z" * size}</p></body></html>'
    broken = f'<html><body><div class="story" title="{size}><p>{body}</p></div></body></html>'
    stray = f'<html><body><div class="story""><p>{body}</p></div><p>{"z " * size}said</p></body></html>'
    for page, text in [(shown, f"{body} Don't{' z' * size}"), (broken, body), (stray, f"{body} {'z ' * size}said")]:
        nodes = html.parse(page)
        assert html.text_in(nodes, nodes[:1]) == text
    assert "html>body>div.story" in [html.path_of(n) for n in html.parse(shown)]
