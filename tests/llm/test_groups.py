"""Groups of near copies against brute force, what long and odd inputs may not lose, and edges of the model's and the codec's operators."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from varloom.llm import cluster, html, line_dedup, mixing, ngram_join, sentencepiece_codec, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def components(sets, least):
    """The smallest index that each set reaches by pairs with a similarity of least / 100 or more."""
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(sets)), 2):
        both = len(sets[i] & sets[j])
        if 100 * both >= least * (len(sets[i]) + len(sets[j]) - both):
            a, b = root(i), root(j)
            parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(sets))]


def test_a_cloud_of_near_copies_by_words(spark):
    rng = np.random.default_rng(5)
    texts = []
    for _ in range(120):
        words = [f"w{i}" for i in range(160)]
        for _ in range(rng.integers(0, 7)):
            words[rng.integers(0, 160)] = f"x{rng.integers(0, 40)}"
        texts.append(" ".join(words))
    texts += [" ".join(rng.choice([f"q{j}" for j in range(3000)], 120)) for _ in range(30)]
    sets = [{tuple(w[i : i + 4]) for i in range(len(w) - 3)} for w in map(str.split, texts)]
    rows = {r.doc_id: r.component_id for r in ngram_join.ngram_join(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i] for i in range(len(texts))] == components(sets, 85)


def test_a_cloud_of_near_copies_by_characters_and_recall(spark):
    rng = np.random.default_rng(7)
    lines, base = [], "".join(rng.choice(list("abcdefghij klmnop"), 300))
    for _ in range(120):
        line = list(base)
        for _ in range(rng.integers(0, 9)):
            line[rng.integers(1, 299)] = str(rng.choice(list("uvwxyz")))
        lines.append("".join(line))
    # pairs at 0.80 to 0.90 with nothing else near them: 285 of 300 to 315 shingles are shared
    alone = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz ,."), 292)) for _ in range(60)]
    pairs = [x for a in alone for x in (a, a + "".join(rng.choice(list("0123456789"), rng.integers(32, 70))))]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(lines + pairs)], DOCS)
    rows = {r.doc_id: r.n_removed for r in line_dedup.line_dedup(docs).collect()}
    k = line_dedup.SHINGLE
    sets = [{t[i : i + k] for i in range(len(t) - k + 1)} for t in (x.strip() for x in lines + pairs)]
    want = [int(c != i) for i, c in enumerate(components(sets, 80))]
    got = [rows[i] for i in range(len(sets))]
    assert all(w >= g for w, g in zip(want, got, strict=True))  # exact checks: nothing goes that need not
    assert got[: len(lines)] == want[: len(lines)]
    assert sum(got[len(lines) :]) >= 0.95 * sum(want[len(lines) :]) and sum(want[len(lines) :]) >= 50  # of the pairs alone


@pytest.mark.parametrize("size", [100, 3000])
def test_members_of_one_bucket_meet_by_sketches_and_large_sets_by_differences(spark, size):
    rng = np.random.default_rng(size)
    sets = []
    for _ in range(8):  # unrelated to each other but for a few tokens, each with two near copies
        own = set(range(5)) | {int(x) for x in rng.integers(1 << 20, 1 << 62, size - 5)}
        some = sorted(own)[10:]
        sets += [own, own - set(some[: size // 12]), own - set(some[-size // 12 :])]
    ids = list(range(len(sets)))
    held = spark.createDataFrame([(i, [(x * 0x9E3779B97F4A7C15) % (1 << 63) for x in s]) for i, s in zip(ids, sets, strict=True)], "id long, s array<long>").cache()
    listed = []

    def both(pairs):
        return pairs.join(held.select(F.col("id").alias("a"), F.col("s").alias("x")), "a").join(held.select(F.col("id").alias("b"), F.col("s").alias("y")), "b")

    def verify(pairs):
        return both(pairs).where(100 * F.size(F.array_intersect("x", "y")) >= 80 * F.size(F.array_union("x", "y"))).select("a", "b")

    def diffs(pairs):
        listed.append(pairs.count())
        return both(pairs).select("a", "b", F.size("y").cast("long").alias("size"), F.explode(F.concat(F.array_except("x", "y"), F.array_except("y", "x"))).alias("token"))

    def facts(of):
        return held.join(of, "id").select("id", F.explode("s").alias("t")).groupBy("id").agg(F.count(F.lit(1)).alias("size"), *cluster.sketch(F.col("t")))

    members = spark.createDataFrame([(7, i) for i in ids], "bucket long, id long")
    rows = {r.id: r.component for r in cluster.linked(members, facts, verify, diffs, 80).collect()}
    assert [rows.get(i, i) for i in ids] == components(sets, 80)
    assert bool(listed) == (size > 2000)  # sets that sketches tell apart need no lists of their differences


def test_long_and_foreign_urls_and_magics_in_payloads(spark, tmp_path):
    record = "WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n"
    data = [(1, "http://a/é?ü=ß", "<p>one</p>"), (2, "http://b/" + "x" * 150_000, "<p>two</p>"), (3, "http://c/", record * 3), (4, "http://d/", "<p>one</p>"), (4, "http://d/", "<p>one</p>"), (None, "http://e/", "five")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumn("digest", F.lit(1)).coalesce(1)
    rows = warc.archive_pages(pages, str(tmp_path / "w")).collect()
    assert sorted((r.page_id or 0, r.url, r.payload_bytes) for r in rows) == sorted((p or 0, u, len(h.encode())) for p, u, h in data)
    assert {(r.record_type, r.refers_to) for r in rows if r.page_id == 4} == {("revisit", 1)}


BODY = "The story has words enough to be the main text of this page, and then a few more words to come. " * 6


@pytest.mark.parametrize("name", ["article-side", "entry-content meta", "has-sidebar", "sidebar content"])
def test_what_holds_the_prose_is_not_out_for_its_name(name):
    nodes = html.parse(f'<html><body><div class="{name}"><p>{BODY}</p></div><div class="x"><p>Other words.</p></div></body></html>')
    assert html.text_in(nodes, [html.best_container(nodes)]).startswith(BODY[:90])


def test_comments_are_out_and_deep_pages_are_read():
    nodes = html.parse(f'<html><body><article><h1>T</h1><p class="post-meta">By me</p><p>{BODY[:190]}</p></article><section class="comments"><div class="comment-body"><p>{BODY}</p></div></section></body></html>')
    assert html.text_in(nodes, [html.best_container(nodes)]) == f"T {BODY[:190].strip()}"
    deep = html.parse("<div>" * 30_000 + "words at the bottom")
    assert html.text_in(deep, [html.best_container(deep)]) == "words at the bottom"


def test_rows_without_an_id_are_dealt_like_others(spark):
    docs = spark.createDataFrame([(None if i % 2 else i, f"w{i} " * 400, "en", "s", 0) for i in range(400)], DOCS)
    rows = mixing.mix_sources(docs, shard=16_000).collect()
    shards = [{r["shard"] for r in rows if (r.doc_id is None) == none} for none in (True, False)]
    assert len(shards[0]) > 5 and len(shards[1]) > 5
    assert all(0 <= r.taken <= 2 * r["size"] for r in rows)


def test_toxicity_edges(spark):
    bad, good = "you are a worthless idiot and scum", "the harbour was quiet in the morning"
    data = [(i, (bad if i % 2 else good) + f" n{i} " + "and more words of no weight " * (i % 5)) for i in range(240)] + [(1000, None), (1001, ""), (1002, " \n "), (1003, bad), (1003, bad), (1004, "calm words " * 100_000)]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumns({c: F.lit(7) for c in ("x", "features", "_vote", "score", "probability", "prediction")})
    labels = spark.createDataFrame([(i, i % 2) for i in range(240)] + [(9999, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    rows = model.score(docs, ["doc_id", "x", "features", "score"]).collect()
    assert len(rows) == len(data) and all(0 <= r.score <= 1 and r.x == 7 and r.features == 7 for r in rows)
    score = {r.doc_id: r.score for r in rows}
    assert score[1003] >= 0.7 > score[1004] and score[1000] == score[1001] == score[1002]
    assert model.score(docs.where("false"), ["doc_id"]).count() == 0
    one = toxicity.fit(docs, labels.where("toxic = 0"))
    assert {r.score for r in one.score(docs.limit(3), ["doc_id"]).collect()} == {0.0}
    assert {r.score for r in toxicity.fit(docs, labels.where("false")).score(docs.limit(3), ["doc_id"]).collect()} == {0.0}


def test_codec_edges(spark):
    docs = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, None)], "doc_id long, text string").withColumns({c: F.lit(7) for c in ("ids", "same", "window", "_text")})
    rows = sentencepiece_codec.encode_documents(docs, docs.columns).collect()
    assert len(rows) == 3 and rows[0] == rows[1] and rows[0]._text == 7 and rows[0].same is True
    assert sentencepiece_codec.encode_documents(docs.where("false"), ["doc_id"]).count() == 0
    long = "▁" + "abcdefghijklmnopqrstuvwxyz" * 4000
    encoder = sentencepiece_codec.Encoder(sentencepiece_codec.load())
    assert sum(1 for _ in encoder.stream(long)) > 0 and encoder.widest <= 4 * encoder.v.longest


def test_search_of_short_segments_is_the_stream_and_the_library():
    import sentencepiece

    encoder = sentencepiece_codec.Encoder(sentencepiece_codec.load())
    library = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    words = ["a", "ab", "the", "xyzzy", "international", "aaaaaaaaaaaaaaa", "é§ö", "日本語テキスト", "x=1;y=22", "qzx-0x7f3A", "\t\n", "counterrevolutionaries"]
    for word in words:
        assert encoder.search("▁" + word) == list(encoder.stream("▁" + word)) == library.encode(word)
