"""Operators that judge rows one by one: BPE, token counts, rules, quality, language, HTML."""

import hashlib
import random
import struct
import zlib

import duckdb
import pytest
from brute import rule_counts
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mainstay.llm import bpe, html_text, language, quality_qda, quality_rules, token_counts
from mainstay.llm.pretokens import parts, pretokens
from mainstay.llm.registry import WORD_BPE, Q, digests

FOLDER = "/root/testdata/sf0.001"
LONG = "lorem ipsum dolor \n" * 30_000
ODD = [
    None, "", " ", "\n\n", "a", "A a A a A a", "<|endoftext|>x<|startoftext|>", "<|endoftext", "İstanbul ΣΑΣ J̌ ſt ﬁ", "漢字 テスト",
    "don't I'VE 'S we'll", "a\x00b\x1c\x1d​ x\x85y\xa0z", "½²٣ 12 345", "x" * 5000, "👍🏽 ok", "### | $$ !!", "aaaa" * 400 + " bb",
    LONG, LONG, "y" * 300_000,
]
CLASHING = "doc_id long, text string, n_tokens string, token_ids int, lang string, score string, kept string, stats int, label int"


def table(spark, texts=ODD):
    rows = [(None if k == 3 else k, t, "x", k, None if k % 3 else "xx", "s", "k", 1, 0) for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, CLASHING).repartition(3)


def expected_ids(texts):
    library = Tokenizer.from_file(WORD_BPE)
    return library, [e.ids for e in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def sha(data):
    return hashlib.sha256(data).hexdigest()


def test_bpe_equals_the_library(spark):
    library, ids = expected_ids(ODD)
    encoded = bpe.encode(table(spark).withColumn("k", F.col("doc_id")), WORD_BPE, keep=("doc_id", "n_tokens"))
    assert encoded.columns == ["doc_id", "n_tokens", "token_ids"]
    whole = digests(bpe.encode_and_decode(table(spark), WORD_BPE))
    found = sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in whole.collect())
    apart = digests(bpe.decode(bpe.encode(table(spark), WORD_BPE), WORD_BPE))
    assert sorted((r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in apart.collect()) == found
    packed = [struct.pack(f"<{len(x)}I", *x) for x in ids]
    texts = [library.decode(x, skip_special_tokens=False) for x in ids]
    assert found == sorted((len(x), sha(p), sha(t.encode())) for x, p, t in zip(ids, packed, texts))


def test_bpe_query_equals_the_library(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    library, ids = expected_ids([d.text for d in docs])
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in Q["op4_bpe"](spark, FOLDER).collect()}
    assert found == {
        d.doc_id: (len(x), sha(struct.pack(f"<{len(x)}I", *x)), sha(library.decode(x, skip_special_tokens=False).encode()))
        for d, x in zip(docs, ids, strict=True)
    }


def test_bpe_edges(spark, monkeypatch):
    assert bpe.encode_and_decode(table(spark, []), WORD_BPE).count() == 0
    rules, small = bpe.Vocabulary(WORD_BPE), bpe.Vocabulary(WORD_BPE)
    texts = [t or "" for t in ODD]
    expected = rules.encode_all(texts)
    # Many small chunks and parts, and a store that is always full.
    monkeypatch.setattr(bpe, "CHUNK", 100)
    monkeypatch.setattr(bpe, "CACHE", 2000)
    monkeypatch.setattr(bpe, "DECODED", 3)
    assert small.encode_all(texts) == expected and len(small.words) < len(rules.words)
    library = Tokenizer.from_file(WORD_BPE)
    for packed in expected:
        ids = list(struct.unpack(f"<{len(packed) // 4}I", packed))
        assert bpe.decode_ids(WORD_BPE, packed) == library.decode(ids, skip_special_tokens=False)


def test_bpe_on_random_words():
    rng = random.Random(3)
    letters = "abehlinorstéßüĀ漢́.!<|>12' É"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 70))) for _ in range(3000)]
    texts += ["".join(chr(rng.choice([rng.randint(0, 0x24F), rng.randint(0, 0x3000)])) for _ in range(20)) for _ in range(1500)]
    rules = bpe.vocabulary(WORD_BPE)
    found = [list(struct.unpack(f"<{len(x) // 4}I", x)) for x in rules.encode_all(texts)]
    assert found == expected_ids(texts)[1]


def test_bpe_proposals_are_checked_and_mended():
    rules = bpe.Vocabulary(WORD_BPE)
    text = duckdb.sql(f"SELECT string_agg(text, ' ') FROM '{FOLDER}/documents.parquet'").fetchall()[0][0]
    new = set(pretokens(WORD_BPE, text))
    failed = rules.learn(new)
    assert 0 < failed < len(new)
    # A small cache gives the same ids.
    small = bpe.Vocabulary(WORD_BPE)
    bpe.CACHE, kept = 5000, bpe.CACHE
    try:
        assert [small.encode_all([t])[0] for t in text.split("\n")] == [rules.encode_all([t])[0] for t in text.split("\n")]
    finally:
        bpe.CACHE = kept


def test_parts_lose_nothing():
    for text in ("", "abc", "a b c d e f g", "x" * 50, "x" * 30 + " y\nz"):
        assert "".join(parts(text, 4)) == text


def test_token_counts_equal_the_library(spark):
    _, ids = expected_ids(ODD)
    rows = token_counts.count_tokens(table(spark), WORD_BPE).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in rows) == sorted((len((t or "").encode()), len(x)) for t, x in zip(ODD, ids))


def test_token_table_doesnt_change_counts(spark):
    whole = {r.doc_id: r.n_tokens for r in Q["op10_token_counts"](spark, FOLDER).collect()}
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    _, ids = expected_ids(list(texts.values()))
    assert whole == dict(zip(texts, map(len, ids)))
    words = token_counts.frequent_pretokens(docs, WORD_BPE, size=5)
    assert len(words) == 5 and "the" in words


def test_rules_on_odd_texts(spark):
    texts = [*ODD, "a b c " * 40, "one two three four\n" * 30, "a b c a b c x a b", "a b\na b\n\n \n a b"]
    rows = quality_rules.quality_rules(table(spark, texts)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted(tuple(r[n] for n in names) for r in rows) == sorted(map(rule_counts, texts))
    assert not any(r.kept and r.base_failed for r in rows)


def test_rules_keep_clean_documents(spark):
    rows = quality_rules.quality_rules(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = rows.join(labels, "doc_id").where("not base_failed").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    shares = {r.quality: r.kept for r in found.collect()}
    assert shares[1] == 1.0 and shares[0] < 0.05


def test_quality_on_held_out_documents(spark):
    folder = "/root/testdata/sf0.01"
    found = Q["op7_quality_qda"](spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    held = [r for r in found if r.held_out]
    assert {r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found} == {True}
    assert sum(r.predicted == r.quality for r in held) / len(held) > 0.98
    assert all(0 <= r.score <= 1 for r in found)


def test_quality_edges(spark):
    docs = table(spark)
    labels = spark.createDataFrame([(0, 1), (1, None), (2, 0), (99, 1), (5, 1), (5, 0)], "doc_id long, quality int")
    rows = quality_qda.classify(docs, labels).collect()
    assert len(rows) == len(ODD) and all(0 <= r.score <= 1 for r in rows)
    none = labels.limit(0)
    assert {r.score for r in quality_qda.classify(docs, none).collect()} == {0.5}
    good = spark.createDataFrame([(k, 1) for k in range(12)], "doc_id long, quality int")
    assert {r.score for r in quality_qda.classify(docs, good).collect()} == {1.0}
    assert quality_qda.classify(docs.limit(0), labels).collect() == []
    kept = quality_qda.drop_rejected(docs, good)
    assert kept.columns == docs.columns and kept.count() == len(ODD)


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    found = Q["op9_language"](spark, "/root/testdata/sf0.01").join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.99


def test_language_mixtures(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.learn(docs)
    texts = {r.lang: r.text for r in docs.where("n_chars between 2000 and 3000").dropDuplicates(["lang"]).collect()}
    main, share, chosen = model.languages(texts["de"] + " " + texts["fr"] * 2)
    assert main == "fr" and set(chosen) == {"de", "fr"} and 0.55 < share < 0.8
    assert model.languages(texts["de"].upper())[0] == "de"


def test_language_edges(spark):
    rows = {r.doc_id: r for r in language.identify(table(spark)).collect()}
    assert len(rows) == len(ODD)
    for k in (0, 1, 2):
        assert (rows[k].lang_pred, rows[k].score) == ("und", 0.0)
    assert rows[4].lang_pred == "xx" and 0 < rows[4].score <= 1
    untaught = table(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language.identify(untaught).collect()} == {"und"}
    assert language.identify(table(spark).limit(0)).collect() == []


def plain_article(page):
    """The text of the test pages' articles, by their known make."""
    import html
    import re

    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", re.sub(r"</?b>", "", body).replace("<br>", " "))
    return "\n\n".join(" ".join(html.unescape(b).split()) for b in blocks if b.strip())


def test_html_of_the_test_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{FOLDER}/pages.parquet").collect()}
    for r in Q["op5_html_text"](spark, FOLDER).collect():
        assert r.text == plain_article(pages[r.page_id]) and r.n_chars == len(r.text)


ARTICLE = "<p>Some text of the post, with words that go on.</p><p>And more text of it, which goes on as well.</p>"


@pytest.mark.parametrize("page, wanted, unwanted", [
    (f'<body class="has-sidebar"><div id="sidebar"><p>Side matter, long enough to be read.</p></div><div class="post">{ARTICLE}</div>', ["Some text", "And more"], ["Side"]),
    (f"<article><header><h1>Title</h1></header>{ARTICLE}<aside>Note aside</aside><ul><li>one<li>two</ul></article>", ["Title", "one\n\ntwo"], ["aside"]),
    (f'<main>{ARTICLE}<section class="comments">{"<p>I liked this a lot, and so on, thanks for it.</p>" * 30}</section></main>', ["Some text"], ["liked"]),
    (f"<header><p>Site header text here</p></header><nav><a href=/>Home</a></nav><main>{ARTICLE}</main><form>Name<input></form><footer>Foot</footer>", ["Some text"], ["Site", "Home", "Name", "Foot"]),
    (f'<div class="cookie-notice"><p>We use cookies to make this better.</p></div><article>{ARTICLE}<script>var a = "<p>";</script><style>p {{}}</style></article>', ["Some text"], ["cookies", "var", "{}"]),
    (f'<article>{ARTICLE}</article><section id="readerComments"><article class="c"><p>A comment as an article of its own, at length.</p></article></section><div class="related"><article><p>Another article of this site to be read.</p></article></div><article class="comment"><p>One more comment, at some length too.</p></article>', ["Some text"], ["comment", "Another"]),
    (f'<div class="content">{ARTICLE}<p style="display: none">Not shown to a reader at all, it is.</p><p hidden>Nor this one, which is as long.</p></div>', ["Some text"], ["Not shown", "Nor"]),
    ("<article><p>a &lt; b &amp;amp; c&nbsp;d\n\t e &eacute;&#233;</p>unclosed <b>bold<p>next</article>", ["a < b &amp; c d e éé", "unclosed bold\n\nnext"], []),
])
def test_html_of_other_makes(spark, page, wanted, unwanted):
    model = html_text.learn(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    text = model.main_text(page)
    assert all(w in text for w in wanted) and not any(u in text for u in unwanted), text


COMMENTS = "<p>I liked this a lot, and so on, thanks for it.</p>" * 30


@pytest.mark.parametrize("page, wanted, unwanted", [
    (f'<article class="post comments-open">{ARTICLE}</article>', ["Some text", "And more"], []),
    (f'<article class="post category-social tag-legal">{ARTICLE}</article>', ["Some text", "And more"], []),
    ('<article class="post no-ads has-sidebar"><p>Only one run of text.</p></article>', ["Only one"], []),
    (f'<div class="article-body ad-free">{ARTICLE}</div>', ["Some text", "And more"], []),
    (f'<article class="post social">{ARTICLE}</article>', ["Some text", "And more"], []),
    (f'<main class="search">{ARTICLE}<h2>Part</h2><ul><li>First point of the list<li>Second one</ul>{ARTICLE}</main>', ["Part", "Some text", "And more"], []),
    (f'<article>{ARTICLE}<h2 id="related-work">Related work</h2>{ARTICLE}<h2 id="search">Search</h2><h3 id="comments">On comments</h3>{ARTICLE}</article>', ["Related work", "Search", "On comments"], []),
    (f'<article><section id="legal-history"><h2>Legal history</h2>{ARTICLE}</section><section id="search"><h2>Search</h2>{ARTICLE}</section><section id="advertisement-theory">{ARTICLE}</section></article>', ["Legal history", "Search", "Some text"], []),
    (f'<main>{ARTICLE}<div id="comments-area">{COMMENTS}</div><div class="share-buttons"><p>Share this text with others</p></div></main>', ["Some text"], ["liked", "Share"]),
    (f'<article>{ARTICLE}<section id="readerComments">{COMMENTS}</section></article><article class="comment">{COMMENTS}</article>', ["Some text"], ["liked"]),
    (f'<article>{ARTICLE}<div class="ad"><p>Buy this now, it is cheap and good.</p></div>{ARTICLE}</article>', ["Some text"], ["Buy"]),
    (f'<div class="related-posts"><p>Other posts that may be of interest here</p></div><div class="entry-content">{ARTICLE}</div>', ["Some text"], ["Other posts"]),
])
def test_html_words_are_weighed(spark, page, wanted, unwanted):
    """Words of the list are outweighed by text and marks; tokens that only hold one are signs of their own."""
    model = html_text.learn(spark.read.parquet(f"{FOLDER}/pages.parquet"))
    text = model.main_text(page)
    assert all(w in text for w in wanted) and not any(u in text for u in unwanted), text
    assert text.count("Some text") == page.count("Some text")


def test_html_words_learn_from_marked_pages():
    """The only element that pages mark as content teaches that its word isn't of the other kind."""
    from collections import Counter

    tree = html_text.parse('<body><article class="widget"><p>Some text</p></article></body>')
    labels = html_text.author_labels(tree)
    assert labels[tree.tags.index("article-worded")] == 1
    counts = Counter()
    for _ in range(4000):
        counts.update(html_text.observed(tree, labels))
    bare, taught = html_text._model(Counter()).signs["word=widget"], html_text._model(counts).signs["word=widget"]
    assert bare < -10 and taught > bare + 1


@pytest.mark.parametrize("page, wanted", [
    ("<!doctype html><html><head><title>T</title><article><p>Text", "Text"),
    ("<head><meta charset=utf-8><link rel=x><style>p {}</style><script>var a</script>\n<noscript><img src=x></noscript><main>Text, and <p>more", "Text, and\n\nmore"),
    ("<head><title>T</title><template><p>unseen</p></template><noscript><p>unseen</p></noscript><article>Text</article>", "Text"),
    ("<head><head><title>T</title></head><title>U</title><body><article>Text</article>", "Text"),
])
def test_html_open_head(page, wanted):
    """A head without end ends at the first element that can't stand in one."""
    from collections import Counter

    assert html_text._model(Counter()).main_text(page) == wanted


def test_html_text_ends_a_head():
    assert html_text.parse("<head><title>T</title>\n Text <b>of</b> a page").texts[-1] == "Text of a page"


@pytest.mark.parametrize("attributes, unshown", [
    ('aria-label="The hidden life of trees"', False), ('data-title="a hidden cost"', False), ('class="p-4 hidden md:block"', False),
    ('title="use display: none here"', False), ("data-x='a hidden b'", False), ("title=hidden", False), ('aria-hidden="true"', False),
    ('style="--x-display: none"', False), ("hidden", True), ('class="a" hidden=""', True), ("HIDDEN/", True), ('id=a hidden title="b"', True),
    ('style="color: red; display : none"', True), ("style=display:none", True), ("STYLE='Display:None'", True), ('class="a"hidden', True),
])
def test_html_hidden_is_an_attribute(attributes, unshown):
    from collections import Counter

    page = f"<article {attributes}><p>Some text of the post, with words that go on.</article>"
    assert html_text._model(Counter()).main_text(page) == ("" if unshown else "Some text of the post, with words that go on.")


def test_html_keeps_formulas():
    from collections import Counter

    formula = '<math><semantics><mrow><mi>x</mi> <mo>=</mo> <mn>2</mn></mrow><annotation encoding="tex">x=2</annotation></semantics></math>'
    page = f"<article><p>Here {formula} holds, <math><mtable><mtr><mtd>a</mtd><mtd>b</mtd></mtr></mtable></math> too.</p></article>"
    assert html_text._model(Counter()).main_text(page) == "Here x = 2 holds, a b too."


def test_html_edges(spark):
    pages = [None, "", "<", "<p", "<!-- x", "<div>" * 20_000 + "deep", "&amp;" * 10, "<article>x</article>", "<article>x</article>"]
    df = spark.createDataFrame([(None if k == 1 else k, None, p, "t") for k, p in enumerate(pages)], "page_id long, url string, html string, text string")
    rows = html_text.extract(df).collect()
    assert len(rows) == len(pages) and sorted(r.text for r in rows).count("x") == 2
    assert all(r.n_chars == len(r.text) for r in rows)
    assert html_text.extract(df.limit(0)).collect() == []


def test_messages_agree_with_enumeration():
    """Marginals of a small tree against the sum over all labellings."""
    import itertools
    import math

    tree = html_text.parse("<div><p>some text</p><ul><li>one<li>two</ul></div>")
    model = html_text.ContentModel({"tag=p": 0.7, "run=plain3": 0.3, "run=plain2": -0.4, "run=plain4": 0.2}, {False: 0.1, True: 0.2}, {False: 0.9, True: 0.7})
    n = len(tree.tags)
    total = [0.0] * n
    whole = 0.0
    for labels in itertools.product((0, 1), repeat=n):
        weight = 1.0
        for k in range(n):
            weight *= math.exp(labels[k] * sum(model.signs.get(s, 0.0) for s in tree.signs[k]))
            if k:
                part = tree.tags[k] in html_text.PARTS
                yes = (model.given_content if labels[tree.parents[k]] else model.given_other)[part]
                weight *= yes if labels[k] else 1 - yes
        whole += weight
        for k in range(n):
            total[k] += weight * labels[k]
    assert [1 / (1 + math.exp(-o)) for o in model.marginals(tree)] == pytest.approx([t / whole for t in total])
