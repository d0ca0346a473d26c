"""Operators over whole tables: top-k, mixing, line dedup, near-duplicates, and the pipeline."""

import random
import struct

import numpy as np
import pyarrow.parquet as pq
import pytest
from brute import kept_lines, mixture, near_components, shingle_set
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from mainstay.llm import line_dedup, mixing, near_dedup, quality_qda, topk
from mainstay.llm.registry import WORD_BPE

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, keep int, pos int, rep int, first int"


def documents(spark, rows):
    """rows: (doc_id, text, source); with columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "en", s, len(t or ""), 1, 2, 3, 4) for d, t, s in rows], DOCS).repartition(4)


def brute_top(vectors, queries, k):
    out = []
    for q, x in queries.items():
        scored = []
        for v, y in vectors.items():
            if v != q:
                scored.append((-sum(a * b for a, b in zip(x, y)), v))
        out += [(q, rank + 1, v, -s) for rank, (s, v) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def test_top_k_with_ties_and_ragged_vectors(spark):
    rng = random.Random(5)
    vectors = {k: [rng.randint(-2, 2) for _ in range(rng.choice([0, 3, 4]))] for k in range(300)}
    vectors |= {k: [1, 1, 1, 1] for k in range(300, 700)}
    vectors[701] = [2**40, 2**20, -(2**33), 5]
    df = spark.createDataFrame(list(vectors.items()), "id long, v array<long>").repartition(5)
    chosen = {k: v for k, v in vectors.items() if k % 50 == 0 or k == 701}
    found = topk.top_k(df, df.where("id % 50 = 0 or id = 701"), 7)
    assert sorted(map(tuple, found.collect())) == brute_top(vectors, chosen, 7)


def test_top_k_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.3]), (50, [1.0, 2.0]), (1, None), (2, [nan, 1.0]), (3, [None, 1.0]), (4, [inf, 0.0]), (5, []), (None, [1.0, 1.0]),
            (7, [0.1, 0.1]), (7, [0.1, 0.1]), (7, [0.0, 9.0])]
    df = spark.createDataFrame([(k, v, 1, 2) for k, v in rows], "vec_id long, embedding array<float>, score int, rank int")
    ints = {0: [128, -77], 50: [256, 512], 5: [], 7: [0, 2304]}
    assert sorted(map(tuple, topk.search(df).collect())) == brute_top(ints, {k: ints[k] for k in (0, 50)}, 5)
    assert topk.search(df.limit(0)).collect() == []
    assert topk.search(df.where("vec_id = 0")).collect() == []


def test_lines_against_brute_force(spark):
    long = "\n".join(f"line number {k % 900} of a very long text" for k in range(3000))
    rows = [
        (3, "Shared line of text\nown line three\nshared LINE of text", "a"), (1, "  shared line of text \t\nx", "a"),
        (2, "short\nshort\nshared line of text", None), (5, None, "a"), (6, "", "a"), (None, "shared line of text", "a"),
        (8, long, "a"), (9, long + "\nand one more line here", "b"), (10, "ÄRGERLICHE ZEILE\nÄrgerliche zeile", "b"), (11, "ÄRGERLICHE zeile", "b"),
        (12, "\n\n\n", "c"), (13, "same text in one number", "c"), (13, "same text in one number", "c"), (13, "other text, same text in one number", "c"),
        *[(100 + k, "a line that a third of all hold\nown " + str(k) * 12, "h") for k in range(400)],
    ]
    import hashlib

    expected = sorted(str((d, n, gone, hashlib.sha256(t.encode()).hexdigest())) for d, n, gone, t in kept_lines([r[:2] for r in rows]))
    docs = documents(spark, rows)
    assert sorted(str(tuple(r)) for r in line_dedup.dedup_digest(docs).collect()) == expected
    kept = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    assert kept.columns == docs.columns and kept.count() == len(rows)
    texts = sorted(str((r.doc_id, r.text or "")) for r in kept.collect())
    assert texts == sorted(str((d, t)) for d, _, _, t in kept_lines([r[:2] for r in rows]))
    assert line_dedup.dedup_digest(docs.limit(0)).collect() == []


def test_lines_use_no_python(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    for frame in (line_dedup.dedup_digest(docs), mixing.mix(docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def near_rows():
    rng = random.Random(9)
    word = lambda: rng.choice("abcdefghij") + str(rng.randint(0, 400))
    base = [word() for _ in range(200)]
    rows = [(1, " ".join(base)), (2, " ".join(base).upper()), (3, None), (4, ""), (5, "one two"), (6, "One  two"), (7, "three four five")]
    for k in range(120):
        near = base[:]
        for _ in range(rng.randint(1, 9)):
            near[rng.randrange(200)] = word()
        rows.append((1000 - k, " ".join(near)))
    for k in range(60):
        passage = [f"p{j}" for j in range(60)]
        rows.append((2000 + k, " ".join([word() for _ in range(60)] + passage)))
    for k in range(40):
        short = [word() for _ in range(rng.randint(5, 14))]
        rows += [(3000 + 3 * k, " ".join(short)), (3001 + 3 * k, " ".join([*short, "end"])), (3002 + 3 * k, " ".join(short[:-1]))]
    chain = [word() for _ in range(300)]
    for k in range(12):
        chain = chain[8:] + [word() for _ in range(8)]
        rows.append((5000 - k, " ".join(chain)))
    rows.append((6000, "z " * 50_000))
    return rows


def test_near_duplicates_against_brute_force(spark):
    rows = near_rows()
    expected = near_components(dict(rows))
    docs = documents(spark, [(d, t, "a") for d, t in rows])
    found = near_dedup.near_duplicates(docs).collect()
    assert {r.doc_id: r.component_id for r in found} == expected
    assert {r.doc_id: r.n_shingles for r in found} == {d: len(shingle_set(t)) for d, t in rows}
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)
    kept = near_dedup.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for c in expected.values()})


def test_near_duplicate_cells_are_split(spark, monkeypatch):
    """With tiny cells and every bucket hot the classes are the same."""
    monkeypatch.setattr(near_dedup, "CELL", 4)
    monkeypatch.setattr(near_dedup, "PER_PARTITION", 500)
    rows = near_rows()
    found = near_dedup.near_duplicates(documents(spark, [(d, t, "a") for d, t in rows])).collect()
    assert {r.doc_id: r.component_id for r in found} == near_components(dict(rows))


@pytest.mark.parametrize("common, union, most", [(3, 4, 10), (6, 8, 10), (12, 16, 10), (15, 20, 12)])
def test_small_sets_share_a_band(common, union, most):
    """At the bar 5.2 in a million pairs share no band: in 200,000 pairs one is expected, hardly ever ten."""
    rng = np.random.default_rng(8)
    missed = 0
    for _ in range(20):
        pairs = np.sort(rng.integers(1, 2**64, (10_000, union), dtype=np.uint64), axis=1)
        less = np.sort(np.take_along_axis(pairs, np.argsort(rng.random(pairs.shape), axis=1)[:, :common], axis=1), axis=1)
        (a, in_a), (b, in_b) = (near_dedup._band_keys(_sketches(x), np.full(len(x), x.shape[1]), list(x)) for x in (pairs, less))
        missed += int((~((a == b) & in_a & in_b).any(axis=1)).sum())
    assert missed <= most


def _sketches(sets):
    # Sets of few runs have no bands of registers, so their sketches aren't read.
    return np.zeros((len(sets), near_dedup.REGISTERS), np.uint16) if sets.shape[1] <= near_dedup.SMALL else np.stack([near_dedup.registers(x) for x in sets])


def test_near_duplicate_edges(spark):
    rows = [(None, "a b c d e f", "x"), (None, "a b c d e f", "x"), (5, "a b c d e f", "x"), (5, "a b c d e f", "x"), (5, "g h i j k l", None), (9, "g h i j k l", "x")]
    found = near_dedup.near_duplicates(documents(spark, rows)).collect()
    assert sorted(str(r.component_id) for r in found) == ["5", "5", "5", "5", "None", "None"]
    assert near_dedup.near_duplicates(documents(spark, rows).limit(0)).collect() == []
    assert near_dedup.near_duplicates(documents(spark, [(1, None, "x"), (2, "", "x")])).count() == 2


def test_estimates_follow_similarity():
    rng = np.random.default_rng(2)
    for share in (0.3, 0.6, 0.9):
        pairs = []
        for _ in range(300):
            common = rng.integers(0, 2**63, int(2000 * share)).astype(np.uint64) * np.uint64(2)
            a, b = (np.unique(np.concatenate([common, rng.integers(0, 2**63, 2000 - len(common)).astype(np.uint64) * np.uint64(2)])) for _ in range(2))
            pairs.append((near_dedup.registers(a), near_dedup.registers(b)))
        a, b = (np.array(x) for x in zip(*pairs))
        n = np.full(300, 2000.0)
        close, used = near_dedup.estimate(a, b, n, n)
        assert abs(close.mean() - share / (2 - share)) < 0.02 and used.min() > 100


@pytest.mark.parametrize("options", [{"target_entropy": 0.95}, {"target_entropy": 0.8}, {"target_entropy": None, "max_repeats": 2.0, "whole": True}, {"target_entropy": None, "max_repeats": 3.0, "whole": True, "block_tokens": 300}])
def test_mixing_against_brute_force(spark, options):
    rng = random.Random(4)
    sources = ["big"] * 60 + ["mid"] * 20 + ["tiny"] * 4 + [None] * 6
    rows = [(k, " ".join(["w"] * rng.randint(0, 30)) or None, s) for k, s in enumerate(sources)]
    found = {(r.doc_id, r.source, r.epoch): (r.block, r.place) for r in mixing.mix(documents(spark, rows), **options).collect()}
    if None in sources:
        expected = mixture([(d, "-" if s is None else s, t) for d, t, s in rows], **options)
        expected = {(d, None if s == "-" else s, e): x for (d, s, e), x in expected.items()}
    assert {k: v[0] for k, v in found.items()} == {k: v[0] for k, v in expected.items()}
    for block in {b for b, _ in found.values()}:
        assert sorted(p for b, p in found.values() if b == block) == list(range(1, sum(b == block for b, _ in found.values()) + 1))


def test_mixing_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    mixed = mixing.mix(docs, target_entropy=None, max_repeats=2.0, whole=True)
    copies = mixed.groupBy("doc_id").count()
    assert copies.count() == docs.count() and copies.agg(F.max("count")).first()[0] <= 2
    applied = mixing.apply_mix(docs, mixed)
    assert applied.columns == docs.columns and applied.count() == mixed.count()
    small = mixing.mix(docs.withColumn("source", F.when(F.col("doc_id") % 3 == 0, "hot").otherwise(F.col("source"))), 0.95)
    per_source = [r.n for r in small.groupBy("source").agg(F.sum("n_tokens").alias("n")).collect()]
    shares = np.array(per_source) / sum(per_source)
    assert -(shares * np.log(shares)).sum() >= 0.945 * np.log(len(shares))


def test_applied_mixture_has_its_order(spark, tmp_path):
    """Rows, and the files written of them, follow block and place; a document read twice stands in two places."""
    rng = random.Random(6)
    rows = [(k, " ".join(["w"] * rng.randint(1, 30)), "tiny" if k % 9 == 0 else "big") for k in range(300)]
    docs = documents(spark, rows).repartition(5)
    mixture_of = mixing.mix(docs, target_entropy=None, max_repeats=3.0, whole=True, block_tokens=500).collect()
    expected = [r.doc_id for r in sorted(mixture_of, key=lambda r: (r.block, r.place))]
    assert len({r.block for r in mixture_of}) > 5 and len(expected) > 300
    applied = mixing.apply_mix(docs, mixing.mix(docs, target_entropy=None, max_repeats=3.0, whole=True, block_tokens=500))
    assert [r.doc_id for r in applied.collect()] == expected
    applied.write.parquet(str(tmp_path / "mixed"))
    files = sorted((tmp_path / "mixed").glob("part-*.parquet"))
    assert [d for f in files for d in pq.read_table(f).column("doc_id").to_pylist()] == expected


def test_mixing_edges(spark):
    docs = documents(spark, [(1, None, "a"), (1, None, "a"), (None, "x y", None), (2, "", "b")])
    found = mixing.mix(docs, target_entropy=None, max_repeats=1.0, whole=True).collect()
    assert sorted((str(r.doc_id), str(r.source)) for r in found) == [("1", "a"), ("2", "b"), ("None", "None")]
    assert mixing.mix(docs.limit(0)).collect() == []


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    judged = {r.doc_id: r.predicted for r in quality_qda.classify(docs, labels).collect()}
    rows = sorted((r.doc_id, r.text, r.source) for r in docs.collect() if judged[r.doc_id])
    texts = {d: t for d, _, _, t in kept_lines([r[:2] for r in rows])}
    classes = near_components(texts)
    left = [(d, s, texts[d]) for d, _, s in rows if classes[d] == d]
    mixed = mixture(left, max_repeats=corpus_pipeline.MAX_REPEATS, whole=True)
    library = Tokenizer.from_file(WORD_BPE)
    expected = sorted((d, s, library.encode(texts[d], add_special_tokens=False).ids) for d, s, _ in mixed)
    found = corpus_pipeline.run(spark, FOLDER).collect()
    assert sorted((r.doc_id, r.source, list(struct.unpack(f"<{r.n_tokens}I", r.token_ids))) for r in found) == expected


def test_stages_keep_the_columns(spark):
    docs = documents(spark, [(1, "a b c d e f g", "s"), (None, None, None), (3, "", "s"), (3, "", "s"), (4, "x " * 30_000, "t")])
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    encoded = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
    assert sorted(r.n_tokens for r in encoded.collect())[:3] == [0, 0, 0]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES[:-1]])
def test_stages_take_inner_names_and_integer_ids(spark, stage):
    """Extra columns named as the operators name their own, and ids of 32 bits: the same rows as without."""
    rows = [(k, f"word{k % 7} some text that goes on and on for document {k % 9}\nshared line of text", "st"[k % 2]) for k in range(40)]
    inner = ["_doc", "_hash", "_keep", "_src", "_block", "_place", "_row", "_text", "stats", "bucket", "set_id", "epoch"]
    plain = documents(spark, rows)
    wide = plain.withColumn("doc_id", F.col("doc_id").cast("int")).withColumns({name: F.lit("x") for name in inner})
    run = dict(corpus_pipeline.STAGES)[stage]
    found = run(spark, wide, FOLDER)
    assert found.columns == wide.columns
    assert sorted(map(tuple, found.select(*plain.columns).collect())) == sorted(map(tuple, run(spark, plain, FOLDER).collect()))
