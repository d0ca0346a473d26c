"""Whitening, collocations and packing: operators that need the whole table before any row."""

import math
import random
import re
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from brute import ASCII_LOWER
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from mainstay.llm import packing, phrases, whitening
from mainstay.llm.registry import WORD_BPE, Q

FOLDER = "/root/testdata/sf0.001"
VECTORS = "vec_id long, embedding array<double>, x string, _key string, component string"


# Whitening

def vectors(spark, rows):
    table = [(k, v, "x", "k", "c") for k, v in rows]
    return spark.createDataFrame(table, VECTORS).repartition(3)


def plain_whitening(rows):
    """(vec_id, x) of the vectors that take part, and the exact covariance of the distinct ones."""
    usable = [
        (k, tuple(math.floor(256 * c) for c in v)) for k, v in rows
        if v and all(c is not None and math.isfinite(c) for c in v)
    ]
    fit = sorted({x for _, x in usable})
    n, sums = len(fit), [sum(column) for column in zip(*fit, strict=True)]
    apart = [[n * c - s for c, s in zip(x, sums, strict=True)] for x in fit]
    size = len(sums)
    cov = [[Fraction(sum(a[i] * a[j] for a in apart), n**3) for j in range(size)] for i in range(size)]
    return usable, n, sums, cov


def check_whitening(result, rows):
    usable, n, sums, cov = plain_whitening(rows)
    dense = np.array([[float(c) for c in row] for row in cov])
    values, axes = np.linalg.eigh(dense)
    values, axes = values[::-1], axes[:, ::-1]
    by_component = defaultdict(list)
    for row in result:
        by_component[row.component].append(row)
    assert sorted(by_component) == list(range(1, min(4, len(sums)) + 1))
    trace = float(sum(cov[i][i] for i in range(len(sums))))
    for number, found in by_component.items():
        assert sorted(str(r.vec_id) for r in found) == sorted(str(k) for k, _ in usable)
        value, axis = values[number - 1], axes[:, number - 1]
        expected = {}
        for k, x in usable:
            expected.setdefault(k, set()).add(sum((n * c - s) ** 2 for c, s in zip(x, sums, strict=True)))
        assert all(r.n == n and r.deviation in expected[r.vec_id] for r in found)
        assert all(math.isclose(r.explained, value / trace, rel_tol=1e-9) for r in found)
        assert all(r.identity_error < 1e-9 for r in found)
        # One sign for all rows.
        by_id = {k: (np.array(x, float) - np.array(sums, float) / n) @ axis / math.sqrt(value) for k, x in usable}
        ends = [max(abs(r.whitened - sign * by_id[r.vec_id]) for r in found) for sign in (1, -1)]
        assert min(ends) < 1e-8


def test_whitening_against_plain_arithmetic(spark):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(7, 7))
    rows = [(k, [float(c) for c in v]) for k, v in enumerate(rng.normal(size=(300, 7)) @ mix + 1000.0)]
    rows += [(1000 + k, rows[7][1]) for k in range(200)]
    odd = [(1, None), (2, []), (3, [1.0] * 6 + [None]), (4, [1.0] * 6 + [math.nan]), (5, [1.0] * 6 + [math.inf])]
    result = whitening.whitened_vectors(vectors(spark, rows + odd))
    assert result.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check_whitening(result.collect(), rows)


def test_whitening_of_the_test_vectors(spark):
    table = spark.read.parquet(f"{FOLDER}/embeddings.parquet")
    rows = [(r.vec_id, None if r.embedding is None else [float(c) for c in r.embedding]) for r in table.collect()]
    check_whitening(Q["op11_whitening"](spark, FOLDER).collect(), rows)


def test_whitening_edges(spark):
    assert whitening.whitened_vectors(vectors(spark, [])).count() == 0
    assert whitening.whitened_vectors(vectors(spark, [(1, None), (2, [])])).count() == 0
    # One vector only, and a null number: no variance.
    for row in whitening.whitened_vectors(vectors(spark, [(None, [1.0, 2.0]), (2, [1.0, 2.0])])).collect():
        assert (row.n, row.deviation, row.whitened, row.explained, row.identity_error) == (1, 0, None, 0.0, None)
    # The length that most different vectors have decides, here two.
    rows = [(1, [1.0, 2.0]), (2, [2.0, 5.0]), (3, [1.0, 2.0, 3.0]), (4, [0.0, 1.0])]
    found = whitening.whitened_vectors(vectors(spark, rows)).collect()
    assert {r.vec_id for r in found} == {1, 2, 4} and {r.component for r in found} == {1, 2}
    # Entries near the end of 64 bits: sums and products stay exact, distances beyond 64 bits are null.
    big = [(k, [c * 2.0**50, 1.0 * k]) for k, c in enumerate((1, -3, 5, 7))] + [(9, [2.0**60, 1.0])]
    found = whitening.whitened_vectors(vectors(spark, big)).collect()
    assert {r.vec_id for r in found} == {0, 1, 2, 3} and {r.deviation for r in found} == {None}
    assert max(r.identity_error for r in found) < 1e-9


@pytest.mark.parametrize("values", [
    [5, 5, 5, 3, 1, 1e-3], [1, 1 + 1e-9, 1 - 1e-9, 0.5, 0.5, 1e-8], [1.0] * 5, list(np.linspace(1, 2, 40)), [1e12, 1, 1e-6],
])
def test_eigenvectors_of_clusters(values):
    rng = np.random.default_rng(1)
    size = len(values)
    basis = np.linalg.qr(rng.normal(size=(size, size)))[0].astype(np.longdouble)
    for _ in range(3):
        basis = basis @ (1.5 * np.eye(size) - 0.5 * basis.T @ basis)
    matrix = basis @ np.diag(np.array(values, np.longdouble)) @ basis.T
    matrix = (matrix + matrix.T) / 2
    found, axes = whitening.eigen(matrix)
    wide = axes.astype(np.longdouble)
    assert np.abs(found - np.sort(values)[::-1]).max() <= 4e-16 * max(values)
    assert np.abs(wide.T @ wide - np.eye(size)).max() < 1e-15
    assert np.abs(matrix @ wide - wide * found).max() < 1e-15 * max(values)
    # Separate values have the vectors they were made with.
    order = np.argsort(values)[::-1]
    for place, k in enumerate(order):
        if min([abs(values[k] - v) for j, v in enumerate(values) if j != k], default=1) > 1e-2:
            assert abs(abs(basis[:, k] @ wide[:, place]) - 1) < 1e-14


# Collocations

def plain_phrases(rows, support, longest, top, covered=50):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(ASCII_LOWER)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang or "und"] += len(words)
            for size in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= support}
        scored = []
        for phrase, a in frequent.items():
            longer = [
                b for p, b in frequent.items()
                if len(p) > len(phrase) and any(p[i:i + len(phrase)] == phrase for i in range(len(p)))
            ]
            if any(100 * b >= covered * a for b in longer):
                continue
            cuts = [(10**6 * a * a // (f[phrase[:k]] * f[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            scored.append((-score, -a, " ".join(phrase).encode(), f[phrase[:k]], f[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def phrase_rows(seed=4, count=400):
    rng = random.Random(seed)
    words = ["A", "b", "ÉÄ", "x\x00", "kin", "漢", "to", "be", "or", "not"]
    ends = [" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\x0c", "\x1c "]
    texts = ["".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 60))) for _ in range(count)]
    rows = [(rng.choice(["en", "de", None, "a b"]), t) for t in texts]
    return rows + [("en", "to be or not")] * 300 + [("en", None), ("en", ""), ("xx", "one two"), ("en", "a " * 4000)]


def phrase_table(spark, rows, parts=5):
    table = [(k, t, lang, "p", 1, 2) for k, (lang, t) in enumerate(rows)]
    return spark.createDataFrame(table, "doc_id long, text string, lang string, phrase string, a int, _first int").repartition(parts)


@pytest.mark.parametrize("longest, support, shards, parts", [(3, 10, 3, 5), (3, 10, 8, 20), (4, 6, 2, 3), (2, 4, 1, 4)])
def test_phrases_against_brute_force(spark, longest, support, shards, parts):
    rows = phrase_rows()
    found = phrases.collocations(phrase_table(spark, rows, parts), support=support, longest=longest, top=40, shards=shards)
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, found.collect())) == plain_phrases(rows, support, longest, 40)


def test_phrases_of_long_texts_and_full_filters(spark, monkeypatch):
    """Texts are cut into stretches with context, filters let everything through: nothing changes."""
    rows = phrase_rows(9, 60)
    texts = [("en", " ".join(t or "" for _, t in rows)), ("de", "x" * 500), ("de", "go on and on " * 50)]
    batches = spark.createDataFrame(texts, "lang string, text string").toArrow().to_batches()
    monkeypatch.setattr(phrases, "HELD", 64)
    for size in (1, 2, 3):
        expected = Counter()
        for lang, text in texts:
            for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text.translate(ASCII_LOWER)):
                words = [w for w in re.split("[ \t]+", piece) if w]
                expected.update((lang, " ".join(words[i:i + size])) for i in range(len(words) - size + 1))
        found = Counter()
        for tokens in phrases._stretches(iter(batches), 3):
            _, words, n = tokens.counted(tokens.starts(tokens.inside(size), size), size)
            found.update({(tokens.lang, w): int(k) for w, k in zip(words.to_pylist(), n, strict=True)})
        assert found == expected
    monkeypatch.setattr(phrases, "phrase_filter", lambda known: b"\xff" * (phrases.FILTER_BITS // 8))
    wide = phrases.collocations(phrase_table(spark, phrase_rows()), support=10, top=40)
    assert sorted(map(tuple, wide.collect())) == plain_phrases(phrase_rows(), 10, 3, 40)


def test_filter_knows_its_phrases(spark):
    rows = [("en", "a b"), ("de", "a b"), ("en", "c"), ("xx", "d e f")]

    def hash_of(lang, *words):
        return phrases._mixed([phrases._word_hashes(lang, [w.encode()]) for w in words])

    hashes = [(int(hash_of(lang, *phrase.split(" ")).view(np.int64)[0]),) for lang, phrase in rows]
    bits = phrases.phrase_filter(spark.createDataFrame(hashes, "hash long").repartition(2))

    class Packed:
        value = bits

    known = phrases._Filter(Packed)

    def passes(lang, *words):
        return bool(known.passes(hash_of(lang, *words))[0])

    assert all(passes(lang, *phrase.split(" ")) for lang, phrase in rows)
    assert not any(passes("en", *p.split(" ")) for p in ("b a", "a", "d e f", "a b c"))


def test_proposals_add_up_equal_hashes():
    held = [np.array([7, 2**63 + 1, 7], np.uint64), np.array([], np.uint64), np.array([2**63 + 1], np.uint64)]
    rows = [row for batch in phrases._proposals(phrases.LOCAL, held) for row in batch.to_pylist()]
    assert rows == [
        {"code": phrases.LOCAL, "hash": 7, "key": None, "n": 2}, {"code": phrases.LOCAL, "hash": 1 - 2**63, "key": None, "n": 2},
    ]


def test_starts_of_proposals_keep_to_pieces():
    """Neighbouring known parts make a proposal, not those of two pieces or of the context alone."""
    class All:
        def passes(self, hashes):
            return np.ones(len(hashes), bool)

    tokens = phrases._Tokens("en", b"a b c\nd e", 2)
    for size, expected in ((1, [1, 4]), (2, [0])):
        passing = tokens.passing(size, All())
        assert tokens.starts(passing[:-1] & passing[1:], size + 1).tolist() == expected


def test_phrase_edges(spark):
    assert phrases.collocations(phrase_table(spark, [])).count() == 0
    assert phrases.collocations(phrase_table(spark, [("en", "only once here"), (None, None)])).count() == 0


# Packing

def plain_sequences(lengths, limit):
    """How many sequences best fit opens, longest pieces first."""
    rooms = []
    for length in sorted(lengths, reverse=True):
        fitting = [(room, at) for at, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting)[1]] -= length
        else:
            rooms.append(limit - length)
    return len(rooms)


@pytest.mark.parametrize("seed", range(40))
def test_plan_is_best_fit(seed):
    rng = random.Random(seed)
    limit = rng.choice([5, 16, 50, 100])
    lengths = [min(limit, int(rng.expovariate(0.1)) + 1 if seed % 2 else rng.randint(1, limit)) for _ in range(rng.randint(1, 300))]
    counts = Counter(lengths)
    rows = packing.plan(dict(counts), limit)
    assert len(rows) <= 3 * limit * (math.log2(limit) + 1)
    fills = defaultdict(list)
    for length, count in counts.items():
        own = rows[rows[:, 0] == length]
        for rank in range(count):
            _, first, sequence, each, offset = own[np.searchsorted(own[:, 1], rank, side="right") - 1].tolist()
            fills[sequence + (rank - first) // each].append((offset + (rank - first) % each * length, length))
    assert sorted(fills) == list(range(plain_sequences(lengths, limit)))
    assert all(gapless(places) <= limit for places in fills.values())


def gapless(places):
    end = 0
    for offset, length in sorted(places):
        assert offset == end
        end += length
    return end


def check_packing(rows, texts, limit):
    """Pieces are the library's ids, cut; sequences are gapless and as many as plain best fit opens."""
    library = Tokenizer.from_file(WORD_BPE)
    expected = Counter()
    for number, text in texts:
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        for piece, start in enumerate(range(0, len(ids), limit)):
            part = ids[start:start + limit]
            expected[number, piece, start, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    fills = defaultdict(list)
    for r in rows:
        fills[r.sequence_id].append((r.offset, r.length))
    assert all(gapless(places) <= limit for places in fills.values())
    assert len(fills) == plain_sequences([r.length for r in rows], limit)


def text_table(spark, texts):
    rows = [(k, t, "l", 1, 2, 3) for k, t in texts]
    return spark.createDataFrame(rows, "doc_id int, text string, length string, rank int, _file int, ids int").repartition(4)


def test_packing_odd_texts(spark):
    odd = [None, "", " ", "a", "<|endoftext|>x <|endoftext", "İstanbul ΣΑΣ ﬁ", "漢字 テスト　x", "a\x00b\x1c\x1d \x85y\xa0z", "z" * 9000]
    texts = [(k, t) for k, t in enumerate(odd)] + [(None, "null number"), (7, "lorem ipsum dolor \n" * 9000)]
    texts += [(99, "the same row")] * 200
    found = packing.pack(text_table(spark, texts), WORD_BPE)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check_packing(found.collect(), texts, packing.LIMIT)


def test_packing_with_small_memory(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_BITS", 2)
    texts = [(k, "w " * (k % 37)) for k in range(700)]
    rows = packing.pack(text_table(spark, texts), WORD_BPE, limit=16, with_ids=True).collect()
    check_packing(rows, texts, 16)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)
    words = packing.WordIds(WORD_BPE)
    monkeypatch.setattr(packing, "HELD", 2000)
    small = packing.WordIds(WORD_BPE)
    text = " ".join(f"word{k % 90} x{k}!" for k in range(500))
    assert small.text_ids(text) == words.text_ids(text) and small.held <= 2400


def test_packing_of_the_test_documents(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    check_packing(Q["op13_packing"](spark, FOLDER).collect(), [(r.doc_id, r.text) for r in table.collect()], 4096)


def test_packing_edges(spark):
    assert packing.pack(text_table(spark, []), WORD_BPE).count() == 0
    assert packing.pack(text_table(spark, [(1, None)]), WORD_BPE, end_id=None).count() == 0
    assert [r.length for r in packing.pack(text_table(spark, [(1, None)]).withColumn("k", F.col("doc_id")), WORD_BPE).collect()] == [1]
