"""Clustering, packing and hard negatives against brute-force versions, and their edge cases."""

import hashlib
import itertools
import math
import random
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tapewright.llm import hard_negatives
from tapewright.llm.centroid_clustering import Bounds, cluster_vectors, squared
from tapewright.llm.hard_negatives import mine_hard_negatives
from tapewright.llm.packing import _Words, content_keys, cuts, hilbert_keys, pack_documents

WORDS = public_tokenizers.path("word_bpe_49k.json")


def whole(vector, scale=256):
    return [math.floor(scale * float(x)) for x in vector]


def plain_clusters(rows, k, rounds, dims):
    """Full scans in Python integers; rows: (id, vector)."""
    kept = [(i, whole(v)) for i, v in rows if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"2:{i}".encode()).hexdigest()
    centroids = [x for _, x in sorted(((digest(i), np.array(x, "<i8").tobytes()), x) for i, x in kept if i is not None)][:k]
    apart = lambda a, b: sum((p - q) ** 2 for p, q in zip(a, b))
    near = lambda x: min((apart(x, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        of = defaultdict(list)
        for _, x in kept:
            of[near(x)[1]].append(x)
        centroids = [[sum(col) // len(of[j]) for col in zip(*of[j])] if of[j] else c for j, c in enumerate(centroids)]
    return sorted(((str(i), j, d) for i, x in kept for d, j in [near(x)])), centroids


@pytest.mark.parametrize("k, grid", [(3, 2), (12, 3), (40, 1)])
def test_clusters_equal_full_scans(spark, k, grid):
    """On a coarse grid many distances tie, and with few values many rows are equal."""
    rng = random.Random(k)
    rows = [(i, [rng.randint(-grid, grid) / 4 + rng.choice([0, 0, 0.01]) for _ in range(3)]) for i in range(400)]
    rows += [(400, None), (401, [1.0, 2.0]), (402, [1.0, None, 2.0]), (403, [1.0, math.nan, 2.0]), (404, [1.0, math.inf, 2.0]), (None, [0.1, 0.2, 0.3]), (7, [9.0, 9.0, 9.0]), (8, rows[8][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("cluster", F.lit("x")).withColumn("id", F.lit(None).cast("int"))
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    placed, centroids = cluster_vectors(df, k=k, rounds=4, dims=3)
    want, last = plain_clusters(rows, k, 4, 3)
    assert sorted((str(r.vec_id), r.cluster, r.distance) for r in placed.collect()) == want
    sums = {j: [d for _, c, d in want if c == j] for j in range(len(last))}
    assert sorted((r.cluster, list(r.centroid), r.size, r.inertia) for r in centroids.collect()) == [(j, c, len(sums[j]), sum(sums[j])) for j, c in enumerate(last)]


def test_clusters_of_few_and_no_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert [df.collect() for df in cluster_vectors(none)] == [[], []]
    two = spark.createDataFrame([(1, [1.0] * 64), (2, [2.0] * 64)], "vec_id long, embedding array<float>")
    placed, centroids = cluster_vectors(two)
    assert sorted(r.distance for r in placed.collect()) == [0, 0] and centroids.count() == 2
    with pytest.raises(Exception, match="64 bits"):
        cluster_vectors(spark.createDataFrame([(1, [1e12] * 64), (2, [-1e12] * 64)], "vec_id long, embedding array<float>"))


def test_bounds_hold_and_save_scans(monkeypatch):
    """Bounds never exceed the truth, and most vectors keep their centroid without a scan of all."""
    rng = np.random.default_rng(3)
    c = rng.integers(-200, 200, (40, 8))
    x = c[rng.integers(0, 40, 3000)] + rng.integers(-30, 30, (3000, 8))
    state = Bounds.scanned(x, c, 10)
    full = Bounds.scanned.__func__
    monkeypatch.setattr(Bounds, "scanned", classmethod(lambda cls, a, b, n: (scanned.append(len(a)), full(cls, a, b, n))[1]))
    scanned: list[int] = []
    for _ in range(6):
        step = rng.integers(-9, 10, c.shape)
        c = c + step
        state = state.shrunk(min(state.near.shape[1], 8)).moved(np.sqrt((step**2).sum(axis=1)) * (1 + 1e-12))
        state, depth = state.assigned(x, c)
        d = squared(x, c)
        assert (state.cluster == d.argmin(axis=1)).all() and (depth <= state.near.shape[1]).all()
        root = np.sqrt(d)
        assert (state.upper >= root.min(axis=1)).all()
        assert (state.lower[:, :-1] <= np.take_along_axis(root, state.near, axis=1)).all()
        rest = root.copy()
        np.put_along_axis(rest, state.near, np.inf, axis=1)
        rest[np.arange(len(x)), state.cluster] = np.inf
        assert (state.lower[:, -1] <= rest.min(axis=1)).all()
    assert sum(scanned) < 0.2 * 6 * len(x)


def plain_negatives(rows):
    kept = [(i, label, whole(v)) for i, label, v in rows if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    score = lambda a, b: sum(p * q for p, q in zip(a, b))
    out = []
    for a, label, v in kept:
        if a % 50:
            continue
        scored = sorted((-score(v, w), i, l == label) for i, l, w in kept if i != a)
        for s, p, _ in [x for x in scored if x[2]][:5]:
            fit = [(i, -t) for t, i, same in scored if not same and 50 * -s <= 100 * -t <= 95 * -s][:3]
            out += [(a, p, r, i, -s, t) for r, (i, t) in enumerate(fit, 1)]
    return sorted(out)


@pytest.mark.parametrize("block", [2048, 7])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, block):
    """Few values make many ties; one label holds a third of the rows; vectors of several sizes, odd rows, repeated ids."""
    monkeypatch.setattr(hard_negatives, "ROWS", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", min(block, 128))
    rng = random.Random(block)
    rows = [(i, rng.choice([0, 0, 1, 2, 3, 4]), [rng.randint(-2, 4) / 8 for _ in range(4)]) for i in range(0, 600, 3)]
    rows += [(50, 1, [0.5, 0.5]), (100, 0, []), (150, None, [0.1] * 4), (None, 1, [0.1] * 4), (200, 1, None), (250, 1, [0.1, None]), (300, 2, [math.nan] * 4), (301, 1, [math.inf] * 4)]
    rows += [rows[0], rows[50], (rows[50][0], 3, [0.5] * 4), (-50, 2, [-0.5] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("id", F.lit("x")).withColumn("anchor", F.lit(1)).withColumn("block", F.lit(2.0))
    rows = [(r.vec_id, r.label, r.embedding) for r in df.collect()]
    assert sorted(map(tuple, mine_hard_negatives(df).collect())) == plain_negatives(rows)


def test_hard_negatives_edges(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert mine_hard_negatives(none).collect() == []
    assert mine_hard_negatives(spark.createDataFrame([(50, 1, [1.0])], none.schema)).collect() == []
    big = spark.createDataFrame([(50, 1, [1e15]), (51, 1, [1e15])], none.schema)
    with pytest.raises(Exception, match="64 bits"):
        mine_hard_negatives(big).collect()


def test_hilbert_curve():
    """On a whole grid the keys are a permutation, and cells that follow each other differ by one step."""
    for dims, bits in ((2, 4), (3, 3), (4, 2)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        keys = hilbert_keys(cells, bits)
        assert sorted(keys.tolist()) == list(range(len(cells)))
        walk = cells[np.argsort(keys)]
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_cuts():
    for total, length in ((0, 8), (1, 8), (23, 8), (24, 8), (31, 8), (15, 6)):
        for step in (1, 5, 40):
            got = [p for a in range(0, total, step) for p in cuts(a, min(step, total - a), total, length)]
            filled = defaultdict(list)
            for sequence, offset, size in got:
                filled[sequence].append((offset, size))
            sizes = []
            for sequence in range(len(filled)):
                at = 0
                for offset, size in filled[sequence]:
                    assert offset == at and size > 0
                    at += size
                sizes.append(at)
            assert sum(sizes) == total and all(s == length or s & (s - 1) == 0 for s in sizes)
            assert sizes[: total // length] == [length] * (total // length)


ODD = ["<|ENDOFTEXT|> A.b:C!! don'T.x e.́ H̱ x̱ supercalifragilisticexpialidocious;AND", "<|endoftext|> and <|startoftext|>x<|endoftext|>", "it's ISN'T we'll  é é ́x İi ǅ ß", "a b c　d\u0085e", "日本語 テキスト\ttab\x0bv\x0cf\rr\x1cs", "  ", "̸ \n̸=", "12345 1a2b", "😀👍🏽 ‍ x"]


def test_words_encode_as_whole_texts(corpus):
    import pyarrow as pa

    texts = [t for _, t in corpus if t] + ODD + [" ".join(ODD)]
    coder, whole_ = _Words(WORDS), Tokenizer.from_file(WORDS)
    for _ in range(2):  # the second time all words are known
        ids, bounds = coder.encode(pa.array(texts))
        for k, t in enumerate(texts):
            assert ids[bounds[k] : bounds[k + 1]].tolist() == whole_.encode(t, add_special_tokens=False).ids


def test_words_that_share_a_hash(monkeypatch, corpus):
    import pyarrow as pa

    from tapewright.llm import packing

    monkeypatch.setattr(packing, "mix64", lambda x: x & np.uint64(3))
    texts = [t for _, t in corpus if t]
    coder, whole_ = _Words(WORDS), Tokenizer.from_file(WORDS)
    ids, bounds = coder.encode(pa.array(texts))
    assert all(ids[bounds[k] : bounds[k + 1]].tolist() == whole_.encode(t, add_special_tokens=False).ids for k, t in enumerate(texts))


def test_packing_places_each_token_once(spark, corpus):
    texts = [(i, t) for i, t in corpus] + [(500 + k, t) for k, t in enumerate(ODD)] + [(None, "a null id"), (None, None), (3, "an id again"), (600, " ".join(f"word{k}" for k in range(9000)))]
    docs = spark.createDataFrame(texts, "doc_id long, text string").withColumn("ids", F.lit("x")).withColumn("key", F.lit(1)).withColumn("part", F.lit(2))
    coder = Tokenizer.from_file(WORDS)
    want = sorted((str(i), [*coder.encode(t or "", add_special_tokens=False).ids, 2]) for i, t in texts)
    pieces = pack_documents(docs, WORDS, length=512).collect()
    sequences = defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4").tolist()
        assert len(ids) == p.length > 0
        sequences[p.sequence_id].append((p.offset, ids, p))
    line, sizes = [], []
    for number in range(len(sequences)):
        at = 0
        for offset, ids, p in sorted(sequences[number], key=lambda x: x[0]):
            assert offset == at
            at += len(ids)
            line.append((p, ids))
        sizes.append(at)
    full = sum(map(len, (x for _, x in want))) // 512
    assert sizes[:full] == [512] * full and all(s & (s - 1) == 0 for s in sizes[full:])  # no padding at all
    got, held = [], []
    for p, ids in line:  # a document's pieces follow each other along the line
        assert p.start == len(held)
        held = held + ids
        if len(held) == p.doc_tokens:
            got.append((str(p.doc_id), held))
            held = []
    assert not held and sorted(got) == want
    assert pack_documents(docs.limit(0), WORDS).collect() == []


def test_neighbours_are_alike():
    """Documents of one vocabulary come together on the curve."""
    rng = np.random.default_rng(5)
    topics = [rng.integers(0, 49000, 60) for _ in range(6)]
    of = rng.integers(0, 6, 300)
    docs = [rng.choice(topics[t], 200) for t in of]
    keys = content_keys(np.concatenate(docs), np.arange(301) * 200)
    walk = of[np.argsort(keys, kind="stable")]
    assert (walk[1:] == walk[:-1]).mean() > 0.5  # by chance one in six
