"""Operators 3, 4, 8 and 9: brute force, held-out accuracy, recall."""
import math
import random
import re
import tracemalloc
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from newsmetrics.llm import boosted, lattice, permutation_index, quality, toxicity

from .test_pairs import LOW, WORD


def brute_lattice(word, weight, byte_weight):
    """Sum over all segmentations, path by path."""
    def paths(at):
        if at == len(word):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in weight:
                total += math.exp(weight[word[at:end]]) * paths(end)
        if word[at] not in weight:
            total += math.exp(sum(byte_weight[b] for b in word[at].encode())) * paths(at + 1)
        return total
    return math.log(paths(0))


@pytest.fixture(scope="module")
def small_lattice():
    names = ["▁", "a", "b", "c", "ab", "bc", "▁a", "abc", "cab", "é", "bé"] + [""] * 256
    rng = np.random.default_rng(1)
    weight = np.log(rng.dirichlet(np.ones(len(names))) + 1e-9)
    return names, weight, lattice.Lattice(lattice.Pieces(names, list(range(11, 267))), weight)


def test_lattice_sums_all_segmentations(small_lattice):
    names, weight, made = small_lattice
    table = {n: w for n, w in zip(names, weight) if n}
    byte = list(weight[11:])
    words = ["a", "abc", "abcabc", "cabébc", "zé", "b" * 12, "x中a", "cab"]
    got = made.log_probability([w.encode() for w in words])
    assert np.allclose(got, [brute_lattice("▁" + w, table, byte) for w in words])
    assert made.log_probability([]).shape == (0,)


def test_long_words_like_short_ones(small_lattice, monkeypatch):
    names, weight, made = small_lattice
    rng = np.random.default_rng(3)
    words = ["".join(rng.choice(list("abcxé日"), n)).encode() for n in (5, 17, 40, 41, 90)]
    times = np.array([1.0, 2, 3, 1, 5])
    want, uses = made.log_probability(words), made.expected(words, times)
    for chunk in (3, 7, 64):
        monkeypatch.setattr(lattice, "LONG", 10)
        monkeypatch.setattr(lattice, "CHUNK", chunk)
        assert np.allclose(made.log_probability(words), want)
        assert np.allclose(made.expected(words, times), uses)


def test_a_word_of_a_million_letters_takes_seconds():
    import time
    names, byte_at, log_weight = lattice.first_weights(lattice.default_vocabulary())
    made = lattice.Lattice(lattice.Pieces(names, byte_at), log_weight)
    word = ("thequickbrownfoxjumps" * 48_000)[:1_000_000].encode()
    start = time.perf_counter()
    one = made.log_probability([word])[0]
    assert time.perf_counter() - start < 60
    half = made.log_probability([word[:500_000]])[0]
    assert np.isfinite(one) and abs(one / half - 2) < 0.001
    uses = made.expected([word[:50_000]], np.array([1.0]))
    assert np.isfinite(uses).all() and 5_000 < uses.sum() < 50_000


def test_expected_uses_are_the_gradient(small_lattice):
    names, weight, made = small_lattice
    words, times = [b"abcab", "bé中".encode(), b"cabc"], np.array([2.0, 1.0, 3.0])
    uses = made.expected(words, times)
    for k in (1, 4, 7, 8, 11 + 0xE4):
        moved = weight.copy()
        moved[k] += 1e-6
        rise = (lattice.Lattice(made.pieces, moved).log_probability(words) - made.log_probability(words)) @ times
        assert abs(rise / 1e-6 - uses[k]) < 1e-3


def check_base(rows, got):
    tokens = [(d, WORD.findall((t or "").translate(LOW))) for d, t in rows]
    train = [(d, w) for d, w in tokens if zlib.crc32(b"" if d is None else str(d).encode()) % 10]
    count = Counter(x for _, w in train for x in w)
    total = sum(count.values()) + len(train)
    bottom = total + 0.1 * (len(count) + (len(train) > 0) + 1)
    by = {(r["doc_id"], r["n_tokens"]): r for r in got}
    for d, w in tokens:
        r = by[d, len(w) + 1]
        base = sum(math.log10((count[x] + 0.1) / bottom) for x in w) + math.log10((len(train) + 0.1) / bottom)
        assert r["n_known"] == sum(count[x] > 0 for x in w) + (len(train) > 0)
        assert r["train_tokens"] == total and math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert r["held_out"] == (zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0)
        assert r["score"] < 0 and math.isfinite(r["score"])


def test_scores_of_documents(sf_docs):
    rows = [(r["doc_id"], r["text"]) for r in sf_docs.collect()]
    got = lattice.score_documents(sf_docs, lattice.default_vocabulary()).collect()
    assert len(got) == len(rows)
    check_base(rows, got)


def test_scores_of_odd_rows(odd_docs, make_docs):
    got = lattice.score_documents(odd_docs, lattice.default_vocabulary()).collect()
    check_base([(r["doc_id"], r["text"]) for r in odd_docs.collect()], got)
    assert len(got) == odd_docs.count()
    assert lattice.score_documents(make_docs([]), lattice.default_vocabulary()).collect() == []


class Task:
    """Stands for a DataFrame and gives back the function that its tasks run."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def block_rows(made, weight, monkeypatch, texts, held):
    monkeypatch.setattr(lattice, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 3)))
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts, pa.string()), pa.array(held)],
                                       ["doc_id", "text", "held"])
    return lattice.blocks(Task(), made.pieces, weight, -1.0)(iter([batch]))


def test_blocks_take_little_memory(spark, small_lattice, monkeypatch):
    _, weight, made = small_lattice
    letters = np.random.default_rng(5).integers(97, 123, (300_000, 9), np.uint8)
    letters[:, 8] = 32
    texts = [letters[k:k + 100].tobytes().decode() for k in range(0, len(letters), 100)]
    distinct = len(set("".join(texts).split()))
    run = block_rows(made, weight, monkeypatch, texts, [False] * len(texts))
    tracemalloc.start()
    size = [len(b) for b in run]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 45e6, f"{peak / 1e6:.0f} MB"
    assert sum(size) == len(texts) + distinct and max(size) <= lattice.ENTRIES


def test_blocks_end_by_text_and_rows(spark, small_lattice, monkeypatch):
    """Whatever the limits, the entries of all blocks give each text's words and the training counts."""
    _, weight, made = small_lattice
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["ab", "B", "abc", "cé", "x\ty", "😀"]) for _ in range(rng.randint(0, 60))) for _ in range(90)]
    texts += [None, "", " \n", "ab " * 400, "b" * 700, "AB"]
    held = [rng.random() < 0.3 for _ in texts]
    want = [Counter(WORD.findall((t or "").translate(LOW))) for t in texts]
    for part, size, rows in ((1 << 19, 1 << 25, 10_000), (50, 500, 10_000), (300, 1 << 25, 7)):
        for name, value in (("PART", part), ("BYTES", size), ("BLOCK_ROWS", rows), ("WORDS", 3), ("ENTRIES", 2)):
            monkeypatch.setattr(lattice, name, value)
        out = pa.Table.from_batches(block_rows(made, weight, monkeypatch, texts, held)).to_pylist()
        words = {(r["block"], r["doc_id"]): (r["hash"], r["own"]) for r in out if r["hash"] is not None}
        docs = [r for r in out if r["hash"] is None]
        assert [r["doc_id"] for r in docs] == list(range(len(texts)))
        assert (len({r["block"] for r in docs}) > 1) == (rows == 7 or size == 500)
        name = {int(lattice.hashes(w.encode()).view(np.int64)[0]): w for c in want for w in c}
        own = Counter()
        for r, c, h in zip(docs, want, held, strict=True):
            got = Counter()
            for at, n in zip(r["at"], r["times"]):
                got[name[words[r["block"], at][0]]] += n
                own[r["block"], at] += n * (not h)
            assert got == c and r["n_tokens"] == c.total() + 1 and r["held"] == h
            log_p = made.log_probability([w.encode() for w in c]) if c else np.zeros(0)
            assert math.isclose(r["score"], (sum(log_p * list(c.values())) - 1) / math.log(10), rel_tol=1e-9)
        assert {k: own[k] for k in words} == {k: n for k, (_, n) in words.items()}


def brute_nearest(rows, queries, k=10):
    out = {}
    for q, x in queries:
        near = sorted((math.sqrt(sum((a - b) ** 2 for a, b in zip(x, y))), i) for i, y in rows if i != q)
        out[q] = near[:k]
    return out


def test_nearest_of_a_small_table_is_exact(spark):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 1) for _ in range(6)]) for i in range(150)]
    rows += [(i, [1.0, 2.0, 3.0, 4.0, 5.0, 6.0]) for i in range(300, 330)]
    odd = [(500, None), (501, [0.0] * 6), (502, [float("nan")] + [1.0] * 5), (503, [float("inf")] + [1.0] * 5),
           (504, [None] + [1.0] * 5), (505, [1.0] * 4), (None, [1.0] * 6), (10, rows[10][1])]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows + odd], "vec_id long, embedding array<double>, rank string")
    usable = permutation_index.usable(df)
    got = permutation_index.nearest(usable, usable.where("vec_id % 100 = 0"))
    expected = brute_nearest(rows, [r for r in rows if r[0] % 100 == 0])
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(found[r["query_id"]])
    assert set(found) == {0, 100, 300}
    for q, near in expected.items():
        assert [i for _, i in found[q]] == [i for _, i in near]
        assert np.allclose([d for d, _ in found[q]], [d for d, _ in near])
    assert permutation_index.nearest(permutation_index.usable(df.limit(0)), usable.limit(0)).collect() == []


def test_fewer_candidates_than_asked(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 2.0]), (100, [1.0, 2.5])], "vec_id long, embedding array<float>")
    u = permutation_index.usable(df)
    got = permutation_index.nearest(u, u.where("vec_id % 100 = 0")).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in got) == [(0, 1, 100), (0, 2, 1), (100, 1, 0), (100, 2, 1)]


def test_recall_against_brute_force(spark):
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    u = permutation_index.usable(df)
    got = permutation_index.nearest(u, u.where("vec_id % 100 = 0")).collect()
    rows = [(r["vec_id"], np.array(r["embedding"], float)) for r in df.collect()]
    x, ids = np.array([v for _, v in rows]), np.array([i for i, _ in rows])
    hit = total = 0
    for q, v in rows:
        if q % 100 == 0:
            d = np.sqrt(((x - v) ** 2).sum(1))
            d[ids == q] = np.inf
            best = set(ids[np.lexsort((ids, d))[:10]].tolist())
            hit += len(best & {r["vec_id"] for r in got if r["query_id"] == q})
            total += 10
    assert hit >= 0.9 * total


def held_out(spark, query, label, folds, held):
    rows = {r["doc_id"]: r for r in query(spark, "/root/testdata/sf0.1").collect()}
    seen = [(rows[r["doc_id"]], r[label]) for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()]
    for r in rows.values():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % folds == held)
    return [(r, y) for r, y in seen if r["held_out"]]


def test_quality_held_out(spark):
    seen = held_out(spark, quality.op9_quality_boosted_trees, "quality", 4, 2)
    assert sum(r["predicted"] == y for r, y in seen) >= 0.98 * len(seen)


def test_toxicity_held_out(spark):
    seen = held_out(spark, toxicity.op8_toxicity_weak_supervision, "toxic", 3, 1)
    assert sum(r["predicted"] == y for r, y in seen) >= 0.97 * len(seen)


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers_on_odd_rows(module, odd_docs, make_docs, labels_of):
    rows = odd_docs.count()
    for labels in ([], [(1, None, None)], [(i, 1, 1) for i in range(10)],
                   [(i, i % 2, i % 2) for i in range(10)] + [(3, 0, 0), (None, 1, 1), (99, 1, 1)]):
        made = module.train(odd_docs, labels_of(labels))
        got = module.score(odd_docs, made).collect()
        assert len(got) == rows and all(0 <= r["score"] <= 1 for r in got)
    assert module.score(make_docs([]), made).collect() == []
    assert module.train(make_docs([]), labels_of([])) is not None


def test_keep_good_keeps_columns(odd_docs, labels_of):
    forest = boosted.constant(0.9)
    assert quality.keep_good(odd_docs, forest).schema == odd_docs.schema
    assert quality.keep_good(odd_docs, forest).count() == odd_docs.count()
    assert quality.keep_good(odd_docs, boosted.constant(0.1)).count() == 0


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0.5)).astype(float)
    f = boosted.fit(x[:2000], y[:2000])
    assert ((f.probability(x[2000:]) > 0.5) == y[2000:]).mean() > 0.95
    w = boosted.fit(np.array([[0.0], [1.0]]), np.array([0.0, 1.0]), weight=np.array([50.0, 50.0]))
    assert w.probability(np.array([[0.0], [1.0]])).round(1).tolist() == [0.0, 1.0]


def test_label_model_finds_accuracies():
    rng = np.random.default_rng(5)
    y = rng.random(20_000) < 0.2
    rate = np.where(y[:, None], 0.7, 0.03)
    votes = rng.random((20_000, toxicity.VOTERS)) < rate
    votes[:, 1] = votes[:, 0]  # a copy must not count twice
    votes[:, toxicity.LEXICON + 2:] = False
    cells, weight = np.unique(votes @ (1 << np.arange(toxicity.VOTERS)), return_counts=True)
    model = toxicity.LabelModel(cells, weight.astype(float), np.zeros((len(cells), 2)))
    assert abs(model.share[1] - 0.2) < 0.03
    assert model.parent[5] == -1 and abs(model.rate[1, 0, 5] - 0.7) < 0.05 and model.rate[0, 0, 5] < 0.06
    assert 0 in model.parent or 1 in (model.parent >= 0)
