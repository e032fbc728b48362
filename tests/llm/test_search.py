"""Operator 13 against plain scoring of all documents."""
import math
import random
import re
from collections import Counter

import pytest

from newsmetrics.llm import bitsliced

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return TERM.findall((text or "").translate(LOW))


def brute_search(docs, items, top=10):
    found = [(d, Counter(split(t))) for d, t in docs]
    found = [(d, c) for d, c in found if c]
    n, length = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    grouped = {}
    for i, t in set(items):
        grouped.setdefault(i, Counter()).update(split(t))
    out = []
    for i, asked in grouped.items():
        scores = []
        for d, c in found:
            m = 100 - 75 + (75 * sum(c.values()) * n) // length
            s = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, k in asked.items() if c[t])
            if s > 0:
                scores.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:top])]
    return sorted(out, key=str)


def search(spark, docs, items, **kw):
    df = spark.createDataFrame(items, "item_id long, text string")
    index = bitsliced.materialize(bitsliced.build_index(docs), "test-index")
    return sorted((tuple(r) for r in bitsliced.ranked_search(index, df, **kw).collect()), key=str)


def corpus(seed, docs=400):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(800)] + ["Ärger", "日本", "x1y2", "ÉTÉ"]
    weights = [1 / (k + 1) for k in range(len(words))]
    rows = [(i, rng.choice(" -,\n").join(rng.choices(words, weights, k=rng.choice((1, 5, 30, 30, 200, 3000))))) for i in range(docs)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.choice((1, 3, 12, 40))))) for i in range(25)]
    for i, (_, text) in enumerate(items[:8]):
        rows += [(1000 + 20 * i + k, "w1 w2 " + text.upper() + " w3") for k in range(rng.choice((1, 5, 15)))]
    return rows, items


def test_like_plain_scoring(spark, make_docs):
    rows, items = corpus(1)
    want = brute_search(rows, items)
    assert search(spark, make_docs(rows), items) == want and len(want) > 150


def test_small_shards_many_blocks_and_few_bits(spark, make_docs, monkeypatch):
    rows, items = corpus(2, docs=150)
    for name, value in {"SHARD_DOCS": 7, "ENTRIES": 900, "ITEMS": 6, "BITS": 2, "SALTS": 3}.items():
        monkeypatch.setattr(bitsliced, name, value)
    assert search(spark, make_docs(rows).repartition(5), items, top=3) == brute_search(rows, items, 3)


def test_bounds_are_never_below_scores(make_docs):
    import numpy as np
    rows, items = corpus(3, docs=120)
    gathered = bitsliced.Gathered()
    for d, t in rows:
        gathered.add(d, t)
    shards = [dict(zip([c.split()[0] for c in bitsliced.SHARD.split(", ")], s)) for s in gathered.shards()]
    query = bitsliced.Query([(i, Counter(bitsliced.terms(t))) for i, t in items])
    n, length = sum(s["docs"] for s in shards), sum(s["n_terms"] for s in shards)
    df = Counter()
    for s in shards:
        df.update(dict(zip(s["vocabulary"].split(b" "), bitsliced.widen(s["frequencies"]).tolist())))
    query.weigh(n, {t: k for t, k in df.items() if t in query.place})
    excluded = total = 0
    for s in shards:
        shard = bitsliced.Shard(s, query, bitsliced.hashes(query.words), n, length)
        for item in range(len(items)):
            exact = shard.exact(item, np.arange(s["docs"]))
            bounds = shard.bounds(item)
            assert (bounds >= exact).all()
            excluded += int((bounds < np.sort(exact)[-5:].min()).sum())
            total += len(exact)
    assert excluded > total // 3  # the bounds do exclude documents


def test_odd_rows(spark, odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    items = [(1, "word"), (1, "word"), (1, "same TEXT"), (2, None), (3, ""), (None, "same text id"), (4, "é中 nothing"), (5, "a")]
    assert search(spark, odd_docs, items) == brute_search(rows, items)


def test_equal_scores_by_id(spark, make_docs):
    rows = [(i, "alpha beta") for i in range(30, 0, -1)] + [(None, "alpha beta"), (99, "gamma")]
    got = search(spark, make_docs(rows), [(1, "alpha")])
    assert sorted(r[2] for r in got) == list(range(1, 11)) and sorted(r[1] for r in got) == list(range(1, 11))


def test_a_very_long_text(spark, make_docs):
    rows = [(1, "needle " + " ".join(f"t{i}" for i in range(60_000)) + " needle"), (2, "needle"), (3, "x" * 500_000)]
    items = [(1, "needle t59999"), (2, "x" * 500_000)]
    assert search(spark, make_docs(rows), items) == brute_search(rows, items)


def test_no_rows(spark, make_docs):
    assert search(spark, make_docs([]), [(1, "a")]) == []
    assert search(spark, make_docs([(1, None), (2, " -- ")]), [(1, "a")]) == []
    assert search(spark, make_docs([(1, "a b")]), [(1, "!"), (2, None)]) == []
    empty = spark.createDataFrame([], "item_id long, text string")
    index = bitsliced.materialize(bitsliced.build_index(make_docs([(1, "a")])), "test-index")
    assert bitsliced.ranked_search(index, empty).collect() == []


@pytest.mark.parametrize("text", ["", "A-Z_0-9é\x7f日本`{}", "tab\tx\x00y ü×"])
def test_terms(text):
    assert [t.decode() for t in bitsliced.terms(text)] == split(text)
