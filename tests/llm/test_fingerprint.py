"""Operator 12 against whole shingle sets and plain edits."""
import hashlib
import random
import re

import numpy as np
import pytest

from newsmetrics.llm import fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size=5):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def plain_edits(rows):
    """(doc_id, n_chars, digest of the edited text, resemblances) for rows with distinct ids."""
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: -r[0])
    out = {}
    for (d, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + nxt[:half]
        out[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest(), jaccard(shingles(t), shingles(edited)),
                  jaccard(shingles(t), shingles(nxt)))
    return out


def corpus(seed, docs=300):
    rng = random.Random(seed)
    words = [f"w{k}é" for k in range(500)]
    ids = rng.sample(range(-50, 10 ** 12), docs)
    return [(i, " ".join(rng.choices(words, k=rng.choice((0, 1, 3, 8, 40, 55))))) for i in ids]


@pytest.mark.parametrize("partitions", [1, 8, 13])
def test_edits_like_a_plain_loop(spark, make_docs, partitions):
    rows = corpus(partitions)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fingerprint.edited_fingerprints(make_docs(rows).repartition(5)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want = plain_edits(rows)
    assert len(got) == len(rows) and {r["doc_id"] for r in got} == set(want)
    for r in got:  # under K shingles the sketch is the whole set
        n, digest, near_edited, near_next = want[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, digest)
        assert r["near_edited"] == pytest.approx(near_edited) and r["near_next"] == pytest.approx(near_next)


def test_estimates_of_long_texts():
    rng = random.Random(5)
    words = [f"w{k}" for k in range(4000)]
    error = []
    for share in (0.1, 0.5, 0.9):
        base = rng.choices(words, k=6000)
        other = base[:int(6000 * share)] + rng.choices(words, k=6000 - int(6000 * share))
        a, b = (fingerprint.sketch(" ".join(t)) for t in (base, other))
        x, y = shingles(" ".join(base)), shingles(" ".join(other))
        error.append(abs(fingerprint.resemblance(a, b) - jaccard(x, y)))
        assert abs(fingerprint.containment(a, b) - len(x & y) / len(x)) < 0.2
        assert abs(fingerprint.distinct(a) / len(x) - 1) < 0.3
    assert max(error) < 0.15


def test_sketches_merge_like_one_text():
    a, b = (np.arange(n, dtype=np.uint64) * np.uint64(7919) for n in (1000, 300))
    k = fingerprint.K
    parts = [fingerprint.smallest(x, k) for x in (a[::2], a[1::2], b)]
    assert (fingerprint.merge(parts) == fingerprint.smallest(np.concatenate((a, b)), k)).all()
    assert (fingerprint.decode(fingerprint.encode(parts[0])) == parts[0]).all()
    assert len(fingerprint.merge([])) == 0


def test_merged_per_key(spark, make_docs):
    rows = corpus(8, docs=200) + [(10 ** 13, None)]
    made = fingerprint.fingerprints(make_docs(rows))
    from pyspark.sql import functions as F
    keyed = made.withColumn("g", F.when(F.col("doc_id") == 10 ** 13, "empty").otherwise((F.col("doc_id") % 3).cast("string")))
    got = {r["g"]: r for r in fingerprint.merged(keyed.repartition(7), "g").collect()}
    for g in {r["g"] for r in keyed.collect()}:
        texts = [t for d, t in rows if g == "empty" and t is None or t is not None and g == str(int(np.fmod(d, 3)))]
        whole = fingerprint.merge(fingerprint.sketch(t or "") for t in texts)
        assert got[g]["fingerprint"] == fingerprint.encode(whole)
        n = len(set().union(*map(shingles, texts)))
        assert got[g]["n_shingles"] == pytest.approx(n, rel=0.35, abs=0.1)


def test_likeness_columns(spark, make_docs):
    made = fingerprint.fingerprints(make_docs([(1, "a b c d e f"), (2, "A b c d e"), (3, None), (4, "")]))
    pairs = made.alias("x").crossJoin(made.alias("y")).select(
        "x.doc_id", "y.doc_id", fingerprint.likeness("x.fingerprint", "y.fingerprint").alias("s"))
    got = {(r[0], r[1]): tuple(r["s"]) for r in pairs.collect()}
    assert got[(1, 2)] == (0.5, 0.5, 1.0, 2.0) and got[(3, 4)] == (1.0, 1.0, 1.0, 0.0) and got[(1, 3)] == (0.0, 0.0, 1.0, 2.0)


def test_odd_rows(odd_docs):
    got = fingerprint.edited_fingerprints(odd_docs).collect()
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    assert sorted((str(r["doc_id"]), r["n_chars"]) for r in got) == sorted((str(d), len(t or "")) for d, t in rows)
    same = [r for r in got if r["doc_id"] in (8, 9)]
    assert same[0]["fingerprint"] == same[1]["fingerprint"] and {r["near_next"] for r in same if r["doc_id"] == 9} == {1.0}
    assert {r["doc_id"] for r in got if r["fingerprint"] == ""} == {0, 1, 2, 3}


def test_one_row_equal_rows_and_no_rows(make_docs):
    one = fingerprint.edited_fingerprints(make_docs([(5, "one two three four five six")])).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1.0
    equal = fingerprint.edited_fingerprints(make_docs([(5, "same words here")] * 40 + [(4, None)] * 2)).collect()
    assert len(equal) == 42 and sum(r["near_next"] == 1.0 for r in equal) == 40
    assert fingerprint.edited_fingerprints(make_docs([])).collect() == []


def test_a_very_long_text(make_docs):
    rows = [(1, "x" * 300_000), (2, " ".join(f"t{i}" for i in range(50_000))), (3, "a b")]
    want = plain_edits(rows)
    for r in fingerprint.edited_fingerprints(make_docs(rows)).collect():
        assert (r["n_chars"], r["edited_sha256"]) == want[r["doc_id"]][:2]
        assert abs(r["near_edited"] - want[r["doc_id"]][2]) < 0.15
