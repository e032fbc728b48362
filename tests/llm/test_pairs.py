"""Operators 1 and 7 against brute force."""
import hashlib
import itertools
import random
import re
import time

import numpy as np

from newsmetrics.llm import common, graph, jaccard_join, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_sets(text, size):
    w = WORD.findall((text or "").translate(LOW))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + size]) for i in range(max(1, len(w) - size + 1)))


def brute_components(rows, size=4, percent=85):
    sets = [(d, brute_sets(t, size)) for d, t in rows]
    parent = {d: d for d, _ in rows if d is not None}

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            common = len(x & y)
            if 100 * common >= percent * (len(x) + len(y) - common):
                p, q = sorted((find(a), find(b)))
                parent[q] = p
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in sets), key=str)


def found_components(df, **kw):
    return sorted((tuple(r) for r in jaccard_join.jaccard_components(df, **kw).collect()), key=str)


def session_at(root):
    """scratch_path and materialize that write below ``root``."""
    numbers = itertools.count()

    def scratch_path(spark, name):
        return f"{root}/{name}-0x{next(numbers)}"

    def materialize(df, name):
        path = scratch_path(df.sparkSession, name)
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    return {"scratch_path": scratch_path, "materialize": materialize}


def near_copies(seed, groups=4, copies=14):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(3000)]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for g in range(groups):
        base = [rng.choice(vocabulary) for _ in range(rng.choice((6, 9, 25, 120, 500)))]
        for _ in range(copies):
            words = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 18))):
                words[rng.randrange(len(words))] = rng.choice(vocabulary)
            if rng.random() < 0.2:
                words += passage
            rows.append(" ".join(words).upper() if rng.random() < 0.1 else "  ".join(words))
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_like_brute_force(make_docs):
    rows = [(1000 * s + i, t) for s in (1, 2, 3) for i, t in near_copies(s)]
    got = found_components(make_docs(rows))
    assert got == brute_components(rows)
    assert sum(c != d for d, _, c in got) > 20


def test_crowded_signatures_give_the_same(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CROWD", 1)
    rows = [(1000 * s + i, t) for s in (4, 5) for i, t in near_copies(s)]
    assert found_components(make_docs(rows)) == brute_components(rows)
    assert found_components(make_docs(rows), size=5, percent=80) == brute_components(rows, 5, 80)


def test_many_unlinked_short_texts_with_a_frequent_passage(make_docs):
    """Signatures that thousands of texts share cost no pairs; the few links among them are found."""
    rng = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(30))
    texts = [passage + " " + " ".join(f"u{i}-{k}" for k in range(14)) for i in range(2000)]
    texts += [texts[7] + " end", texts[7] + " fin end", texts[1500].replace("u1500-3", "changed")]
    rng.shuffle(texts)
    rows = list(enumerate(texts))
    want = brute_components([r for r in rows if any(x in r[1] for x in ("u7-", "u1500-"))])
    got = {d: c for d, _, c in found_components(make_docs(rows))}
    assert {d: c for d, _, c in want}.items() <= got.items()
    assert sum(d != c for d, c in got.items()) == sum(d != c for d, _, c in want) >= 2


def test_components_at_another_threshold(make_docs):
    rows = near_copies(9, groups=5)
    assert found_components(make_docs(rows), size=5, percent=80) == brute_components(rows, 5, 80)


def test_a_group_of_near_copies_around_a_missing_base(make_docs):
    rng = random.Random(4)
    base = [f"b{k}" for k in range(150)]
    rows = []
    for i in range(60):
        words = list(base)
        for k in rng.sample(range(150), rng.choice((1, 2, 3, 5, 9))):
            words[k] = f"e{i}-{k}"
        rows.append((i, " ".join(words)))
    assert found_components(make_docs(rows)) == brute_components(rows)


def test_differences_that_come_too_late_in_either_set_make_no_pair(spark):
    # 40 sets of as many components share their last two differences but must share three: they can't be linked
    rare = spark.range(40).selectExpr(
        "1L AS group", "explode(array(5, 6)) AS place", "id AS node", "id AS label", "6L AS differences", "270L AS e", "0L AS free") \
        .selectExpr("group", "CAST(place AS BIGINT) AS gram", "0 AS kind", "node", "label", "place", "e", "differences", "free")
    met, _ = jaccard_join.met_by_differences(rare, 80)
    assert met.count() == 0
    early = rare.withColumn("place", rare["place"] - 4)
    assert jaccard_join.met_by_differences(early, 80)[0].count() == 2 * 40 * 39 // 2


def test_posted_signatures_and_segments_go_before_the_result(spark, make_docs, monkeypatch):
    import os
    import tempfile
    root = tempfile.mkdtemp(prefix="nm-jaccard-")
    for module in (jaccard_join, common):
        for name in ("scratch_path", "materialize"):
            if hasattr(module, name):
                monkeypatch.setattr(module, name, session_at(root)[name])
    rows = near_copies(9)
    assert found_components(make_docs(rows)) == brute_components(rows)
    left = {f.split("/")[-1].split("-0x")[0] for d, _, files in os.walk(root) for f in [d] if any(x.startswith("part-") for x in files)}
    assert left and not left & {"jaccard-sets", "jaccard-posts", "jaccard-segments", "jaccard-named"}, left


def test_tables_of_a_step_go_with_their_last_reader(make_docs, monkeypatch):
    import os
    there, write = {}, common.Workspace.write

    def seen(self, df, name):
        found = write(self, df, name)
        there.setdefault(name, set()).update(os.listdir(self.path))
        return found

    monkeypatch.setattr(common.Workspace, "write", seen)
    rows = near_copies(9)
    assert found_components(make_docs(rows)) == brute_components(rows)
    gone = {"jaccard-differences": {"jaccard-members", "jaccard-consensus"}, "jaccard-group-pairs": {"jaccard-apart", "jaccard-differences", "jaccard-seen"}}
    for name, before in gone.items():
        assert name in there and not there[name] & before, (name, there.get(name))


def test_written_tables_leave_no_shuffle_files(spark):
    def files():
        blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {blocks.apply(i).getName() for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}

    def left(since):
        until = time.time() + 20
        while files() - since and time.time() < until:
            time.sleep(0.2)
        return files() - since

    setting, before = spark.conf.get(common.SHUFFLE_CLEANUP), files()
    counts = spark.range(1000).selectExpr("id % 7 AS a", "id % 11 AS b").groupBy("a", "b").count().select("a", "b")
    step = common.Workspace(spark, "test")
    assert step.write(counts, "counts").count() == 77
    label = graph.components(counts, step)
    assert {tuple(r) for r in label.collect()} == {(i, 0) for i in range(11)}
    assert common.written(counts, "counts").count() == 77
    # the counts above, run by themselves, leave one file set each for one row
    assert len({f.split("_")[1] for f in left(before)}) <= 2
    assert spark.conf.get(common.SHUFFLE_CLEANUP) == setting


def test_components_take_repeated_edges_loops_and_chains(spark):
    edges = [(i, i + 1) for i in range(40)] + [(41, 41), (50, 45), (45, 50), (50, 45), (45, 48)]
    label = graph.components(spark.createDataFrame(edges, "a long, b long"))
    assert {r["node"]: r["label"] for r in label.collect()} == {i: 0 for i in range(41)} | {50: 45, 45: 45, 48: 45}
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_components_of_odd_rows(odd_docs, make_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()]
    got = found_components(odd_docs)
    assert len(got) == len(rows)
    by = {}
    for d, n, c in got:
        by.setdefault(d, []).append((n, c))
    assert by[0] == [(0, 0)] and by[1] == [(0, 1)] and by[2] == [(0, 2)]
    assert by[8][0][1] == by[9][0][1] == 8
    assert by[None] == [(1, None)]
    assert found_components(make_docs([])) == []


def test_keep_one(make_docs):
    rows = near_copies(5)
    expected = {c for _, _, c in brute_components(rows, 5, 80)}
    kept = jaccard_join.keep_one(make_docs(rows + [rows[0], (None, "no id"), (None, "no id")]))
    ids = [r["doc_id"] for r in kept.collect()]
    assert {i for i in ids if i is not None} == expected
    assert ids.count(rows[0][0]) <= 1 and ids.count(None) == 2
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]


def test_keep_one_judges_each_text_of_an_id(make_docs):
    copied = " ".join(f"w{i}" for i in range(60))
    clean = " ".join(f"v{i}" for i in range(60))
    kept = jaccard_join.keep_one(make_docs([(1, copied), (5, copied + " end"), (5, clean), (6, clean + " end")]))
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == [(1, copied), (5, clean)]


def brute_removed(texts):
    raw = [(t or "").encode() for t in texts]
    seen = {}
    for b in raw:
        for i in range(len(b) - 199):
            seen[b[i:i + 200]] = seen.get(b[i:i + 200], 0) + 1
    out = []
    for b in raw:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - 199):
            if seen[b[i:i + 200]] > 1:
                gone[i] += 1
                gone[i + 200] -= 1
        mask = np.cumsum(gone[:-1]) > 0
        kept = bytes(np.frombuffer(b, np.uint8)[~mask])
        spans = int((np.diff(np.concatenate(([0], mask.astype(int)))) == 1).sum())
        out.append((len(b), int(mask.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeated_texts(seed):
    rng = random.Random(seed)
    letters = "abcdefghij klmnop é"

    def text(n):
        return "".join(rng.choice(letters) for _ in range(n))

    shared = [text(n) for n in (199, 200, 201, 260, 700)]
    out = []
    for _ in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            parts.append(text(rng.randint(0, 400)))
            if rng.random() < 0.6:
                s = rng.choice(shared)
                cut = rng.randint(0, 30)
                parts.append(s[cut:] if rng.random() < 0.5 else s)
        out.append("".join(parts))
    return out + [out[0], out[1], "z" * 450, "ab" * 300, "ab" * 120, "y" * 200, "y" * 199]


def test_repeats_like_brute_force(make_docs, monkeypatch):
    rows = repeated_texts(1) + [None, "", "short"]
    expected = brute_removed(rows)
    for bucket, step in ((4096, 1 << 15), (3, 256)):  # the second sends anchors to the counted way, and cuts texts
        monkeypatch.setattr(suffix_dedup, "BUCKET", bucket)
        monkeypatch.setattr(suffix_dedup, "STEP", step)
        got = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.remove_repeats(make_docs(rows)).collect()}
        assert [got[i] for i in range(len(rows))] == expected
    assert sum(e[1] for e in expected) > 1000


def test_repeats_of_odd_rows(odd_docs, make_docs):
    rows = odd_docs.collect()
    expected = sorted(zip((str(r["doc_id"]) for r in rows), brute_removed([r["text"] for r in rows])))
    got = sorted((str(r["doc_id"]), tuple(r)[1:]) for r in suffix_dedup.remove_repeats(odd_docs).collect())
    assert got == expected
    assert suffix_dedup.remove_repeats(make_docs([])).collect() == []


def test_merge_sort_orders_suffixes():
    rng = np.random.default_rng(2)
    raw = np.concatenate([rng.integers(97, 99, 400), np.full(300, 97), rng.integers(97, 120, 400)]).astype(np.uint8)
    raw = np.concatenate([raw, raw[:350], np.zeros(0, np.uint8)])
    h = suffix_dedup.Prefixes(raw)
    at = np.arange(len(raw) - suffix_dedup.SPAN + 1)
    group = at % 3
    by, groups = suffix_dedup.merge_sort(raw, h, at, group)
    plain = [bytes(raw[i:i + suffix_dedup.SPAN]) for i in by]
    assert (np.diff(groups) >= 0).all() and sorted(by.tolist()) == at.tolist()
    for g in range(3):
        own = [p for p, k in zip(plain, groups) if k == g]
        assert own == sorted(own)
    a, b = rng.integers(0, len(at), (2, 500))
    for x, y, n in zip(a, b, suffix_dedup.common_extension(h, a, b)):
        p, q = raw[x:x + 200], raw[y:y + 200]
        assert n == (200 if (p == q).all() else int((p != q).argmax()))
