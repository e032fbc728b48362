"""Operator 11 against all pairs of words."""
import random
import re
import zlib
from collections import Counter

import pytest

from newsmetrics.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute_words(rows, every=199):
    seen = Counter()
    for d, t in rows:
        for run in RUN.findall((t or "").translate(LOW)):
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            at = h % len(run)
            seen[run if h % every else run[:at] + run[at + 1:]] += 1
    return {w: n for w, n in seen.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(rows, **kw):
    words = brute_words(rows, **kw)
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = top if top and words[top] >= 5 * words[w] else None
    out = []
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, words[w], len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out)


def found(df, **kw):
    return sorted(tuple(r) for r in spelling.spelling_groups(df, **kw).collect())


def corpus(seed, base=30, texts=120):
    """Texts of words, their anagrams and their one- and two-edit variants at falling rates."""
    rng = random.Random(seed)
    letters = "abcdeé×ÀZ"
    stems = ["".join(rng.choice(letters) for _ in range(rng.randint(5, 9))) for _ in range(base)]

    def variant(w):
        for _ in range(rng.choice((0, 0, 0, 0, 0, 0, 1, 1, 2))):
            i = rng.randrange(len(w))
            w = rng.choice((w[:i] + w[i + 1:], w[:i] + rng.choice(letters) + w[i:], w[:i] + rng.choice(letters) + w[i + 1:]))
        return "".join(rng.sample(w, len(w))) if rng.random() < 0.05 else w
    return [(i, rng.choice(" ,1œ\n").join(variant(rng.choice(stems)) for _ in range(150))) for i in range(texts)]


def test_like_all_pairs(make_docs):
    for seed in (1, 2):
        rows = corpus(seed)
        want = brute_groups(rows, every=7)
        assert found(make_docs(rows), every=7) == want
        assert sum(f is not None for _, f, *_ in want) > 20 and max(r[4] for r in want) > 3


def test_many_cells_and_parts_give_the_same(make_docs, monkeypatch):
    rows = corpus(3)
    for name, value in {"CELL": 8, "LEAF": 2, "POINTS": 5, "QUERIES": 7, "BATCH": 3}.items():
        monkeypatch.setattr(spelling, name, value)
    assert found(make_docs(rows), every=11) == brute_groups(rows, every=11)


def test_a_sample_without_some_lengths(make_docs, monkeypatch):
    rows = corpus(4)
    monkeypatch.setattr(spelling, "SAMPLE", 20)
    assert found(make_docs(rows), every=11) == brute_groups(rows, every=11)


def test_forms_are_followed_to_the_last(make_docs):
    rows = [(i, t) for i, t in enumerate(["alphabetic " * 800, "alphabetc " * 150, "alphabet " * 25, "alphabe " * 5, "alphabet alphabetisch"])]
    got = {r["word"]: (r["form"], r["root"]) for r in spelling.spelling_groups(make_docs(rows), every=10 ** 10).collect()}
    assert got == {"alphabetic": (None, "alphabetic"), "alphabetc": ("alphabetic", "alphabetic"),
                   "alphabet": ("alphabetc", "alphabetic"), "alphabe": ("alphabet", "alphabetic")}


def test_ties_of_a_form_go_to_the_smaller_word(make_docs):
    rows = [(1, "bananax " * 25 + "bananay " * 25 + "bananaz " * 5)]
    got = {r["word"]: r["form"] for r in spelling.spelling_groups(make_docs(rows), every=10 ** 10).collect()}
    assert got["bananaz"] == "bananax"


def test_odd_rows(odd_docs):
    rows = [(r["doc_id"], r["text"]) for r in odd_docs.collect()] * 3
    df = odd_docs.unionAll(odd_docs).unionAll(odd_docs)
    assert found(df) == brute_groups(rows)


def test_no_rows(make_docs):
    assert found(make_docs([])) == [] and found(make_docs([(1, None), (2, "a b c")])) == []


def test_a_very_long_run(make_docs):
    long = "x" * 200_000
    rows = [(1, " ".join([long] * 30)), (2, " ".join([long + "y"] * 5)), (3, " ".join([long[1:]] * 5))]
    got = {(len(r["word"]), r["n_near"], r["form"] == long) for r in
           spelling.spelling_groups(make_docs(rows), every=10 ** 10).collect()}
    assert got == {(200_000, 2, False), (200_001, 1, True), (199_999, 1, True)}


@pytest.mark.parametrize("text", ["", "œuvres", "naïveté Ünder straße ÷×÷×÷×", "tab\tword\u0000word"])
def test_runs(text):
    assert [r.decode("latin-1") for r in spelling.runs(text)] == RUN.findall(text.translate(LOW))
