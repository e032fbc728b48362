"""Operators 2, 5, 6 and 10 against plain versions."""
import hashlib
import random
import re

import numpy as np
import pytest

from newsmetrics.llm import bpe, decontaminate, pii, revisits

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_spans(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and luhn(digits),
                    "phone": lambda: 10 <= len(digits) <= 15}[kind]():
                out.append((m.start(), order, m.end(), kind))
    return [f"{k}:{a}:{z}" for a, _, z, k in sorted(out)]


def fuzz_pii(seed, n=300):
    rng = random.Random(seed)
    bits = ["a@b.c", "x.y+z@mail.example.com", "@", "1.2.3.4", "300.1.2.3", "001.02.3.4.5.6.7.8", "4111 1111 1111 1111",
            "4111-1111-1111-1112", "+1 (509) 555-6973", "+", "_", ".", "-", " ", "é", "😀", "中", "\n", "12", "9" * 25,
            "a" * 40, "a@b.c_d@e.f", "%", "(", "token"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(n)]


def check_base(df, rows):
    got = pii.find(df, []).select("doc_id", pii.listing("base").alias("b")).collect()
    assert sorted((str(r["doc_id"]), r["b"]) for r in got) == sorted((str(d), ",".join(plain_spans(t))) for d, t in rows)


def test_base_spans_like_plain_regex(make_docs):
    rows = list(enumerate(fuzz_pii(1)))
    check_base(make_docs(rows), rows)


def test_base_spans_of_odd_rows(odd_docs, make_docs):
    check_base(odd_docs, [(r["doc_id"], r["text"]) for r in odd_docs.collect()])
    long = [(0, "a" * 8_000), (1, "1" * 8_000), (2, ("x@" * 50_000)), (3, "1." * 60_000), (4, "+1" + " " * 100_000),
            (5, "7 a@b.cd " * 2_000)]
    check_base(make_docs(long), long)
    # the plain regular expressions take quadratic time here, ours linear
    longer = make_docs([(0, "a" * 1_000_000), (1, "1" * 1_000_000)])
    assert all(not r["base"] for r in pii.find(longer, []).collect())
    assert pii.find(make_docs([]), []).collect() == [] and pii.accepted_cells(make_docs([])) == []


def test_candidates_add_and_keep_base(make_docs):
    rows = [(i, f"call +1 (509) 555-{i:04d} now, or write to bob{i}@mail.example.com please") for i in range(400)]
    rows += [(1000 + i, f"call (509) 555-{i:04d} now, or write to amy{i} (at) mail (dot) example (dot) com today") for i in range(5)]
    docs = make_docs(rows)
    accepted = pii.accepted_cells(docs)
    assert accepted and len(accepted) <= pii.CELLS
    check_base(docs, rows)
    clean = [(0, "no data here, at home. dot dot dot 12 345"), (1, None)]
    assert all(not r["added"] and not r["base"] for r in pii.find(make_docs(clean), accepted).collect())
    for r in pii.find(docs, accepted).collect():
        spans = [(s["start"], s["end"]) for s in r["base"]]
        assert all(a >= z or b >= y for s in r["added"] for a, b in [(s["start"], s["end"])] for z, y in [(0, 0)])
        assert not any(s["start"] < z and a < s["end"] for s in r["added"] for a, z in spans)


@pytest.mark.parametrize("n", [300, 6000])
def test_disguised_data_is_added_at_every_size(make_docs, n):
    rows, planted = [], {}
    for i in range(n):
        if i % 20:
            rows.append((i, f"call +1 (509) 555-{i:04d} now, or write to bob{i}@mail.example.com, host 10.0.{i % 250}.7 ; "
                            f"batch 2023-1234-{i:04d} and list 900[.]800[.]700[.]{i % 100 + 300} done"))
        else:
            planted[i] = [f"(509) 555-{i:04d}", f"amy{i} (at) mail (dot) com", f"10[.]0[.]{i % 250}[.]1"]
            rows.append((i, f"reach me: {planted[i][0]} or write to {planted[i][1]} via host {planted[i][2]} ok"))
    docs, texts = make_docs(rows), dict(rows)
    accepted = pii.accepted_cells(docs)
    for r in pii.find(docs, accepted).collect():
        added = [texts[r["doc_id"]][s["start"]:s["end"]] for s in r["added"]]
        assert sorted(added) == sorted(planted.get(r["doc_id"], []))
    redacted = {r["doc_id"]: r["text"] for r in pii.redact(docs, accepted).collect()}
    assert all(redacted[i] == "reach me: [PHONE] or write to [EMAIL] via host [IP] ok" for i in planted)


def test_redaction(make_docs):
    texts = ["mail a.b@c.example.com or +1 (509) 555-6973 now", "from 10.0.0.1 with 4111 1111 1111 1111", "300.1.2.3", None, ""]
    out = pii.redact(make_docs(texts), [])
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    want = ["mail [EMAIL] or [PHONE] now", "from [IP] with [CARD]", "300.1.2.3", None, ""]
    assert got == {i: (t, None if t is None else len(t)) for i, t in enumerate(want)}
    assert out.columns == make_docs([]).columns


def test_plan_has_no_python(sf_docs):
    for df in (pii.find(sf_docs, [1, 2]), pii.redact(sf_docs, [1, 2])):
        assert not re.search("Python|Arrow|Pandas", df._jdf.queryExecution().toString())


@pytest.fixture(scope="module")
def coder():
    return bpe.Coder(open(bpe.default_vocabulary(), encoding="utf-8").read())


def test_tokens_like_the_library(coder, sf_docs, odd_docs):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.default_vocabulary())
    rng = random.Random(2)
    texts = [r["text"] or "" for df in (sf_docs, odd_docs) for r in df.collect()]
    texts += ["".join(rng.choice("ab cdeé 中\n\t’'s!12039😀 ſ​") for _ in range(rng.randint(0, 120))) for _ in range(800)]
    texts += ["x<|endoftext|> y<|endoftext|>", "<|endoftext|", " " * 500 + "z", "don't I'LL we've", "\x00\x1f", "Ⅷ½०"]
    for t in texts:
        ids = coder.encode(t)
        expected = library.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert coder.decode(ids) == library.decode(expected, skip_special_tokens=False) == t


def test_automaton_is_that_of_the_merges():
    """All words over two letters: the only path of each is what merging in order gives."""
    labels = [b"a", b"b", b"aa", b"ab", b"aab", b"ba", b"abab", b"aaaa"]
    merges = [(0, 0, 2), (0, 1, 3), (2, 1, 4), (1, 0, 5), (3, 3, 6), (2, 2, 7)]
    made = bpe.Automaton(labels, merges)
    made.token = dict(made.token)
    rank = {(u, v): (k, uv) for k, (u, v, uv) in enumerate(merges)}
    for n in range(1, 11):
        for bits in range(2 ** n):
            word = bytes(97 + (bits >> k & 1) for k in range(n))
            tokens = [b - 97 for b in word]
            while pairs := [rank[p] for p in zip(tokens, tokens[1:]) if p in rank]:
                _, uv = min(pairs)
                u, v = next((u, v) for u, v, x in merges if x == uv)
                out, i = [], 0
                while i < len(tokens):
                    if tokens[i:i + 2] == [u, v]:
                        out.append(uv)
                        i += 2
                    else:
                        out.append(tokens[i])
                        i += 1
                tokens = out
            paths = [[]]
            if word not in made.token:
                assert made.path(word) == tokens, word


def test_encoded_documents(odd_docs, make_docs, coder):
    got = bpe.encode_documents(odd_docs, bpe.default_vocabulary()).collect()
    want = []
    for r in odd_docs.collect():
        t = r["text"] or ""
        ids = coder.encode(t)
        want.append((str(r["doc_id"]), len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(t.encode()).hexdigest(), True))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)
    assert bpe.encode_documents(make_docs([]), bpe.default_vocabulary()).collect() == []


ITEM = ("If Maria buys 12 apples for 3 dollars each and walks 4 km to the market, how many minutes does Maria "
        "need for the whole way and how much does she pay in the end")


def items_of(spark, rows):
    return spark.createDataFrame([(i, t, "x") for i, t in rows], "item_id long, text string, key string")


def filler(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8))) for _ in range(n))


def test_reparameterised_questions_are_found(spark, make_docs):
    other = ITEM.replace("Maria", "Jonas").replace("12", "57").replace(" 3 ", " 8 ").replace("km", "miles").replace("4", "9")
    broken = ITEM.replace("buys 12", "buys 5").replace("does Maria", "does Peter")  # one slot, two values: its other windows remain
    rows = [(0, filler(40, 1) + ". " + ITEM + ". " + filler(30, 2)), (1, filler(10, 3) + ". " + other),
            (2, filler(90, 4)), (3, " ".join(ITEM.split()[:7]) + " " + filler(40, 5)), (4, ITEM), (4, ITEM), (5, broken)]
    found = decontaminate.contaminated(make_docs(rows), items_of(spark, [(7, ITEM), (8, None), (9, ""), (10, filler(30, 9))]))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(0, 7), (1, 7), (4, 7), (5, 7)}
    big = decontaminate.contaminated(make_docs(rows), items_of(spark, [(7, ITEM)]), max_broadcast=0)
    assert {(r["doc_id"], r["item_id"]) for r in big.collect()} == {(0, 7), (1, 7), (4, 7), (5, 7)}


def test_a_conflicting_slot_costs_its_windows_only(spark, make_docs):
    run = ("Tom runs 5 km along the quiet river before breakfast and then another 10 km through the old town, so how "
           "far does he run on that day")
    add = "Each of the 3 boxes holds exactly 5 red balls, so how many balls are there"
    twice = "Take 3 cups and 3 spoons, wash them, put them away and then say how many things are now in the drawer"
    rows = [(0, ITEM.replace("buys 12", "buys 5").replace("does Maria", "does Peter")),
            (1, run.replace("5 km", "5 miles")), (2, add.replace("3", "4").replace("5", "4")),
            (3, twice.replace("3 cups", "6 cups")), (4, "Take 6 cups and 3 spoons, wash them " + filler(30, 6))]
    items = items_of(spark, [(0, ITEM), (1, run), (2, add), (3, twice)])
    for most in (decontaminate.MAX_BROADCAST, 0):
        found = decontaminate.contaminated(make_docs(rows), items, max_broadcast=most)
        assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {(0, 0), (1, 1), (2, 2), (3, 3)}


def test_copies_in_another_case_are_found(spark, make_docs):
    names = "When did Maria Lopez meet Jonas Berg in Paris, and why did Anna Smith tell Peter Wolf of Rome about the École and Olga"
    items = items_of(spark, [(7, ITEM), (8, names), (9, names.upper())])
    rows = [(0, names.lower()), (1, filler(30, 1) + " " + names.upper() + " " + filler(30, 2)), (2, ITEM.upper()), (3, ITEM.lower()),
            (4, names), (5, " ".join(names.lower().split()[:9]) + " " + filler(40, 5))]
    for most in (decontaminate.MAX_BROADCAST, 0):
        found = decontaminate.contaminated(make_docs(rows), items, max_broadcast=most)
        assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == {
            (0, 8), (1, 8), (4, 8), (0, 9), (1, 9), (4, 9), (2, 7), (3, 7)}


def test_decontamination_like_plain_windows(spark, sf_docs):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    windows = {}
    for r in items.collect():
        w = r["text"].split()
        for j in range(len(w) - 7):
            windows[tuple(w[j:j + 8])] = r["item_id"]
    hit = set()
    for r in sf_docs.collect():
        w = (r["text"] or "").split()
        hit |= {(r["doc_id"], windows[tuple(w[j:j + 8])]) for j in range(len(w) - 7) if tuple(w[j:j + 8]) in windows}
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(sf_docs, items).collect()}
    assert found == hit and found
    kept = {r["doc_id"] for r in decontaminate.drop_contaminated(sf_docs, items).collect()}
    assert kept == {r["doc_id"] for r in sf_docs.collect()} - {d for d, _ in hit}


def test_decontamination_of_odd_rows(spark, odd_docs, make_docs):
    items = items_of(spark, [(1, ITEM), (1, ITEM), (None, filler(20, 1)), (2, "short one")])
    rows = odd_docs.collect()
    kept = decontaminate.drop_contaminated(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == len(rows)
    held = make_docs([(None, ITEM), (1, "a short one. here"), (2, None)])
    assert {r["doc_id"] for r in decontaminate.drop_contaminated(held, items).collect()} == {2}
    assert decontaminate.drop_contaminated(make_docs([]), items).collect() == []
    assert decontaminate.drop_contaminated(odd_docs, items_of(spark, [])).count() == len(rows)


RECORD = ("record_id long, kind string, url string, ts long, etag string, last_modified string, digest string, "
          "headers array<struct<name:string,value:string>>, block string")


def plain_revisits(rows):
    out = []
    for r in rows:
        if r[1] != "revisit":
            continue
        full = [f for f in rows if f[1] == "response" and r[2] and f[2] and r[3] is not None and f[3] is not None
                and f[2].lower().split("#")[0] == r[2].lower().split("#")[0] and f[3] < r[3]]
        hit = max(full, key=lambda f: (f[3], f[0]), default=None)
        out.append((r[0], None if hit is None else hit[0]))
    return sorted(out, key=str)


def test_revisits_like_a_plain_search(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        url = rng.choice(["http://a.example.com/x", "HTTP://A.example.com/x#top", "http://b.example.com/y", "http://c.example.com/z"])
        rows.append((i, rng.choice(["response", "revisit", "revisit"]), url, rng.choice([None, rng.randint(0, 60)]), None, None,
                     None, [("Date", str(i)), ("X-A", "1")], "clash"))
    rows.append((1000, "revisit", None, 5, None, None, None, None, None))
    spark.conf.set("spark.sql.shuffle.partitions", "5")
    df = spark.createDataFrame(rows + [rows[1]], RECORD)
    got = sorted(((r["record_id"], r["response_id"]) for r in revisits.resolve_revisits(df).collect()), key=str)
    assert got == plain_revisits(rows + [rows[1]])
    assert revisits.resolve_revisits(df.limit(0)).collect() == []


def test_validators_and_headers(spark):
    stored = [("ETag", '"1"'), ("Content-Type", "text/html"), ("Date", "old"), ("Vary", "a"), ("Vary", "b")]
    full = [(0, "response", "http://h/p/", 1, '"1"', "monday", "d1", stored, None)]
    asked = [(1, "revisit", "http://www.h:80/p?utm_source=x", 2, 'W/"1"', "tuesday", "d2",
              [("date", "new"), ("Content-Type", "no"), ("Expires", "soon")], None),
             (2, "revisit", "http://h/p", 2, '"2"', "monday", "d1", None, None),
             (3, "revisit", "http://h/p", 2, None, "monday", "d9", None, None),
             (4, "revisit", "http://h/p", 2, None, None, "d9", None, None),
             (5, "revisit", "http://h/p", 2, None, None, None, None, None),
             (6, "revisit", "http://h/p", 1, '"1"', None, None, None, None)]
    got = {r["record_id"]: r for r in revisits.resolve_revisits(spark.createDataFrame(full + asked, RECORD)).collect()}
    assert [got[i]["status"] for i in range(1, 7)] == ["resolved", "mismatch", "resolved", "mismatch", "unverified", "no_response"]
    assert [tuple(h) for h in got[1]["headers"]] == [("content-type", "text/html"), ("date", "new"), ("etag", '"1"'),
                                                     ("expires", "soon"), ("vary", "a"), ("vary", "b")]
    assert got[2]["headers"] is None and got[1]["digest"] == "d1"
