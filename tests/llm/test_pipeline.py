"""The pipeline's stages, each against a plain version on the stage's own input."""
import hashlib
import re

import numpy as np

import corpus_pipeline
from newsmetrics.llm import bpe, pii, quality
from newsmetrics.llm.common import table

from .test_pairs import brute_components
from .test_texts import plain_spans

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return {r["doc_id"]: r for r in df.collect()}


def plain_redaction(text):
    for kind in pii.KINDS:
        spans = [s.split(":") for s in plain_spans(text) if s.startswith(kind + ":")]
        for _, a, z in reversed(spans):
            text = text[:int(a)] + f"[{kind.upper()}]" + text[int(z):]
    return text


def test_stages_like_plain_versions(spark):
    from tokenizers import Tokenizer
    docs = table(spark, SF, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, out = rows_of(docs), stage(spark, docs, SF).checkpoint()
        after = rows_of(out)
        assert len(after) == out.count()
        if name != "encode":
            assert out.columns == docs.columns
        seen[name] = (before, after, docs)
        docs = out

    before, after, first = seen["quality"]
    forest = quality.train(first, table(spark, SF, "labels"))
    scores = {r["doc_id"]: r["score"] for r in quality.score(first, forest).collect()}
    assert set(after) == {d for d in before if scores[d] >= quality.THRESHOLD} and len(after) < len(before)

    before, after, _ = seen["near_copies"]
    assert set(after) == {c for _, _, c in brute_components([(d, r["text"]) for d, r in before.items()], 5, 80)}

    before, after, _ = seen["decontaminate"]
    windows = set()
    for r in table(spark, SF, "benchmark").collect():
        w = r["text"].split()
        windows |= {tuple(w[i:i + 8]) for i in range(len(w) - 7)}
    held = {d for d, r in before.items() if (w := r["text"].split())
            and any(tuple(w[i:i + 8]) in windows for i in range(len(w) - 7))}
    assert set(after) == set(before) - held

    before, after, _ = seen["redact"]
    for d, r in before.items():
        assert after[d]["text"] == plain_redaction(r["text"]) and after[d]["n_chars"] == len(after[d]["text"])
    assert any(re.search(r"\[(EMAIL|IP|CARD|PHONE)\]", r["text"]) for r in after.values())

    before, after, _ = seen["encode"]
    library = Tokenizer.from_file(bpe.default_vocabulary())
    for d, r in before.items():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        assert after[d]["n_tokens"] == len(ids)
        assert after[d]["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert after[d]["decoded_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()


def test_run_gives_the_last_stage(spark):
    got = corpus_pipeline.run(spark, SF)
    assert got.columns[:4] == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_empty_table(spark, make_docs, monkeypatch):
    docs = make_docs([])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
