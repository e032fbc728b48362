"""Operator 5, BPE encoding and decoding by a tokenization automaton.

The merges are compiled, in order, into a deterministic automaton whose arcs are
labelled with tokens and that accepts exactly the tokenizations of BPE. It
starts with one state that every byte leads back to. The gadget of merge (u, v):
every arc u now leads to a new state, a copy of its target without the arc v;
every state that had an arc u from which v could follow gets an arc uv to the
target of v. All arcs with one label lead to one state, so a state is kept as
(the state it copies, the arc it lost, when), and whether an arc leaves it
follows from these rows. A word's path is unique, as is that of each of its
prefixes; the last arc of each prefix is filled in from left to right.
Decoding emits the labels of the arcs.

Defined results: null and empty texts have no tokens; the special token's string
in a text becomes its id, as the tokenizers library has it; rows stay as they
are, one result each; texts are coded in whole, however long; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import sys
import types
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm.common import table, texts

#: The pre-tokenizer's pattern of byte-level BPE, a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MEMO = 600_000  # words that a worker remembers; more only cost time
KNOWN = 1_000_000  # arcs that it remembers
MEMO_BYTES = 48  # length up to which a word is remembered
RESULT = ("doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, "
          "round_trip boolean")


def byte_letters() -> dict[str, int]:
    """Letters by which byte-level vocabularies write the 256 bytes: printable Latin-1
    stands for itself, the rest follow from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Automaton:
    """States and arcs after all merge gadgets. Tokens are numbered by the vocabulary."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        self.token = {label: k for k, label in enumerate(labels) if label}
        self.back: dict[int, int] = {}  # trie of the labels read backwards: node * 256 + byte
        self.ends = [-1]  # token whose label ends at a node
        for label, k in self.token.items():
            node = 0
            for byte in reversed(label):
                node = self.back.setdefault(node << 8 | byte, len(self.ends))
                if node == len(self.ends):
                    self.ends.append(-1)
            self.ends[node] = k
        self.copied, self.lost, self.made = [0], [-1], [-1]  # per state
        self.target = [0] * len(labels)
        self.left, self.born = [-1] * len(labels), [-1] * len(labels)
        for time, (u, v, uv) in enumerate(merges):
            self.target[uv] = self.target[v]
            self.left[uv], self.born[uv] = u, time
            self.copied.append(self.target[u])
            self.lost.append(v)
            self.made.append(time)
            self.target[u] = len(self.copied) - 1
        self.known: dict[int, bool] = {}  # arcs asked for: state * number of tokens + token

    def leaves(self, state: int, token: int) -> bool:
        """Whether an arc ``token`` leaves ``state``."""
        while state:
            if self.born[token] >= self.made[state]:
                token = self.left[token]  # the arc came with its left part's
            elif token == self.lost[state]:
                return False
            else:
                state = self.copied[state]
        return True

    def _ask(self, arc: int, state: int, token: int) -> bool:
        if len(self.known) >= KNOWN:
            self.known.clear()
        ok = self.known[arc] = self.leaves(state, token)
        return ok

    def path(self, word: bytes) -> list[int]:
        """Labels of the only path that spells ``word``."""
        whole = self.token.get(word)
        if whole is not None:
            return [whole]
        back, ends, known, target, size = self.back, self.ends, self.known, self.target, len(self.labels)
        last, state = [-1], [0]
        for end in range(len(word)):
            node, start = 0, end
            while start >= 0:
                node = back.get(node << 8 | word[start])
                if node is None:
                    start = -1
                    break
                t = ends[node]
                if t >= 0 and state[start] >= 0:
                    arc = state[start] * size + t
                    ok = known.get(arc)
                    if ok is None:
                        ok = self._ask(arc, state[start], t)
                    if ok:
                        break
                start -= 1
            last.append(t if start >= 0 else -1)
            state.append(target[t] if start >= 0 else -1)
        out, at = [], len(word)
        while at:
            out.append(last[at])
            at -= len(self.labels[last[at]])
        return out[::-1]


def compile_json(text: str) -> tuple[Automaton, dict[str, int]]:
    """Automaton and special tokens of a byte-level BPE vocabulary in the tokenizers library's JSON."""
    spec = json.loads(text)
    letters = byte_letters()
    vocab, special = spec["model"]["vocab"], {a["content"]: a["id"] for a in spec["added_tokens"]}
    labels = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for word, k in vocab.items():
        labels[k] = bytes(letters[c] for c in word)
    merges = []
    for pair in spec["model"]["merges"]:
        u, v = pair if isinstance(pair, list) else pair.split(" ")
        merges.append((vocab[u], vocab[v], vocab[u + v]))
    made = Automaton(labels, merges)
    for word, k in special.items():
        made.labels[k] = word.encode()
    return made, special


class Coder:
    """Encodes and decodes whole texts; remembers the paths of words seen."""

    def __init__(self, text: str):
        import regex
        self.automaton, self.special = compile_json(text)
        self.words = regex.compile(PATTERN).findall
        inner = "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))
        self.cut = regex.compile(f"({inner})").split if inner else None
        self.memo: dict[str, bytes] = {}

    def _word(self, word: str) -> bytes:
        raw = word.encode("utf-8", "surrogatepass")
        ids = np.array(self.automaton.path(raw), "<u4").tobytes()
        if len(raw) <= MEMO_BYTES:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.cut and any(s in text for s in self.special):
            return b"".join(np.array([self.special[p]], "<u4").tobytes() if i % 2 else self._plain(p)
                            for i, p in enumerate(self.cut(text)))
        return self._plain(text)

    def _plain(self, text: str) -> bytes:
        get, word = self.memo.get, self._word
        return b"".join([get(w) or word(w) for w in self.words(text)])

    def decode(self, ids: bytes) -> str:
        labels = self.automaton.labels
        return b"".join([labels[k] for k in np.frombuffer(ids, "<u4").tolist()]).decode("utf-8", "replace")


def coder(text: str) -> Coder:
    """The worker's coder for this vocabulary, compiled once per Python process."""
    state = sys.modules.setdefault("_newsmetrics_worker", types.ModuleType("_newsmetrics_worker")).__dict__
    key = hashlib.sha256(text.encode()).hexdigest()
    if state.get("coder_key") != key:
        state["coder_key"], state["coder"] = key, Coder(text)
    return state["coder"]


def encode_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    """Counts and digests of ids and decoded text; ``vocabulary`` is the path of the JSON file on the driver."""
    spec = json.loads(Path(vocabulary).read_text(encoding="utf-8"))
    small = json.dumps({"added_tokens": spec["added_tokens"],
                        "model": {k: spec["model"][k] for k in ("vocab", "merges")}})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(small)
        for b in batches:
            count, digest, decoded, same = [], [], [], []
            for t in texts(b):
                ids = c.encode(t)
                back = c.decode(ids)
                count.append(len(ids) // 4)
                digest.append(hashlib.sha256(ids).hexdigest())
                decoded.append(hashlib.sha256(back.encode("utf-8", "replace")).hexdigest())
                same.append(back == t)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(count, pa.int64()), pa.array(digest, pa.string()),
                 pa.array(decoded, pa.string()), pa.array(same, pa.bool_())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, RESULT)


def default_vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("byte_bpe_50k.json"))


def op5_bpe_automaton(spark, sf_dir: str) -> DataFrame:
    return encode_documents(table(spark, sf_dir, "documents"), default_vocabulary())
