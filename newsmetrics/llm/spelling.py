"""Operator 11, spelling variants: k-d trees over letter-count vectors.

A word's vector counts its letters (a-z and U+00C0 to U+00FF, one dimension
each). One replaced letter moves the vector by -1 in one dimension and +1 in
another, one deleted letter by -1 in one: an edit is an L1 distance of two or one.
Words of one length form one k-d tree; a word searches the tree of its own
length (replacement) and that of the length below (deletion, which counts for
both words). A box is pruned as soon as its letters are too many or too few by
more than that. Vectors that remain are an edit apart; letter order is then
verified by making the edit at each occurrence of the letter and looking the result up
among the words of that vector, so words with equal letters are never compared
with each other.

Spark's part: one pass counts words (summed per batch before the shuffle). A
sample of at most about ``SAMPLE`` words gives the upper levels of the trees, whose
leaves are cells; every word is a point of one cell and a query in each cell that
its search meets. A cell with more than ``POINTS`` points or ``QUERIES`` queries is
cut into a grid of parts, every query part against every point part. A task keeps
the points of one part, builds the lower levels over them and lets queries
stream by. The sample decides only where cells are cut, never which pairs are found.

Defined results: null and empty texts have no words; a null id counts as the text
''; repeated rows count again; very long runs are words like others; ties of a
form go to the smallest word in code-point order; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm.common import table, texts
from newsmetrics.session import materialize

SAMPLE = 100_000  # words that place the cuts of the upper levels
CELL = 1 << 15  # words a cell is meant to hold
LEAF = 32  # vectors in a leaf of a task's tree
POINTS = 1 << 16  # points of a part of a cell
QUERIES = 1 << 18  # queries of a part of a cell
BATCH = 4096  # queries searched at once
LETTERS = 26 + 64

#: Latin-1 byte to the letter's lower case (A-Z only), other bytes to a blank.
FOLDED = bytes(b | 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 0xC0 else 32 for b in range(256))
DIMENSION = np.array([b - 97 if 97 <= b <= 122 else max(b - 0xC0 + 26, 0) for b in range(256)], np.int64)
LETTER = [bytes([97 + d if d < 26 else 0xC0 + d - 26]) for d in range(LETTERS)]


def runs(text: str) -> list[bytes]:
    """Maximal runs of letters as Latin-1 bytes, one per code point; letters beyond Latin-1 end a run."""
    return text.encode("latin-1", "replace").translate(FOLDED).split()


def count_words(docs: DataFrame, every: int = 199, shortest: int = 6, least: int = 5) -> DataFrame:
    """(word, n) of all documents: lower-cased runs of at least ``shortest`` letters seen ``least`` times.

    A run whose crc32 with the document's id is divisible by ``every`` lacks one letter.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            seen: Counter = Counter()
            for key, text in zip(b.column("key").to_pylist(), texts(b)):
                start = zlib.crc32(f"{key}:".encode())
                for word, n in Counter(runs(text)).items():
                    if len(word) < shortest:
                        continue
                    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
                    if h % every == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < shortest:
                            continue
                    seen[word] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
                ["word", "n"])

    keyed = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("key"), "text")
    return keyed.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def vectors(words: list[bytes]) -> np.ndarray:
    """Letter counts, one row per word."""
    if not words:
        return np.zeros((0, LETTERS), np.int32)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    letters = DIMENSION[np.frombuffer(b"".join(words), np.uint8)]
    rows = np.repeat(np.arange(len(words)) * LETTERS, sizes)
    counts = np.bincount(rows + letters, minlength=len(words) * LETTERS).reshape(len(words), LETTERS)
    return counts.astype(np.int8 if sizes.max() < 127 else np.int32)


class Tree:
    """A k-d tree: inner nodes cut a dimension at a value (at most it: left), leaves are numbered.

    A node's box is what the cuts above it say, so vectors that were not there
    when the tree was built have a leaf too.
    """

    def __init__(self, points: np.ndarray, leaf: int):
        self.dim: list[int] = []
        self.cut: list[int] = []
        self.kids: list[tuple[int, int]] = []
        self.leaf: list[int] = []
        self.members: list[np.ndarray] = []
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        open_box = (np.zeros(LETTERS, np.int32), np.full(LETTERS, 1 << 30, np.int32))
        stack = [(np.arange(len(points)), open_box, -1, 0)]
        while stack:
            rows, (low, high), parent, side = stack.pop()
            node = len(self.dim)
            if parent >= 0:
                kids = self.kids[parent]
                self.kids[parent] = (node, kids[1]) if side == 0 else (kids[0], node)
            here = points[rows]
            least, most = (here.min(0), here.max(0)) if len(rows) else open_box
            self.low.append(low)
            self.high.append(high)
            self.kids.append((-1, -1))
            if len(rows) <= leaf or not (most > least).any():
                self.dim.append(-1)
                self.cut.append(0)
                self.leaf.append(len(self.members))
                self.members.append(rows)
                continue
            dim = int(here.var(0).argmax())
            values = here[:, dim]
            cut = min(int(np.median(values)), int(most[dim]) - 1)
            self.dim.append(dim)
            self.cut.append(cut)
            self.leaf.append(-1)
            below, above = high.copy(), low.copy()
            below[dim], above[dim] = cut, cut + 1
            stack.append((rows[values > cut], (above, high), node, 1))
            stack.append((rows[values <= cut], (low, below), node, 0))

    def place(self, points: np.ndarray) -> np.ndarray:
        """The leaf that holds each point."""
        out = np.zeros(len(points), np.int64)
        stack = [(0, np.arange(len(points)))]
        while stack:
            node, rows = stack.pop()
            if self.dim[node] < 0:
                out[rows] = self.leaf[node]
                continue
            left = points[rows, self.dim[node]] <= self.cut[node]
            for child, part in zip(self.kids[node], (rows[left], rows[~left])):
                if len(part):
                    stack.append((child, part))
        return out

    def reach(self, queries: np.ndarray, more: int, fewer: int) -> Iterator[tuple[int, np.ndarray]]:
        """(leaf, rows of ``queries``) whose box can hold the query plus ``more`` and minus ``fewer`` letters.

        A cut changes its box in one dimension, so only that one's share of the letters that
        lack or are spare is computed anew.
        """
        none = np.zeros(len(queries), np.int32)
        stack = [(0, np.arange(len(queries)), none, none)]
        while stack:
            node, rows, lacks, spare = stack.pop()
            dim, cut = self.dim[node], self.cut[node]
            if dim < 0:
                yield self.leaf[node], rows
                continue
            here = queries[rows, dim].astype(np.int32)
            left, right = self.kids[node]
            over = spare + np.maximum(here - cut, 0) - np.maximum(here - self.high[node][dim], 0)
            keep = over <= fewer
            if keep.any():
                stack.append((left, rows[keep], lacks[keep], over[keep]))
            under = lacks + np.maximum(cut + 1 - here, 0) - np.maximum(self.low[node][dim] - here, 0)
            keep = under <= more
            if keep.any():
                stack.append((right, rows[keep], under[keep], spare[keep]))


def unary(vecs: np.ndarray) -> np.ndarray:
    """Letter counts as bits, the first four of each letter: differing bits are at most the L1 distance."""
    bits = vecs[:, :, None] > np.arange(4)
    return np.packbits(np.pad(bits.reshape(len(vecs), -1), ((0, 0), (0, 24))), 1).view(np.uint64)


class Part:
    """Points of one part of a cell, ready for queries."""

    def __init__(self, words: list[bytes], counts: list[int]):
        vecs = vectors(words)
        rows = np.ascontiguousarray(vecs).view(np.dtype((np.void, vecs.dtype.itemsize * LETTERS))).ravel()
        _, first, group = np.unique(rows, return_index=True, return_inverse=True)
        self.vecs = vecs[first].astype(np.int32)
        self.bits = unary(self.vecs)
        self.words: list[dict[bytes, int]] = [{} for _ in first]
        for g, w, n in zip(group.tolist(), words, counts):
            self.words[g][w] = n
        self.tree = Tree(self.vecs, LEAF)
        self.size = len(words[0])

    def pairs(self, words: list[bytes]) -> Iterator[tuple[int, bytes, int]]:
        """(row of ``words``, near word, its count); a replacement is found from its smaller letter only."""
        size = len(words[0])
        vecs = vectors(words).astype(np.int32)
        bits, apart = unary(vecs), 2 if size == self.size else 1
        for leaf, rows in self.tree.reach(vecs, apart - 1, 1):
            members = self.tree.members[leaf]
            hit_q, hit_p = np.nonzero(np.bitwise_count(bits[rows][:, None] ^ self.bits[members]).sum(2, np.uint16) <= apart)
            moved = self.vecs[members[hit_p]] - vecs[rows[hit_q]]
            near = np.abs(moved).sum(1) == apart
            hit_q, hit_p, moved = hit_q[near], hit_p[near], moved[near]
            if not len(hit_q):
                continue
            gone = moved.argmin(1)
            come = moved.argmax(1) if size == self.size else np.full(len(gone), -1)
            wanted = (come < 0) | (gone < come)
            for q, p, a, b in zip(rows[hit_q[wanted]].tolist(), members[hit_p[wanted]].tolist(),
                                  gone[wanted].tolist(), come[wanted].tolist()):
                known, word, letter = self.words[p], words[q], LETTER[a]
                new = LETTER[b] if b >= 0 else b""
                last, at = None, word.find(letter)
                while at >= 0:
                    made = word[:at] + new + word[at + 1:]
                    if made != last and made in known:
                        yield q, made, known[made]
                    last = made
                    at = word.find(letter, at + 1)


def upper_trees(words: DataFrame) -> dict[int, Tree]:
    """One tree per word length over a sample; its leaves are meant to hold ``CELL`` words."""
    total = words.count()
    share = min(1.0, SAMPLE / max(total, 1))
    picked = words.where(F.abs(F.xxhash64("word") % 1_000_003) < int(share * 1_000_003) + 1).select("word").toArrow()
    by_length: dict[int, list[bytes]] = {}
    for w in picked.column("word").to_pylist():
        by_length.setdefault(len(w), []).append(w.encode("latin-1"))
    return {size: Tree(vectors(ws), max(8, int(CELL * share))) for size, ws in by_length.items()}


def routed(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """(size, cell, query, word, n): each word as a point of its cell and as a query of the cells that it reaches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [w.encode("latin-1") for w in b.column("word").to_pylist()]
            sizes = np.fromiter(map(len, raw), np.int64, len(raw))
            for size in np.unique(sizes).tolist():
                rows = np.flatnonzero(sizes == size)
                vecs = vectors([raw[r] for r in rows.tolist()])
                own = trees.get(size)
                out = [(size, own.place(vecs) if own else np.zeros(len(rows), np.int64), rows, False)]
                for other, more in ((size, 1), (size - 1, 0)):
                    tree = trees.get(other)
                    found = tree.reach(vecs, more, 1) if tree else [(0, np.arange(len(rows)))]
                    out += [(other, np.full(len(q), leaf), rows[q], True) for leaf, q in found]
                for other, cell, rows_out, query in out:
                    take = pa.array(rows_out)
                    k = len(rows_out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(k, other)), pa.array(cell.astype(np.int64)), pa.array(np.full(k, query)),
                         b.column("word").take(take), b.column("n").take(take)],
                        ["size", "cell", "query", "word", "n"])

    return words.mapInArrow(run, "size long, cell long, query boolean, word string, n long")


def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per part, points first: each word's number of near words and the most frequent one found there."""
    key, points, part = None, ([], []), None
    best: dict[bytes, list] = {}

    def note(word: bytes, other: bytes, n: int) -> None:
        have = best.get(word)
        if have is None:
            best[word] = [1, n, other]
        else:
            have[0] += 1
            if n > have[1] or (n == have[1] and other < have[2]):
                have[1], have[2] = n, other

    def flush() -> Iterator[pa.RecordBatch]:
        if best:
            k, n, w = zip(*best.values())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x.decode("latin-1") for x in best], pa.string()), pa.array(k, pa.int64()),
                 pa.array(n, pa.int64()), pa.array([x.decode("latin-1") for x in w], pa.string())],
                ["word", "k", "best_n", "best"])
            best.clear()

    for b in batches:
        keys = np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("size", "cell", "a", "b", "query")], 1).astype(np.int64)
        words = [w.encode("latin-1") for w in b.column("word").to_pylist()]
        counts = b.column("n").to_pylist()
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(words)]
        for start, end in zip(edges, edges[1:]):
            if start == end:
                continue
            here = tuple(keys[start, :4].tolist())
            if here != key:
                key, points, part = here, ([], []), None
            if not keys[start, 4]:
                points[0].extend(words[start:end])
                points[1].extend(counts[start:end])
                continue
            if not points[0]:
                continue  # queries of a part without points
            part = part or Part(*points)
            by_size: dict[int, list[int]] = {}
            for r in range(start, end):
                by_size.setdefault(len(words[r]), []).append(r)
            for rows in by_size.values():
                for at in range(0, len(rows), BATCH):
                    some = rows[at:at + BATCH]
                    for q, other, n in part.pairs([words[r] for r in some]):
                        note(words[some[q]], other, n)
                        note(other, words[some[q]], counts[some[q]])
            if len(best) > 1 << 16:
                yield from flush()
    yield from flush()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best_n, best) of every word of (word, n) with a word one edit away."""
    spark = words.sparkSession
    rows = materialize(routed(words, upper_trees(words)), "spelling-cells")
    load = rows.groupBy("size", "cell").agg(
        F.ceil(F.sum(F.when(F.col("query"), 0).otherwise(1)) / POINTS).cast("int").alias("parts"),
        F.ceil(F.sum(F.when(F.col("query"), 1).otherwise(0)) / QUERIES).cast("int").alias("query_parts"))
    load = load.where("parts > 0 and query_parts > 0")
    h = F.xxhash64("word")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    only = lambda n: F.array(F.pmod(h, F.col(n)).cast("int"))
    grid = (rows.join(load, ["size", "cell"])
            .select("size", "cell", "query", "word", "n", "query_parts", F.explode(
                F.when(F.col("query"), every("parts")).otherwise(only("parts"))).alias("a"))
            .select("size", "cell", "a", "query", "word", "n", F.explode(
                F.when(F.col("query"), only("query_parts")).otherwise(every("query_parts"))).alias("b")))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = (grid.repartition(parts, "size", "cell", "a", "b")
               .sortWithinPartitions("size", "cell", "a", "b", "query"))
    found = ordered.select("size", "cell", "a", "b", "query", "word", "n").mapInArrow(
        search, "word string, k long, best_n long, best string")
    return (found.groupBy("word").agg(F.sum("k").alias("n_near"),
                                      F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("top"))
            .select("word", "n_near", (-F.col("top.m")).alias("best_n"), F.col("top.best").alias("best")))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms followed to the last. Each round doubles the steps.

    A form is at least five times as frequent as its word, so a chain is no longer than
    the logarithm of the largest count.
    """
    now = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        then = now.select(F.col("word").alias("via"), F.col("root").alias("onward"))
        step = materialize(now.join(then, now["root"] == then["via"], "left")
                           .select("word", F.coalesce("onward", "root").alias("root"),
                                   F.col("onward").isNotNull().alias("moved")), "spelling-roots")
        now = step.select("word", "root")
        if not step.where("moved").take(1):
            return now


def spelling_groups(docs: DataFrame, times: int = 5, **counting) -> DataFrame:
    """One row per word: its form, the root of its forms and its near words."""
    words = materialize(count_words(docs, **counting), "spelling-words")
    near = materialize(near_words(words), "spelling-near")
    w = words.alias("w").join(near.alias("x"), F.col("w.word") == F.col("x.word"), "left")
    ok = F.col("best_n") >= times * F.col("n")
    judged = w.select(F.col("w.word").alias("word"), F.when(ok, F.col("best")).alias("form"), "n",
                      F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                      F.when(ok, F.col("best_n")).alias("form_n"))
    judged = materialize(judged, "spelling-forms")
    r = roots(judged.where("form is not null")).select(F.col("word").alias("of"), "root")
    return (judged.join(r, judged["word"] == r["of"], "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))


def op11_spelling_variants(spark, sf_dir: str) -> DataFrame:
    return spelling_groups(table(spark, sf_dir, "documents"))


#: crc32 bit by bit, then near words over texts with one code point left out. A replacement
#: leaves the same rest at the same place; a deletion leaves the shorter word.
OP11_SQL = r"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS key,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
per_doc AS (SELECT key, run, count(*) AS c FROM runs WHERE length(run) >= 6 GROUP BY key, run),
hashed AS (SELECT run, c, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, [ ('0x' || x)::BIGINT FOR x IN regexp_extract_all(hex(encode(key || run)), '..') ]),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda r, i: xor(r >> 1, (r & 1) * 3988292384)))) AS h FROM per_doc),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN run[1:(h % length(run))] || run[(h % length(run)) + 2:] ELSE run END AS word, c
    FROM hashed) WHERE length(word) >= 6 GROUP BY word HAVING sum(c) >= 5),
places AS (SELECT word, n, length(word) AS size, unnest(range(length(word))) AS pos FROM words),
rests AS (SELECT word, n, size, pos, word[1:pos] || word[pos + 2:] AS rest FROM places),
pairs AS (SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM rests a JOIN rests b
            ON a.size = b.size AND a.pos = b.pos AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT r.word, r.n, w.word, w.n FROM rests r JOIN words w ON r.rest = w.word
          UNION SELECT w.word, w.n, r.word, r.n FROM rests r JOIN words w ON r.rest = w.word),
tops AS (SELECT word, n, count(*) AS n_near, min({'m': -m, 'o': other}) AS top FROM pairs GROUP BY word, n),
judged AS (SELECT w.word, w.n, coalesce(t.n_near, 0) AS n_near,
                  CASE WHEN -t.top.m >= 5 * w.n THEN t.top.o END AS form,
                  CASE WHEN -t.top.m >= 5 * w.n THEN -t.top.m END AS form_n
           FROM words w LEFT JOIN tops t ON w.word = t.word),
chain AS (SELECT word, word AS root, form FROM judged
          UNION ALL SELECT c.word, j.word, j.form FROM chain c JOIN judged j ON c.form = j.word)
SELECT j.word, j.form, c.root, j.n, j.n_near, j.form_n
FROM judged j JOIN chain c ON c.word = j.word AND c.form IS NULL
"""
