"""Operator 13, ranked lexical search by bit-sliced Bloom signatures.

Index. Documents of similar size form shards. A document's signature is a Bloom
filter of (term, level): a term that occurs tf times is entered at every level of
``LEVELS`` up to tf. The signatures of a shard lie sliced: one bitmap over its
documents per bit position. A shard also holds its documents' terms and counts.

Search. For a query term the bitmaps of its positions are intersected; the result
holds every document with that term (and a few others), and the levels bound its
count from above. Weighted sums of these slices are upper bounds of all scores in
the shard. The documents with the highest bounds are scored exactly first; then
all whose bound is not below the 10th best exact score that the task has seen. A task
returns its best documents per item and Spark merges them, so the result is exact:
false presences and levels only cost time.

Spark's part: one pass over texts writes the shards; N, L and the document
frequencies of the query terms are aggregates over shard columns; items are taken in
blocks (``ITEMS`` rows, ``ITEM_BYTES`` of text), each block one pass over the shards. Tops
are merged in two steps, by (item, salt) and by item. Memory per task is bounded by a
flush of ``ENTRIES`` entries or one document, and by a shard times the block's terms.

Defined results: null and empty texts and items have no terms and no rows; repeated
rows of documents are documents of their own; rows of one item id form one item with the
terms of its distinct texts; null doc ids are scored and come last among equal scores; whole
texts count, however long; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsmetrics.llm.common import mix, table, texts
from newsmetrics.session import materialize

BITS = 10  # signature bits per entry of a shard's largest document
HASHES = 5
LEVELS = np.array([1, 2, 3, 4, 6, 9, 14, 21, 32, 48, 72, 108, 162, 243, 1 << 62], np.int64)
SHARD_DOCS = 1024
SHARD_BITS = 1 << 22
ENTRIES = 1 << 20  # entries gathered before shards are made
ITEMS = 500  # query items of one block
ITEM_BYTES = 1 << 18  # and their text
SALTS = 64
TOP = 10

#: Term bytes: digits, a-z, A-Z folded, and everything beyond ASCII; the rest separates.
FOLDED = bytes(b | 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
SHARD = ("ids array<long>, docs long, n_terms long, sizes binary, tops binary, width long, slices binary, "
         "vocabulary binary, frequencies binary, ends binary, term_ids binary, counts binary")


def terms(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLDED).split()


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter((xxhash.xxh3_64_intdigest(w) for w in words), np.uint64, len(words))


def positions(hashed: np.ndarray, level: int, width: int) -> np.ndarray:
    """Bit positions of (term, level), one row per term."""
    h = mix(hashed + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2 ** 64))
    start, step = h >> np.uint64(32), (h & np.uint64(0xFFFFFFFF)) | np.uint64(1)
    return ((start[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(width)).astype(np.int64)


def narrow(values: np.ndarray) -> bytes:
    """Bytes of the values in the smallest unsigned type, which the first byte names."""
    top = int(values.max()) if len(values) else 0
    kind = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
    return bytes([kind]) + values.astype(f"<u{kind}").tobytes()


def widen(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, f"<u{raw[0]}", offset=1).astype(np.int64)


class Gathered:
    """Documents on their way into shards."""

    def __init__(self) -> None:
        self.ids: list[int | None] = []
        self.known: dict[bytes, int] = {}
        self.term_ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.entries = 0

    def add(self, doc_id: int | None, text: str) -> None:
        seen = Counter(terms(text))
        if not seen:
            return
        known = self.known
        self.ids.append(doc_id)
        self.term_ids.append(np.fromiter((known.setdefault(t, len(known)) for t in seen), np.int64, len(seen)))
        self.counts.append(np.fromiter(seen.values(), np.int64, len(seen)))
        self.entries += len(seen)

    def shards(self) -> Iterator[tuple]:
        """Cut from the largest document down, so that a shard's signatures are about equally full."""
        words = list(self.known)
        hashed = hashes(words)
        levels = [np.searchsorted(LEVELS, c, "right") for c in self.counts]
        entered = np.array([int(x.sum()) for x in levels])
        order = np.argsort(-entered, kind="stable")
        at = 0
        while at < len(order):
            width = max(64, BITS * int(entered[order[at]]))
            end = at + 1
            while end < len(order) and end - at < SHARD_DOCS and (end - at + 1) * width <= SHARD_BITS \
                    and 2 * BITS * entered[order[end]] >= width:
                end += 1
            yield self.shard(order[at:end].tolist(), width, words, hashed, levels)
            at = end

    def shard(self, docs: list[int], width: int, words: list[bytes], hashed: np.ndarray, levels: list[np.ndarray]) -> tuple:
        ends = np.cumsum([len(self.counts[d]) for d in docs])
        row = np.repeat(np.arange(len(docs)), np.diff(ends, prepend=0))
        term, count = np.concatenate([self.term_ids[d] for d in docs]), np.concatenate([self.counts[d] for d in docs])
        level = np.concatenate([levels[d] for d in docs])
        dense = np.zeros((width, -(-len(docs) // 8) * 8), np.uint8)
        for k in range(int(level.max())):
            here = level > k
            dense[positions(hashed[term[here]], k, width), row[here][:, None]] = 1
        used, own = np.unique(term, return_inverse=True)
        sizes = np.add.reduceat(count, np.concatenate(([0], ends[:-1])))
        tops = np.maximum.reduceat(count, np.concatenate(([0], ends[:-1])))
        return ([self.ids[d] for d in docs], len(docs), int(sizes.sum()), narrow(sizes), narrow(tops), width,
                np.packbits(dense, 1).tobytes(), b" ".join([words[u] for u in used.tolist()]),
                narrow(np.bincount(own)), narrow(ends), narrow(own), narrow(count))


def build_index(docs: DataFrame) -> DataFrame:
    """One row per shard; together they hold every document that has a term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush() -> Iterator[pa.RecordBatch]:
            for shard in gathered.shards():
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(shard, kinds)], names)

        names = [part.split()[0] for part in SHARD.split(", ")]
        kinds = [pa.list_(pa.int64()), *[pa.int64()] * 2, *[pa.binary()] * 2, pa.int64(), *[pa.binary()] * 6]
        gathered = Gathered()
        for b in batches:
            for doc_id, text in zip(b.column("doc_id").to_pylist(), texts(b)):
                gathered.add(doc_id, text)
                if gathered.entries >= ENTRIES or len(gathered.ids) >= 8 * SHARD_DOCS:
                    yield from flush()
                    gathered = Gathered()
        yield from flush()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, SHARD)


class Query:
    """A block of items: their terms, weights and the positions of terms in each item."""

    def __init__(self, items: list[tuple[int | None, Counter]]):
        self.words = sorted({t for _, c in items for t in c})
        self.place = {t: k for k, t in enumerate(self.words)}
        self.ids = [i for i, _ in items]
        self.of = [np.array([self.place[t] for t in c], np.int64) for _, c in items]
        self.times = [np.array(list(c.values()), np.int64) for _, c in items]
        self.weights = np.zeros(len(self.words), np.int64)

    def weigh(self, n: int, frequencies: dict[bytes, int]) -> None:
        for t, df in frequencies.items():
            self.weights[self.place[t]] = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def frequencies(index: DataFrame, query: Query) -> dict[bytes, int]:
    """Documents that hold each term of the block; reads the shards' vocabularies only."""
    place = query.place

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            total: Counter = Counter()
            for raw, df in zip(b.column("vocabulary").to_pylist(), b.column("frequencies").to_pylist()):
                for t, n in zip(raw.split(b" "), widen(df).tolist()):
                    if t in place:
                        total[t] += n
            yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.binary()), pa.array(list(total.values()), pa.int64())],
                                             ["term", "n"])

    found = index.select("vocabulary", "frequencies").mapInArrow(run, "term binary, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {bytes(r["term"]): r["n"] for r in found.collect()}  # at most the block's terms


def gain(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """The part of a term's score that its count and the document's size give."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


class Shard:
    """One shard under a block of items."""

    def __init__(self, row: dict, query: Query, hashed: np.ndarray, n: int, length: int):
        self.ids, self.query = row["ids"], query
        self.tops = widen(row["tops"])
        sizes = widen(row["sizes"])
        self.m = 25 + (75 * sizes * n) // length if sizes.max() < 1 << 30 and n < 1 << 26 else \
            np.array([25 + 75 * s * n // length for s in sizes.tolist()], np.int64)
        slices = np.frombuffer(row["slices"], np.uint8).reshape(row["width"], -1)
        self.bounds_of(slices, row["width"], hashed)
        place = query.place
        asked = np.array([place.get(t, -1) for t in row["vocabulary"].split(b" ")], np.int64)
        ends = widen(row["ends"])
        doc = np.repeat(np.arange(len(ends)), np.diff(ends, prepend=0))
        term = asked[widen(row["term_ids"])]
        keep = term >= 0
        keys = doc[keep] * len(query.words) + term[keep]
        order = np.argsort(keys)
        self.keys, self.counts = keys[order], widen(row["counts"])[keep][order]

    def bounds_of(self, slices: np.ndarray, width: int, hashed: np.ndarray) -> None:
        """Upper bounds of every term's gain in every document."""
        docs = len(self.ids)
        level = np.zeros((len(hashed), docs), np.uint8)
        alive = np.arange(len(hashed))
        for k in range(int(np.searchsorted(LEVELS, self.tops.max(), "right"))):
            here = np.bitwise_and.reduce(slices[positions(hashed[alive], k, width)], 1)
            some = here.any(1)
            alive = alive[some]
            if not len(alive):
                break
            level[alive] += np.unpackbits(here[some], 1)[:, :docs] & (level[alive] == k)
        most = np.minimum(LEVELS[:, None] - 1, self.tops)  # a count at level k is below the next level's
        self.present = level.any(1)
        self.row = np.cumsum(self.present) - 1
        by_level, level = gain(most, self.m).astype(np.float32), level[self.present]
        self.gains = np.empty(level.shape, np.float32)
        for at in range(0, len(level), 256):
            self.gains[at:at + 256] = by_level[level[at:at + 256], np.arange(docs)]

    def bounds(self, item: int) -> np.ndarray:
        """Weighted sum of the item's slices, rounded up."""
        of = self.query.of[item]
        there = self.present[of]
        weights = (self.query.weights[of] * self.query.times[item])[there].astype(np.float32)
        return (weights @ self.gains[self.row[of[there]]]).astype(np.float64) * 1.0001 + 1

    def exact(self, item: int, docs: np.ndarray) -> np.ndarray:
        of = self.query.of[item]
        if not len(self.keys):
            return np.zeros(len(docs), np.int64)
        wanted = docs[:, None] * len(self.query.words) + of
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        tf = np.where(self.keys[at] == wanted, self.counts[at], 0)
        return (gain(tf, self.m[docs][:, None]) * (self.query.weights[of] * self.query.times[item])).sum(1)


def best_documents(index: DataFrame, query: Query, n: int, length: int, top: int) -> DataFrame:
    """(item, doc_id, score): per item at least its ``top`` best documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashed = hashes(query.words)
        best: list[list[tuple]] = [[] for _ in query.ids]

        def score(shard: Shard, item: int, docs: np.ndarray) -> None:
            for d, s in zip(docs.tolist(), shard.exact(item, docs).tolist()):
                if s > 0:
                    i = shard.ids[d]
                    best[item].append((-s, i is None, i or 0))
            best[item].sort()
            del best[item][top:]

        for b in batches:
            for row in b.to_pylist():
                shard = Shard(row, query, hashed, n, length)
                for item in range(len(query.ids)):
                    bounds = shard.bounds(item)
                    least = -best[item][-1][0] if len(best[item]) == top else 2
                    may = np.flatnonzero(bounds >= least)
                    if not len(may):
                        continue
                    if len(may) > top:
                        may = may[np.argsort(-bounds[may])]
                    score(shard, item, may[:top])
                    if len(may) > top:
                        least = -best[item][-1][0] if len(best[item]) == top else 2
                        rest = may[top:]
                        score(shard, item, rest[bounds[rest] >= least])
        rows = [(k, None if none else d, -s) for k, found in enumerate(best) for s, none, d in found]
        k, d, s = zip(*rows) if rows else ((), (), ())
        yield pa.RecordBatch.from_arrays([pa.array(k, pa.int64()), pa.array(d, pa.int64()), pa.array(s, pa.int64())],
                                         ["item", "doc_id", "score"])

    return index.mapInArrow(run, "item long, doc_id long, score long")


def blocks(items: DataFrame) -> Iterator[list[tuple[int | None, Counter]]]:
    """Items as term counts, in blocks."""
    grouped = items.select(F.col("item_id").cast("long"), "text").distinct().orderBy("item_id", "text")
    block: list[tuple[int | None, Counter]] = []
    size = 0
    for r in grouped.toLocalIterator():
        found = Counter(terms(r["text"] or ""))
        if block and block[-1][0] == r["item_id"]:
            block[-1][1].update(found)
        else:
            if len(block) >= ITEMS or size >= ITEM_BYTES:
                yield block
                block, size = [], 0
            block.append((r["item_id"], found))
        size += len(r["text"] or "")
    if block:
        yield block


def ranked_search(index: DataFrame, items: DataFrame, top: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score) of each item's best documents; ``index`` is a written table of shards."""
    spark: SparkSession = index.sparkSession
    n, length = index.agg(F.coalesce(F.sum("docs"), F.lit(0)), F.coalesce(F.sum("n_terms"), F.lit(0))).first()
    found = spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    for block in blocks(items) if n else ():
        query = Query(block)
        if not query.words:
            continue
        query.weigh(n, frequencies(index, query))
        rows = best_documents(index, query, n, length, top)
        order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
        salt = F.pmod(F.xxhash64("doc_id"), F.lit(SALTS))
        some = (rows.withColumn("place", F.row_number().over(Window.partitionBy("item", salt).orderBy(*order)))
                .where(F.col("place") <= top))
        whole = (some.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order)))
                 .where(F.col("rank") <= top))
        ids = spark.createDataFrame(list(enumerate(query.ids)), "at long, item_id long")
        whole = whole.join(F.broadcast(ids), F.col("item") == F.col("at")).select("item_id", "rank", "doc_id", "score")
        found = found.unionAll(materialize(whole, "search-block"))
    return found


def op13_bitsliced_search(spark, sf_dir: str) -> DataFrame:
    index = materialize(build_index(table(spark, sf_dir, "documents")), "search-index")
    return ranked_search(index, table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r,
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
places AS (SELECT r, unnest(terms) AS term FROM docs),
tf AS (SELECT r, term, count(*) AS tf FROM places GROUP BY r, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
sizes AS (SELECT r, count(*) AS n FROM places GROUP BY r),
whole AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes),
items AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)),
asked AS (SELECT item_id, term, count(*) AS times FROM items GROUP BY item_id, term),
weighed AS (SELECT item_id, term, times * CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
            FROM asked JOIN df USING (term), whole),
scored AS (SELECT q.item_id, t.r, CAST(sum(q.w * ((1000000000 * t.tf) // (1000 * t.tf + 8 * (25 + (75 * s.n * n_docs) // n_terms)))) AS BIGINT) AS score
           FROM weighed q JOIN tf t USING (term) JOIN sizes s ON s.r = t.r, whole GROUP BY q.item_id, t.r),
ranked AS (SELECT item_id, doc_id, score,
                  row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
           FROM scored JOIN docs USING (r) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
