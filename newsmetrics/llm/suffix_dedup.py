"""Operator 1, suffix-array dedup: remove bytes of strings of SPAN bytes that also start elsewhere.

Every window of SPAN bytes is named by its anchor, the GRAM-byte string in it with
the smallest hash (the leftmost of equal ones). Equal windows have equal anchors at
equal offsets, so only windows with one anchor need be compared, and the windows
of one anchor in a text form a run.

1. A pass over the texts makes one row per run: hash of the anchor, hash of the
   run's bytes, place. Runs whose anchor occurs once in the corpus hold no repeats.
2. Runs with equal bytes are repeats as a whole; no bytes move for them.
3. For anchors with several different runs, one copy of each is dealt by anchor to
   buckets of bounded size. There all windows' suffixes are sorted: mergesort over
   runs of doubling length, each element ranked in the sibling run by binary search,
   each comparison finding the common extension by binary search over prefix hashes.
   Neighbours that agree in SPAN bytes are verified byte by byte. Anchors with more
   than BUCKET runs are not sorted in one task: their windows are counted by two
   64-bit hashes, which Spark combines map-side.
4. The repeated stretches return to their texts.

Defined results: null text counts as empty; texts shorter than SPAN keep all;
rows that repeat count as copies of each other and get a row each; null ids stay;
texts of any length take part in whole, cut at no place; other columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm.common import mix, table
from newsmetrics.session import materialize

SPAN, GRAM = 200, 32
GRAMS = SPAN - GRAM + 1  # anchors to choose from in a window
STEP = 1 << 15  # window starts that are worked through at a time
BUCKET = 4096  # different runs in a bucket
FILTER_BITS = 1 << 26  # size of the filter that says which anchors' bytes are wanted
RUNS = "anchor long, bytes_hash long, key long, key2 long, start int, n int, offset int"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
_POWERS: dict[str, np.ndarray] = {}


def _powers(size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    if len(_POWERS.get("power", ())) < size:
        base = 0xD1342543DE82EF95
        for name, b in (("power", base), ("inverse", pow(base, -1, 2 ** 64))):
            steps = np.full(size, b, np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
        rng = np.random.Generator(np.random.PCG64(7))
        _POWERS["value"] = rng.integers(1, 2 ** 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    return _POWERS["value"], _POWERS["power"], _POWERS["inverse"]


class Prefixes:
    """Prefix polynomial hashes of a byte array; the hash of any stretch in constant time."""

    def __init__(self, raw: np.ndarray):
        value, power, self.inverse = _powers(max(len(raw) + 1, STEP + 2 * SPAN))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value[raw] * power[:len(raw)])))

    def of(self, start: np.ndarray, size) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]


def _runs(raw: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(anchor hash, bytes hash, start, n, offset of the anchor) of the runs of one text."""
    for at in range(0, len(raw) - SPAN + 1, STEP):
        piece = raw[at:at + STEP + SPAN - 1]
        hashes = Prefixes(piece)
        grams = mix(hashes.of(np.arange(len(piece) - GRAM + 1), GRAM))
        best = grams & np.uint64(2 ** 64 - 2 ** 16) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while 2 * width <= GRAMS:
            best = np.minimum(best[:-width], best[width:])
            width *= 2
        best = np.minimum(best[:len(best) - (GRAMS - width)], best[GRAMS - width:])
        place = (best & np.uint64(2 ** 16 - 1)).astype(np.int64)
        start = np.flatnonzero(np.concatenate(([True], place[1:] != place[:-1])))
        n = np.diff(np.append(start, len(place)))
        place = place[start]
        yield grams[place], mix(hashes.of(start, n + SPAN - 1) + n.astype(np.uint64)), start + at, n, place - start


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    return docs.select(F.col("doc_id").cast("long"), text.alias("text"), F.xxhash64(text).alias("key"),
                       F.xxhash64(F.lit(1), text).alias("key2"))


def find_runs(keyed: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found, owner = [], []
            for i, t in enumerate(b.column("text").to_pylist()):
                for part in _runs(np.frombuffer(_raw(t), np.uint8)):
                    found.append(part)
                    owner.append(np.full(len(part[0]), i))
            if not found:
                continue
            anchor, content, start, n, offset = (np.concatenate(c) for c in zip(*found))
            rows = np.concatenate(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)),
                 b.column("key").take(pa.array(rows)), b.column("key2").take(pa.array(rows)),
                 *(pa.array(c.astype(np.int32)) for c in (start, n, offset))],
                ["anchor", "bytes_hash", "key", "key2", "start", "n", "offset"])

    return keyed.select("text", "key", "key2").mapInArrow(run, RUNS)


def _bit(anchor: np.ndarray) -> np.ndarray:
    return (mix(anchor ^ np.uint64(0x5851F42D4C957F2D)) % np.uint64(FILTER_BITS)).astype(np.int64)


def wanted_filter(wanted: DataFrame) -> np.ndarray:
    """A bitmap of FILTER_BITS bits with the bits of all wanted anchors set; its size does not grow.

    Beyond some ten million anchors it lets most pass, which only costs bytes: the
    exact test is the join that follows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bits = np.unique(_bit(b.column("anchor").to_numpy(zero_copy_only=False).view(np.uint64)))
            yield pa.RecordBatch.from_arrays([pa.array(bits >> 13), pa.array((bits & 8191).astype(np.int32))],
                                             ["page", "bit"])

    pages = (wanted.select("anchor").mapInArrow(run, "page long, bit int").groupBy("page")
             .agg(F.collect_set("bit").alias("bits")))  # at most 8,192 bits a page
    packed = pages.mapInArrow(_pack, "page long, bits binary")
    out = np.zeros(FILTER_BITS // 8, np.uint8)
    for r in packed.toLocalIterator():
        out[r["page"] * 1024:(r["page"] + 1) * 1024] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        packed = []
        for bits in b.column("bits").to_pylist():
            page = np.zeros(8192, np.uint8)
            page[bits] = 1
            packed.append(np.packbits(page).tobytes())
        yield pa.RecordBatch.from_arrays([b.column("page"), pa.array(packed, pa.binary())], ["page", "bits"])


def run_bytes(keyed: DataFrame, bits) -> DataFrame:
    """anchor, bytes_hash, offset and bytes of the runs whose anchor passes the filter, once a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passes = bits.value
        for b in batches:
            rows: dict[tuple[int, int], tuple[int, bytes]] = {}
            for t in b.column("text").to_pylist():
                raw = _raw(t)
                for anchor, content, start, n, offset in _runs(np.frombuffer(raw, np.uint8)):
                    bit = _bit(anchor)
                    hit = np.flatnonzero(passes[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8) & 1)
                    for k in hit.tolist():
                        key = int(anchor[k]), int(content[k])
                        if key not in rows:
                            at = int(start[k])
                            rows[key] = int(offset[k]), raw[at:at + int(n[k]) + SPAN - 1]
            keys = np.array(list(rows), np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0].copy()), pa.array(keys[:, 1].copy()),
                 pa.array([v[0] for v in rows.values()], pa.int32()), pa.array([v[1] for v in rows.values()], pa.binary())],
                ["anchor", "bytes_hash", "offset", "raw"])

    return keyed.select("text").mapInArrow(run, "anchor long, bytes_hash long, offset int, raw binary")


def common_extension(h: Prefixes, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length, up to SPAN, in which the suffixes at ``a`` and ``b`` agree."""
    low, high = np.zeros(len(a), np.int64), np.full(len(a), SPAN)
    same = h.of(a, SPAN) == h.of(b, SPAN)
    low[same] = SPAN
    while (left := np.flatnonzero(low < high)).size:
        middle = (low[left] + high[left] + 1) // 2
        agree = h.of(a[left], middle) == h.of(b[left], middle)
        low[left[agree]] = middle[agree]
        high[left[~agree]] = middle[~agree] - 1
    return low


def before(raw: np.ndarray, h: Prefixes, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
    """Whether the suffix at ``a`` sorts before that at ``b`` (or is equal, where asked)."""
    size = common_extension(h, a, b)
    inside = np.minimum(size, SPAN - 1)
    return np.where(size == SPAN, or_equal, raw[a + inside] < raw[b + inside])


def merge_sort(raw: np.ndarray, h: Prefixes, suffix: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes ordered within their groups, and the groups in order.

    Bottom-up: runs of doubling length, all groups at once. Every element keeps its
    place in its own run and adds the number of elements of the sibling run before it.
    """
    order = np.argsort(group, kind="stable")
    suffix, group = suffix[order], group[order]
    first = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(first, len(group)))
    base, room = np.repeat(first, size), np.repeat(size, size)
    place = np.arange(len(group)) - base
    run = 1
    while (live := np.flatnonzero(room > run)).size:
        p, b, end = place[live], base[live], room[live]
        own = p // run * run
        right = (own // run) % 2 == 1
        other = np.where(right, own - run, own + run)
        low = np.minimum(other, end)
        start, high = low.copy(), np.minimum(other + run, end)
        while (open_ := np.flatnonzero(low < high)).size:
            middle = (low[open_] + high[open_]) // 2
            mine, its = suffix[live[open_]], suffix[b[open_] + middle]
            # equal elements of the left run come first
            less = before(raw, h, its, mine, right[open_])
            low[open_[less]] = middle[less] + 1
            high[open_[~less]] = middle[~less]
        target = b + np.where(right, own - run, own) + (p - own) + (low - start)
        moved = suffix.copy()
        moved[target] = suffix[live]
        suffix = moved
        run *= 2
    return suffix, group


def repeated_windows(rows: list[bytes], anchor: np.ndarray, offset: np.ndarray) -> list[np.ndarray]:
    """Per run, which of its windows equal a window of another run."""
    size = np.array([len(r) for r in rows])
    begin = np.concatenate(([0], np.cumsum(size)))
    raw = np.frombuffer(b"".join(rows), np.uint8)
    h = Prefixes(raw)
    count = size - SPAN + 1
    owner = np.repeat(np.arange(len(rows)), count)
    inner = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    suffix = begin[owner] + inner
    _, name = np.unique(anchor, return_inverse=True)
    group = name[owner] * (2 * STEP) + offset[owner] - inner + STEP
    by, groups = merge_sort(raw, h, suffix, group)
    pair = np.flatnonzero((groups[1:] == groups[:-1]) & (h.of(by[:-1], SPAN) == h.of(by[1:], SPAN)))
    window = np.lib.stride_tricks.sliding_window_view(raw, SPAN)
    sure = [pair[k:k + 100_000][(window[by[pair[k:k + 100_000]]] == window[by[pair[k:k + 100_000] + 1]]).all(1)]
            for k in range(0, len(pair), 100_000)]
    pair = np.concatenate(sure) if sure else pair
    hit = np.zeros(len(raw) + 1, bool)
    hit[by[pair]] = hit[by[pair + 1]] = True
    return [hit[a:a + n] for a, n in zip(begin, count)]


def _stretches(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], hit.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def sorted_repeats(contents: DataFrame, buckets: int) -> DataFrame:
    """anchor, bytes_hash, first, last: stretches of repeated windows, found by suffix sort."""
    def sort(t: pa.Table) -> pa.Table:
        anchor, content = (t.column(c).to_numpy() for c in ("anchor", "bytes_hash"))
        found = repeated_windows(t.column("raw").to_pylist(), anchor, t.column("offset").to_numpy().astype(np.int64))
        rows = [(anchor[i], content[i], a, z) for i, hit in enumerate(found) for a, z in zip(*_stretches(hit))]
        cols = list(zip(*rows)) or [[]] * 4
        return pa.table([pa.array(list(cols[0]), pa.int64()), pa.array(list(cols[1]), pa.int64()),
                         pa.array(list(cols[2]), pa.int32()), pa.array(list(cols[3]), pa.int32())],
                        ["anchor", "bytes_hash", "first", "last"])

    return (contents.withColumn("bucket", F.pmod(F.xxhash64("anchor"), F.lit(buckets))).groupBy("bucket")
            .applyInArrow(lambda t: sort(t.combine_chunks()), "anchor long, bytes_hash long, first int, last int"))


def counted_repeats(contents: DataFrame) -> DataFrame:
    """The same for anchors with very many runs: windows by hash, one row each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = zip(*(b.column(c).to_pylist() for c in ("anchor", "bytes_hash")))
            for (anchor, content), raw in zip(keys, b.column("raw").to_pylist()):
                h = Prefixes(np.frombuffer(raw, np.uint8))
                at = np.arange(len(raw) - SPAN + 1)
                one = mix(h.of(at, SPAN)).view(np.int64)
                two = mix(h.of(at, SPAN // 2) ^ np.uint64(0x2545F4914F6CDD1D)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), anchor)), pa.array(np.full(len(at), content)),
                     pa.array(at.astype(np.int32)), pa.array(one), pa.array(two)],
                    ["anchor", "bytes_hash", "first", "one", "two"])

    windows = contents.select("anchor", "bytes_hash", "raw").mapInArrow(
        run, "anchor long, bytes_hash long, first int, one long, two long")
    twice = windows.groupBy("one", "two").count().where("count > 1").select("one", "two")
    return windows.join(twice, ["one", "two"]).select("anchor", "bytes_hash", "first", (F.col("first") + 1).alias("last"))


def repeats(keyed: DataFrame) -> DataFrame:
    """key, key2, start, end of removed stretches, which may overlap."""
    runs = materialize(find_runs(keyed), "suffix-runs")
    # written before it is joined, so that a join's two sides are plain shuffles, of which
    # AQE splits the partitions of a frequent anchor
    common = materialize(
        runs.groupBy("anchor").agg(F.count("*").alias("seen"), F.min("bytes_hash").alias("low"),
                                   F.max("bytes_hash").alias("high")).where("seen > 1")
        .select("anchor", (F.col("low") != F.col("high")).alias("mixed")), "suffix-common")
    again = materialize(runs.join(common, "anchor"), "suffix-again")
    kinds = materialize(again.groupBy("anchor", "bytes_hash", "mixed").agg(F.count("*").alias("copies")), "suffix-kinds")
    place = ["key", "key2"]
    whole = (again.join(kinds.where("copies > 1").select("anchor", "bytes_hash"), ["anchor", "bytes_hash"])
             .select(*place, "start", (F.col("start") + F.col("n") + SPAN - 1).alias("end")))

    # anchors with different runs of which one at least occurs once
    sort = materialize(kinds.where("mixed").groupBy("anchor").agg(F.count("*").alias("kinds"), F.min("copies").alias("least"))
                       .where("least = 1").select("anchor", "kinds"), "suffix-sort")
    bits = keyed.sparkSession.sparkContext.broadcast(wanted_filter(sort))
    contents = materialize(
        run_bytes(keyed, bits).join(sort, "anchor").dropDuplicates(["anchor", "bytes_hash"]), "suffix-contents")
    buckets = max(1, -(-contents.count() // BUCKET))
    found = sorted_repeats(contents.where(F.col("kinds") <= BUCKET), buckets).unionAll(
        counted_repeats(contents.where(F.col("kinds") > BUCKET)))
    single = again.join(kinds.where("mixed AND copies = 1").select("anchor", "bytes_hash"), ["anchor", "bytes_hash"])
    part = (single.join(materialize(found, "suffix-found"), ["anchor", "bytes_hash"])
            .select(*place, (F.col("start") + F.col("first")).alias("start"),
                    (F.col("start") + F.col("last") + SPAN - 1).alias("end")))
    return whole.unionAll(part)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The digest of every document after removal, as RESULT names it."""
    keyed = _keyed(docs)
    spans = (repeats(keyed).groupBy("key", "key2")
             .agg(F.collect_set(F.struct("start", "end")).alias("spans")))  # at most a text's own windows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            size, removed, count, digest = [], [], [], []
            for t, found in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                raw = _raw(t)
                if found:
                    edge = np.zeros(len(raw) + 1, np.int64)
                    np.add.at(edge, [s["start"] for s in found], 1)
                    np.add.at(edge, [s["end"] for s in found], -1)
                    gone = np.cumsum(edge[:-1]) > 0
                    first, _ = _stretches(gone)
                    kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                else:
                    first, kept = (), raw
                size.append(len(raw)), removed.append(len(raw) - len(kept)), count.append(len(first))
                digest.append(hashlib.sha256(kept).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(c, pa.int64()) for c in (size, removed, count)),
                 pa.array(digest, pa.string())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    joined = keyed.join(spans.hint("shuffle_hash"), ["key", "key2"], "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, RESULT)


def op1_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents"))
