"""Operator 6, benchmark decontamination by template canonicalisation.

Texts become sequences of lower-cased tokens in which numbers, names and units
are typed placeholders. Windows of WINDOW tokens are hash-joined with those
of the benchmark items. Within a matched window equal slots of the item must have
equal values in the document; a window that breaks this is dropped, and no other
for it, so an item with one value altered where it occurs twice is still caught.
Two slots of the item may get the same new value. Windows with few literal tokens
say little as templates; they match only with equal slot values. Names are told by
their capitals, so every text is also posted as windows of its case-folded tokens
without placeholders; these find copies in lower case or capitals.

A document holds an item when the windows of both sorts cover at least COVER of the
item's tokens, or the template windows COVER of its template (where a run of names
is one token).

The benchmark's windows go to the tasks as one sorted array while there are at
most MAX_BROADCAST of them (counted); beyond, every window of the documents
takes part in the shuffled join. Both ways give the same rows.

Defined results: null and empty texts hold nothing, and null or empty items are
held by nothing; an item shorter than WINDOW is one window of either sort; repeated documents
and items get rows of their own per (doc_id, item_id), merged when both ids are
equal; rows with null doc_id are reported under a null id; texts of any length are searched in
whole, in blocks; other columns are ignored; an empty table on either side gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm.common import mix, table, texts
from newsmetrics.llm.shingles import BLOCK, SPACE, tables, window_hashes

WINDOW = 8
LITERALS = 4
COVER = 0.5
MAX_BROADCAST = 4_000_000  # windows, 8 bytes each
UNITS = ("km m cm mm mi mile miles ft feet foot inch inches yard yards kg g mg lb lbs pound pounds oz ton tons "
         "l ml liter liters litre litres gallon gallons s sec second seconds min minute minutes h hr hour hours "
         "day days week weeks month months year years usd eur gbp dollar dollars euro euros cent cents percent "
         "mph kmh degree degrees watt watts kw kwh volt volts hz khz mhz ghz kb mb gb tb byte bytes").split()
NUMBER, NAME, UNIT = (np.uint64(v) for v in (0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD2B74407B1CE6E93))
PLACEHOLDERS = np.array([0, NUMBER, UNIT, NAME], np.uint64)
STOPS = np.isin(np.arange(256), list(b".!?:\n\r\t|"))  # after one of these a capital begins a sentence
WINDOWS = "doc_id long, key long, text_key long, h long, slots array<long>"


def _hash_tokens(value: np.ndarray, starts: np.ndarray) -> np.ndarray:
    _, power, inverse = tables(max(len(value), 1 << 12))
    return mix(np.add.reduceat(value * power[:len(value)], starts) * inverse[starts])


def _block(raw: bytes, before: bytes, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(value, kind) per token; kind 0 literal, 1 number, 2 unit, 3 name."""
    b = np.frombuffer(raw, np.uint8)
    digit = (b >= 48) & (b <= 57)
    point = np.zeros(len(b), bool)
    if len(b) > 2:
        point[1:-1] = ((b[1:-1] == 46) | (b[1:-1] == 44)) & digit[:-2] & digit[2:]
    number = digit | point
    upper = (b >= 65) & (b <= 90)
    letter = upper | ((b >= 97) & (b <= 122)) | (b >= 128)
    kind = number * 1 + letter * 2
    starts = np.flatnonzero((kind > 0) & (kind != np.concatenate(([0], kind[:-1]))))
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int8)
    table_, _, _ = tables(1 << 12)
    low = b + 32 * upper.astype(np.uint8)
    # between tokens nothing counts, so a token's hash is that of its own bytes
    hashes = _hash_tokens(np.where(kind > 0, table_[low], np.uint64(0)), starts)
    out = np.where(kind[starts] == 1, 1, 0).astype(np.int8)
    follows = np.concatenate(([False], out[:-1] == 1))
    maybe = np.flatnonzero((out == 0) & follows)
    if len(maybe):
        out[maybe[np.isin(hashes[maybe], units)]] = 2
    padded = np.concatenate((np.frombuffer((b".." + before)[-2:], np.uint8), b))
    first, second = padded[starts + 1], padded[starts]  # the byte before the token and the one before that
    after = b[np.minimum(starts + 1, len(b) - 1)]
    capital = upper[starts] | ((b[starts] == 0xC3) & (after >= 0x80) & (after <= 0x9E))
    maybe = np.flatnonzero((out == 0) & capital & (first == 32))
    out[maybe[~STOPS[second[maybe]]]] = 3
    return hashes, out


def _tokens(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Value and kind of every token of the text, names not yet joined."""
    units = unit_hashes()
    raw = text.encode("utf-8", "surrogatepass")
    parts, at = [], 0
    while at < len(raw):
        cut = SPACE.search(raw, at + BLOCK) if len(raw) - at > BLOCK else None
        end = cut.start() if cut else len(raw)
        parts.append(_block(raw[at:end], raw[max(at - 2, 0):at], units))
        at = end
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int8)
    value, kind = (np.concatenate(x) for x in zip(*parts))
    return value, kind


def canonical(value: np.ndarray, kind: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Template tokens, their literal values, whether they are slots (a run of names is one) and
    the first token of each."""
    if not len(value):
        return value, value, np.zeros(0, bool), np.zeros(0, np.int64)
    first = np.flatnonzero(~((kind == 3) & np.concatenate(([False], kind[:-1] == 3))))
    order = np.arange(len(value), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    start_of = np.repeat(first, np.diff(np.append(first, len(value))))
    value = np.add.reduceat(value * (order - order[start_of] + np.uint64(1)), first)
    kind = kind[first]
    token = np.where(kind == 0, value, PLACEHOLDERS[kind])
    return token, value, kind > 0, first


_KEPT: dict[str, np.ndarray] = {}


def unit_hashes() -> np.ndarray:
    if "units" not in _KEPT:
        byte, _, _ = tables(1 << 12)
        _KEPT["units"] = np.array([_hash_tokens(byte[np.frombuffer(u.encode(), np.uint8)], np.array([0]))[0]
                                   for u in UNITS])
    return _KEPT["units"]


class Text:
    """The tokens of one text as template and case-folded."""

    def __init__(self, text: str):
        plain, kind = _tokens(text)
        self.token, self.value, self.slot, first = canonical(plain, kind)
        # letters stay letters when their case is folded, so both have the same tokens
        self.plain = plain if text.isascii() else _tokens(text.casefold())[0]
        self.place = np.append(first, len(plain))  # of a template token among the plain ones

    def template_windows(self, size: int) -> np.ndarray:
        """Hashes of the windows of ``size`` template tokens; of a shorter text of its only one."""
        if not len(self.token):
            return self.token
        width = min(size, len(self.token))
        total = np.concatenate(([0], np.cumsum(self.slot)))
        literal = width - (total[width:] - total[:-width])
        h = window_hashes(self.token, width) + np.uint64(width)
        few = literal < min(LITERALS, width)
        if few.any():
            h[few] = window_hashes(self.value, width)[few] + np.uint64(width + 100)
        return h

    def plain_windows(self, size: int) -> np.ndarray:
        """The same of the case-folded tokens."""
        if not len(self.plain):
            return self.plain
        width = min(size, len(self.plain))
        return window_hashes(self.plain, width) + np.uint64(width + 200)

    def slots(self, at: int, width: int) -> np.ndarray:
        return self.value[at:at + width][self.slot[at:at + width]].view(np.int64)


ITEM_WINDOWS = pa.schema([
    ("item_id", pa.int64()), ("n_template", pa.int32()), ("n_tokens", pa.int32()), ("width", pa.int32()), ("h", pa.int64()),
    ("at", pa.int32()), ("slots", pa.list_(pa.int64())), ("plain", pa.bool_()), ("first", pa.int32()), ("last", pa.int32())])


def benchmark_windows(items: DataFrame) -> DataFrame:
    """Every window of every item: its hash, whether it is plain, its place in the template (of a
    plain one null) and its first and last token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for i, t in zip(b.column("item_id").to_pylist(), texts(b)):
                x = Text(t)
                n, m = len(x.token), len(x.plain)
                width = min(WINDOW, n)
                rows += [(i, n, m, width, int(h), k, x.slots(k, width), False, x.place[k], x.place[k + width] - 1)
                         for k, h in enumerate(x.template_windows(WINDOW).view(np.int64))]
                width = min(WINDOW, m)
                rows += [(i, n, m, width, int(h), None, [], True, k, k + width - 1)
                         for k, h in enumerate(x.plain_windows(WINDOW).view(np.int64))]
            cols = list(zip(*rows)) or [[]] * len(ITEM_WINDOWS)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, ITEM_WINDOWS)],
                                             schema=ITEM_WINDOWS)

    return (items.select(F.col("item_id").cast("long"), "text").distinct()
            .mapInArrow(run, "item_id long, n_template int, n_tokens int, width int, h long, at int, slots array<long>, "
                             "plain boolean, first int, last int"))


def document_windows(docs: DataFrame, widths: list[tuple[bool, int]], known: np.ndarray | None) -> DataFrame:
    """Windows of the documents; only those in the sorted array ``known`` if it is given.

    ``widths`` says which sorts and sizes the items have: (plain or not, tokens).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
        names = ["doc_id", "key", "text_key", "h", "slots"]
        for b in batches:
            rows = []
            keys = zip(*(b.column(k).to_pylist() for k in names[:3]))
            for key, t in zip(keys, texts(b)):
                x = Text(t)
                for plain, size in widths:
                    if len(x.plain if plain else x.token) < size:
                        continue
                    h = (x.plain_windows(size) if plain else x.template_windows(size)).view(np.int64)
                    if known is None:
                        hit = range(len(h))
                    else:
                        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                        hit = np.flatnonzero(known[place] == h).tolist()
                    rows += [(*key, int(h[k]), [] if plain else x.slots(k, size)) for k in hit]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), *row_key(), "text").mapInArrow(run, WINDOWS)


def row_key():
    """What tells documents apart beside their id: two hashes of the text."""
    return (F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"),
            F.xxhash64(F.lit(7), F.coalesce("text", F.lit(""))).alias("text_key"))


def contaminated(docs: DataFrame, items: DataFrame, max_broadcast: int = MAX_BROADCAST) -> DataFrame:
    """One row per document row key and item held by it, with the covered share."""
    bench = benchmark_windows(items).checkpoint()
    widths = sorted((r["plain"], r["width"]) for r in bench.select("plain", "width").distinct().collect())  # 1 to WINDOW
    known = None
    small = bench.count() <= max_broadcast
    if small:
        known = np.unique(np.array([r["h"] for r in bench.select("h").distinct().collect()], np.int64))
        if not len(known):
            widths, known = [], np.zeros(1, np.int64)
    other = bench.withColumnRenamed("slots", "item_slots")
    found = document_windows(docs, widths, known).join(F.broadcast(other) if small else other, "h")
    doc = ["doc_id", "key", "text_key"]
    item = ["item_id", "n_template", "n_tokens"]
    pairs = F.array_distinct(F.arrays_zip(F.col("item_slots").alias("x"), F.col("slots").alias("y")))
    consistent = F.size("pairs") == F.size(F.array_distinct("pairs.x"))

    def covered(places: str) -> Column:
        return F.size(F.array_distinct(F.flatten(F.transform(places, lambda p: F.sequence(p["first"], p["last"])))))

    at = F.struct(F.col("at").alias("first"), (F.col("at") + F.col("width") - 1).alias("last"))
    return (found.withColumn("pairs", pairs).where(consistent).groupBy(*doc, *item)
            .agg(F.collect_set(F.struct("first", "last")).alias("places"),
                 F.collect_set(F.when(~F.col("plain"), at)).alias("template_places"))
            .select(*doc, *item, covered("places").alias("n_covered"), covered("template_places").alias("n_in_template"))
            .where((F.col("n_covered") >= COVER * F.col("n_tokens"))
                   | (F.col("n_in_template") >= COVER * F.col("n_template")))
            .drop("n_template", "n_in_template"))


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all columns as they are.

    Rows are told apart by id and text; copies share their decision.
    """
    bad = contaminated(docs, items).select(
        F.coalesce("doc_id", F.lit(-1)).alias("__d"), F.col("key").alias("__k"),
        F.col("text_key").alias("__t")).distinct()
    same = ((F.coalesce(docs["doc_id"].cast("long"), F.lit(-1)) == bad["__d"])
            & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == bad["__k"])
            & (F.xxhash64(F.lit(7), F.coalesce(docs["text"], F.lit(""))) == bad["__t"]))
    return docs.join(bad, same, "left_anti")


def op6_template_decontamination(spark, sf_dir: str) -> DataFrame:
    found = contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return (found.groupBy("doc_id", "item_id")
            .agg(F.max("n_covered").alias("n_covered"), F.max("n_tokens").alias("n_tokens")))
