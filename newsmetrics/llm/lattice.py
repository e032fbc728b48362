"""Operator 3, subword lattice likelihood.

A vocabulary of pieces with scores spans a lattice over every word: its arcs are
the pieces (for a character without piece, its bytes), and the word's
probability is the sum over all paths, by forward recursion in log space. The
vocabulary is taken as it is; the file's scores are ranks, which Zipf's law turns
into first weights, and one forward-backward pass over all training words makes
the piece probabilities. A text's probability is the product over its words and
one end.

Passes over the corpus:

1. expected piece counts of the training documents (per block of documents over
   distinct words), summed by Spark; the result is bounded by the vocabulary;
2. per block the model's score, each document's words as numbers into the block's
   dictionary, and the dictionary's hashes with the block's training counts;
   written once;
3. the dictionaries are summed by hash, and only counts that differ from the
   block's own return to it; there the base scores are summed per document.

So no text is shuffled, and no table of the corpus' words goes through one place. A block ends with BYTES of
text or BLOCK_ROWS documents; texts come and results go in small slices, and a block's dictionary is kept in arrays
(hashes, numbers, joined bytes), so a task holds some bytes per entry and distinct word, no object for each.

Words of LONG letters or more (texts in scripts without blanks) are worked through by themselves, in
chunks of positions, in time and memory linear in their length.

Defined results: null text counts as empty (one end, no words); whole texts count, however long; null ids are
training rows (the text '' has crc32 0, so they are held out); repeated rows count and
are scored each; without training documents N and V are 0 and the base score is
minus infinity's finite stand-in log10(0.1 / 0.1); other columns are ignored; an
empty table gives no rows. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm.common import ASCII_LOWER, fold, mix, small_batches, table, texts, written
from newsmetrics.llm.shingles import SPACE, hashes
from newsmetrics.session import materialize

FOLDS, HELD = 10, 0
ZIPF_SHIFT = 2.7
ROUNDS = 1  # forward-backward passes over the training words
PRIOR = 1000.0  # pseudo-count of the first weights
CELLS = 60_000  # letters of words of one length that are worked through together
LONG = 4096  # letters from which on a word is worked through by itself, in chunks
CHUNK = 1 << 16  # positions of such a chunk
ROWS = 256  # documents that Spark sends at once
PART = 1 << 19  # bytes of text whose words are told apart at once
WORDS = 1 << 16  # distinct words that are worked through at once
BYTES, BLOCK_ROWS = 32 << 20, 10_000  # text and documents that share a dictionary
ENTRIES = 16_384  # rows of a dictionary that are sent to Spark at once
START = "▁"  # how the vocabulary marks a word's begin
BLOCKS = ("block long, doc_id long, held boolean, n_tokens long, score double, at array<int>, "
          "times array<int>, hash long, own long")
INSIDE = np.ones(256, bool)  # bytes of words
INSIDE[list(b" \t\n\v\f\r")] = False
RESULT = ("doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
          "base_score double, score double")


class Pieces:
    """The vocabulary in a hash table that answers arrays of substring hashes."""

    BASE = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, pieces: list[str], bytes_at: list[int]):
        self.bytes_at = np.array(bytes_at)  # piece of each byte value
        self.longest = max(map(len, pieces), default=1)
        self.none = len(pieces)
        bits = max(10, len(pieces).bit_length() + 4)
        self.shift = np.uint64(64 - bits)
        size = (1 << bits) + 64
        self.keys, self.ids = np.zeros(size, np.uint64), np.full(size, self.none, np.int32)
        self.probes = 1
        for k, piece in enumerate(pieces):
            if not piece:
                continue
            h = np.zeros(1, np.uint64)
            for c in piece:
                h = h * self.BASE + np.uint64(ord(c) + 1)
            slot, step = int(mix(h)[0] >> self.shift), 0
            while self.keys[slot + step]:
                step += 1
            self.keys[slot + step], self.ids[slot + step] = h[0], k
            self.probes = max(self.probes, step + 1)

    def find(self, h: np.ndarray) -> np.ndarray:
        slot = (mix(h) >> self.shift).astype(np.int64)
        out = np.where(self.keys[slot] == h, self.ids[slot], self.none)
        for step in range(1, self.probes):
            out = np.where(self.keys[slot + step] == h, self.ids[slot + step], out)
        return out

    def arcs(self, letters: np.ndarray) -> list[np.ndarray]:
        """Per length, the piece at every start of every row of code points."""
        h, found = np.zeros(letters.shape, np.uint64), []
        for size in range(1, min(self.longest, letters.shape[1]) + 1):
            h = (h[:, :letters.shape[1] - size + 1] * self.BASE + letters[:, size - 1:] + np.uint64(1))
            found.append(self.find(h))
        return found


def _spelled(letter: int) -> bytes:
    return chr(letter).encode("utf-8", "surrogatepass")


class Lattice:
    def __init__(self, pieces: Pieces, log_weight: np.ndarray):
        self.pieces, self.weight = pieces, np.append(log_weight, -np.inf)

    def _groups(self, found: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, matrix of code points) for words of one length."""
        plain = [START + w.decode("utf-8", "surrogatepass") for w in found]
        length = np.fromiter(map(len, plain), np.int64, len(plain))
        order = np.argsort(length, kind="stable")
        for rows in np.split(order, np.flatnonzero(np.diff(length[order])) + 1):
            size = max(1, CELLS // int(length[rows[0]] if len(rows) else 1))
            for part in (rows[k:k + size] for k in range(0, len(rows), size)):
                text = "".join([plain[k] for k in part]).encode("utf-32-le", "surrogatepass")
                yield part, np.frombuffer(text, "<u4").astype(np.uint64).reshape(len(part), -1)

    def _weights(self, letters: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        arcs = self.pieces.arcs(letters)
        weight = [self.weight[a] for a in arcs]
        missing = arcs[0] == self.pieces.none
        if missing.any():
            kinds, which = np.unique(letters[missing], return_inverse=True)
            spelled = [self.weight[self.pieces.bytes_at[list(_spelled(int(c)))]].sum() for c in kinds]
            weight[0][missing] = np.array(spelled)[which]
        return arcs, weight

    def _forward(self, weight: list[np.ndarray], n: int) -> Iterator[np.ndarray]:
        """The logs of the sums over all paths to position 0, 1, ... n, one array each."""
        last = [np.zeros(len(weight[0]))]  # those that an arc can still start from, the nearest first
        yield last[0]
        for j in range(1, n + 1):
            terms = [last[size - 1] + weight[size - 1][:, j - size] for size in range(1, min(len(weight), j) + 1)]
            last.insert(0, np.logaddexp.reduce(terms, axis=0))
            del last[len(weight):]
            yield last[0]

    def _chunks(self, letters: np.ndarray) -> Iterator[tuple[int, list[np.ndarray], list[np.ndarray]]]:
        """(first start, arcs, weights) of one long word: the arcs whose start lies in the chunk."""
        n = letters.shape[1]
        for low in range(0, n, CHUNK):
            part = letters[:, low:min(n, low + CHUNK + self.pieces.longest - 1)]
            arcs, weight = self._weights(part)
            yield low, [a[0, :CHUNK] for a in arcs], [w[0, :CHUNK] for w in weight]

    @staticmethod
    def _scan(chunks: Iterator[tuple[int, list[np.ndarray]]], n: int) -> np.ndarray:
        """Logs of the sums over all paths to each position of one word, whose arcs come by their starts.

        Sums are kept as plain numbers relative to a running scale; only existing arcs are followed.
        """
        out, scale = np.full(n + 1, -np.inf), 0.0
        ahead: dict[int, float] = {0: 1.0}  # sums at positions that some arc has reached
        for low, weight in chunks:
            starts, ends, factors = [], [], []
            for size, w in enumerate(weight, 1):
                at = np.flatnonzero(np.isfinite(w))
                starts.append(at), ends.append(at + size), factors.append(np.exp(w[at]))
            start = np.concatenate(starts)
            order = np.argsort(start, kind="stable")
            cut = np.searchsorted(start[order], np.arange(len(weight[0]) + 1)).tolist()
            end, factor = (np.concatenate(ends)[order] + low).tolist(), np.concatenate(factors)[order].tolist()
            for i in range(len(weight[0])):
                here = ahead.pop(low + i, 0.0)
                if not here:
                    continue
                out[low + i] = scale + np.log(here)
                if here < 1e-100:
                    ahead = {k: v / here for k, v in ahead.items()}
                    scale += float(np.log(here))
                    here = 1.0
                for k in range(cut[i], cut[i + 1]):
                    ahead[end[k]] = ahead.get(end[k], 0.0) + here * factor[k]
        out[n] = scale + np.log(ahead[n])
        return out

    def _long_forward(self, letters: np.ndarray) -> np.ndarray:
        return self._scan(((low, w) for low, _, w in self._chunks(letters)), letters.shape[1])

    def _long_backward(self, letters: np.ndarray) -> np.ndarray:
        """Logs of the sums over all paths from each position to the end: a scan of the reversed arcs."""
        n, longest = letters.shape[1], self.pieces.longest

        def mirrored() -> Iterator[tuple[int, list[np.ndarray]]]:
            for low in range(0, n, CHUNK):
                base = max(0, n - low - CHUNK - longest + 1)
                _, weight = self._weights(letters[:, base:n - low])
                starts = np.arange(low, min(n, low + CHUNK))  # of reversed arcs: n less the arc's end
                out = []
                for size, w in enumerate(weight, 1):
                    at = n - size - base - starts
                    out.append(np.where(at >= 0, w[0, np.maximum(at, 0)], -np.inf))
                yield low, out

        return self._scan(mirrored(), n)[::-1]

    def log_probability(self, found: list[bytes]) -> np.ndarray:
        """Natural log of the sum over all segmentations, per word."""
        out = np.zeros(len(found))
        for rows, letters in self._groups(found) if found else ():
            if letters.shape[1] >= LONG:
                out[rows] = [self._long_forward(letters[k:k + 1])[-1] for k in range(len(rows))]
                continue
            _, weight = self._weights(letters)
            for out[rows] in self._forward(weight, letters.shape[1]):
                pass
        return out

    def expected(self, found: list[bytes], times: np.ndarray) -> np.ndarray:
        """Expected uses of every piece over all segmentations of words seen ``times``."""
        total = np.zeros(len(self.weight))
        for rows, letters in self._groups(found) if found else ():
            if letters.shape[1] >= LONG:
                for k, row in enumerate(rows.tolist()):
                    one = letters[k:k + 1]
                    alpha, beta = self._long_forward(one)[:, None], self._long_backward(one)[:, None]
                    for low, arcs, weight in self._chunks(one):
                        self._add_uses(total, one[:, low:], [a[None] for a in arcs], [w[None] for w in weight],
                                       alpha[low:], beta[low:], alpha[-1], times[row:row + 1])
                continue
            n, (arcs, weight) = letters.shape[1], self._weights(letters)
            alpha = np.stack(list(self._forward(weight, n)))
            mirrored = [w[:, ::-1] for w in weight]
            beta = np.stack(list(self._forward(mirrored, n)))[::-1]
            self._add_uses(total, letters, arcs, weight, alpha, beta, alpha[n], times[rows])
        return total[:-1]

    def _add_uses(self, total: np.ndarray, letters: np.ndarray, arcs: list[np.ndarray], weight: list[np.ndarray],
                  alpha: np.ndarray, beta: np.ndarray, whole: np.ndarray, times: np.ndarray) -> None:
        """Add the expected uses of the arcs; ``alpha`` and ``beta`` are (position, word)."""
        for size, (arc, w) in enumerate(zip(arcs, weight), 1):
            k = arc.shape[1]
            if not k:
                continue
            p = times * np.exp(alpha[:k] + w.T + beta[size:size + k] - whole)
            total += np.bincount(arc.T.ravel(), p.ravel(), len(total))
            if size == 1:
                for i, row in zip(*np.nonzero(arc.T == self.pieces.none)):
                    np.add.at(total, self.pieces.bytes_at[list(_spelled(int(letters[row, i])))], p[i, row])


def first_weights(vocabulary: str) -> tuple[list[str], list[int], np.ndarray]:
    """Pieces, the pieces of the 256 bytes, and Zipf weights by descending score."""
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    n = model.get_piece_size()
    usable = [k for k in range(n) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))]
    byte = {int(model.id_to_piece(k)[3:5], 16): k for k in range(n) if model.is_byte(k)}
    order = sorted(usable, key=lambda k: (-model.get_score(k), k)) + [byte[b] for b in range(256)]
    pieces = [model.id_to_piece(k) for k in order[:len(usable)]] + [""] * 256
    weight = 1 / (np.arange(len(order)) + ZIPF_SHIFT)
    return pieces, list(range(len(usable), len(order))), np.log(weight / weight.sum())


class Words:
    """Distinct words of many texts, numbered as they come: hashes in sorted arrays and the words' bytes."""

    def __init__(self):
        self.key, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.raw: list[bytes] = []  # the words in order of their numbers, joined by blanks

    def __len__(self) -> int:
        return len(self.key)

    def add(self, found: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text its number of entries; the entries, text by text: a word's number, its occurrences.

        A text of several PARTs may have several entries for a word.
        """
        raw = [t.encode("utf-8", "surrogatepass").translate(ASCII_LOWER) for t in found]
        offset = np.cumsum([0] + [len(r) + 1 for r in raw[:-1]])
        made, joined, low = [], b" ".join(raw), 0
        while low < len(joined):
            cut = SPACE.search(joined, low + PART)
            high = cut.start() if cut else len(joined)
            made.append(self._add(joined[low:high], low, offset))
            low = high
        text, number, times = (np.concatenate([np.zeros(0, np.int32), *x]) for x in (zip(*made) if made else [()] * 3))
        return np.bincount(text, minlength=len(found)), number, times

    def _add(self, raw: bytes, low: int, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inside = np.concatenate(([False], INSIDE[np.frombuffer(raw, np.uint8)], [False]))
        edge = np.flatnonzero(inside[1:] != inside[:-1])
        start, end = edge[::2], edge[1::2]
        key, first, which = np.unique(hashes(raw), return_index=True, return_inverse=True)
        at = np.searchsorted(self.key, key)
        number = np.append(self.number, np.int32(0))[at]
        new = np.append(self.key, np.uint64(0))[at] != key
        new[at == len(self.key)] = True
        if new.any():
            fresh = np.flatnonzero(new)
            fresh = fresh[np.argsort(first[fresh])]
            number[fresh] = np.arange(len(self), len(self) + len(fresh), dtype=np.int32)
            self.raw.append(b" ".join([raw[a:b] for a, b in zip(start[first[fresh]].tolist(), end[first[fresh]].tolist())]))
            self.key, self.number = np.insert(self.key, at[new], key[new]), np.insert(self.number, at[new], number[new])
        text = np.searchsorted(offset, low + start, "right") - 1
        pair, seen, times = np.unique(text * (len(key) + 1) + which, return_index=True, return_counts=True)
        order = np.argsort(seen)
        text, which = np.divmod(pair[order], len(key) + 1)
        return text.astype(np.int32), number[which], times[order].astype(np.int32)

    def keys(self) -> np.ndarray:
        out = np.empty(len(self), np.uint64)
        out[self.number] = self.key
        return out

    def chunks(self) -> Iterator[list[bytes]]:
        """The words in order of their numbers, WORDS or fewer at a time."""
        held: list[bytes] = []
        for raw in self.raw:
            held += raw.split()
            for _ in range(len(held) // WORDS):
                yield held[:WORDS]
                held = held[WORDS:]
        if held:
            yield held


def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices with about PART bytes of text."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        window = (np.cumsum(size) - size) // PART
        edge = [0, *(np.flatnonzero(np.diff(window)) + 1).tolist(), len(b)]
        yield from (b.slice(low, high - low) for low, high in zip(edge, edge[1:]) if high > low)


def expected_pieces(docs: DataFrame, pieces: Pieces, log_weight: np.ndarray) -> tuple[np.ndarray, int]:
    """Expected piece counts over the training documents, and their number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, log_weight)
        words, uses, size, sums, ends = Words(), np.zeros(0), 0, np.zeros(len(log_weight)), 0

        def work_through() -> None:
            nonlocal words, uses, size
            low = 0
            for found in words.chunks():
                sums[:] += lattice.expected(found, uses[low:low + len(found)])
                low += len(found)
            words, uses, size = Words(), np.zeros(0), 0

        for b in parts(batches):
            ends += len(b)
            size += b.column("text").nbytes
            _, number, times = words.add(texts(b))
            uses = np.concatenate((uses, np.zeros(len(words) - len(uses))))
            uses += np.bincount(number, times, len(uses))
            if size >= BYTES:
                work_through()
        work_through()
        k = np.flatnonzero(sums)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(k, -1)), pa.array(np.append(sums[k], ends))], ["piece", "uses"])

    training = docs.where(~fold("doc_id", FOLDS, HELD)).select("text")
    with small_batches(docs.sparkSession, ROWS):
        rows = (training.mapInArrow(run, "piece long, uses double")
                .groupBy("piece").agg(F.sum("uses").alias("uses")).collect())  # at most the vocabulary
    total, ends = np.zeros(len(log_weight)), 0
    for r in rows:
        if r["piece"] < 0:
            ends = int(r["uses"])
        else:
            total[r["piece"]] = r["uses"]
    return total, ends


def trained(docs: DataFrame, vocabulary: str, rounds: int = ROUNDS) -> tuple[Pieces, np.ndarray, float]:
    """Pieces, their log probabilities and that of the end."""
    names, byte_at, start = first_weights(vocabulary)
    pieces, log_weight, log_end = Pieces(names, byte_at), start, 0.0
    for _ in range(rounds):
        uses, ends = expected_pieces(docs, pieces, log_weight)
        uses = uses + PRIOR * np.exp(start)
        whole = uses.sum() + ends + 1
        log_weight, log_end = np.log(uses / whole), float(np.log((ends + 1) / whole))
    return pieces, log_weight, log_end


def blocks(docs: DataFrame, pieces: Pieces, log_weight: np.ndarray, log_end: float) -> DataFrame:
    """Rows of documents (hash null) and of the blocks' dictionaries (at null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(pieces, log_weight)
        block, words, made, size = TaskContext.get().partitionId() << 32, Words(), [], 0
        for b in parts(batches):
            made.append((b.column("doc_id"), b.column("held"), *words.add(texts(b))))
            size += b.column("text").nbytes
            if size >= BYTES or sum(len(m[0]) for m in made) >= BLOCK_ROWS:
                yield from written_out(block, lattice, words, made)
                block, words, made, size = block + 1, Words(), [], 0
        if made:
            yield from written_out(block, lattice, words, made)

    def written_out(block: int, lattice: Lattice, words: Words, made: list[tuple]) -> Iterator[pa.RecordBatch]:
        log_p = np.concatenate([np.zeros(0), *map(lattice.log_probability, words.chunks())])
        own, none = np.zeros(len(words), np.int64), pa.nulls
        for doc_id, held, size, at, times in made:
            train = np.repeat(~held.to_numpy(zero_copy_only=False), size)
            np.add.at(own, at[train], times[train])
            cut, rows = np.append(0, np.cumsum(size)), len(size)
            spans = list(zip(cut.tolist(), cut[1:].tolist()))
            count = [int(times[i:j].sum()) + 1 for i, j in spans]
            score = [(float(log_p[at[i:j]] @ times[i:j]) + log_end) / np.log(10) for i, j in spans]
            lists = [pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(x)) for x in (at, times)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(rows, block)), doc_id, held, pa.array(count, pa.int64()), pa.array(score, pa.float64()),
                 *lists, none(rows, pa.int64()), none(rows, pa.int64())], NAMES)
        key = words.keys().view(np.int64)
        for k in range(0, len(key), ENTRIES):
            part = key[k:k + ENTRIES]
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, block)), pa.array(np.arange(k, k + n)), none(n, pa.bool_()),
                 none(n, pa.int64()), none(n, pa.float64()), none(n, pa.list_(pa.int32())),
                 none(n, pa.list_(pa.int32())), pa.array(part), pa.array(own[k:k + n])], NAMES)

    chosen = docs.select(F.col("doc_id").cast("long"), "text", fold("doc_id", FOLDS, HELD).alias("held"))
    return chosen.mapInArrow(run, BLOCKS)


NAMES = [c.strip().split()[0] for c in BLOCKS.split(",")]


class Entries:
    """A batch's documents: whether held out, their numbers of entries, the entries."""

    def __init__(self, batch: pa.RecordBatch):
        self.held = batch.column("held").to_numpy(zero_copy_only=False)
        self.size = batch.column("at").value_lengths().to_numpy()
        self.at, self.times = (batch.column(c).flatten().to_numpy() for c in ("at", "times"))


def score_documents(docs: DataFrame, vocabulary: str) -> DataFrame:
    made = blocks(docs, *trained(docs, vocabulary))
    with small_batches(docs.sparkSession, ROWS):
        made = materialize(made, "lattice-blocks")
    entries = made.where("hash IS NOT NULL").select("block", F.col("doc_id").alias("place"), "hash", "own")
    rows = made.where("hash IS NULL").select("block", "doc_id", "held", "n_tokens", "score", "at", "times")
    totals = materialize(entries.groupBy("hash").agg(F.sum("own").alias("total"), F.count("*").alias("blocks")),
                         "lattice-totals")
    seen = totals.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("n"), F.count_if(F.col("total") > 0).alias("v")).first()
    ends = rows.where("NOT held").count()
    n, v = seen["n"] + ends, seen["v"] + (ends > 0)
    back = materialize(entries.join(totals.where("blocks > 1").select("hash", "total"), "hash")
                       .where("own <> total").select("block", "place", "total"), "lattice-back")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        some = [Entries(b) for b in left.select(["held", "at", "times"]).to_batches(ROWS)]
        place = right.column("place").to_numpy()
        count = np.zeros(1 + max([int(x.max(initial=0)) for x in (place, *(e.at for e in some))]), np.int64)
        for e in some:
            train = np.repeat(~e.held, e.size)
            np.add.at(count, e.at[train], e.times[train])
        count[place] = right.column("total").to_numpy()
        part = np.log10((count + 0.1) / (n + 0.1 * (v + 1)))
        end = np.log10((ends + 0.1) / (n + 0.1 * (v + 1)))
        base, known = [], []
        for e in some:
            doc = np.repeat(np.arange(len(e.size)), e.size)
            base.append(np.bincount(doc, e.times * part[e.at], len(e.size)) + end)
            known.append(np.bincount(doc, e.times * (count[e.at] > 0), len(e.size)).astype(np.int64) + (ends > 0))
        return pa.table([left.column("doc_id"), left.column("held"), left.column("n_tokens"), pa.array(np.concatenate(known)),
                         pa.array(np.full(len(left), n)), pa.array(np.concatenate(base)), left.column("score")],
                        ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    scored = rows.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(
        lambda l, r: run(l, r) if len(l) else EMPTY, RESULT)
    with small_batches(docs.sparkSession, 4 * ROWS):
        return written(scored, "lattice-scores")


EMPTY = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                   ("train_tokens", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())]).empty_table()


def default_vocabulary() -> str:
    import public_tokenizers
    return str(public_tokenizers.path("piece_bpe_32k.model"))


def op3_subword_lattice(spark, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), default_vocabulary())
