"""Operator 8, toxicity by weak supervision.

1. Terms. From a bounded sample of labelled rows, whole words and stems (word
   beginnings), present at all or as at least a hundredth of a text's words, whose
   documents are toxic with a Wilson bound over one half. All of them are taken.
2. Voters. The terms are dealt to LEXICON voters, each firing when a document
   holds one of its terms; pattern voters fire on several different terms, on a
   share of hits, on shouting and on exclamation. Spark counts, over all
   documents, how often each combination of votes occurs, and sums the features
   of its documents: at most 2 ** (LEXICON + 4) combinations.
3. Label model. A generative model of these counts: a class share, each voter's
   firing rate per class (its accuracy), and a tree of the strongest
   class-conditional correlations, along which a voter depends on another. It is
   fitted by expectation-maximisation; the sample's labels are fixed in it.
4. Classifier. Logistic regression over term presence, votes and shares (terms hashed
   to SLOTS places), fitted to the posterior labels of all documents, each combination
   of votes standing with the mean of its documents' features, then calibrated on
   the labelled sample.

Defined results: null text counts as empty; several labels of one id count as
their majority (a tie as 1), null labels are ignored; without labelled rows or
terms the score is 0.5 or the label share for all; repeated rows get a row each;
texts of any length are read in whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm.common import fold, table, texts

FOLDS, HELD = 3, 1
THRESHOLD = 0.7
MAX_TRAIN_ROWS = 20_000  # bound of the labelled sample
SLOTS = 64  # places of the classifier's term features
STEMS = range(3, 8)  # lengths of word beginnings
DENSE = 0.01
LEXICON = 10
VOTERS = LEXICON + 4
LETTERS = re.compile(r"[^\W\d_]+")


def tokens(text: str) -> list[str]:
    return LETTERS.findall(text.lower())


def _terms_of(words: list[str]) -> Counter:
    """How often each whole word (marked by a blank) and each stem occurs."""
    count: Counter = Counter()
    for w, n in Counter(words).items():
        count[w + " "] += n
        for k in STEMS:
            if k < len(w):
                count[w[:k]] += n
    return count


@dataclass
class Lexicon:
    """Terms, each with the share of a text's words that it must reach (0: it must occur)."""

    whole: dict[str, list[int]]
    stems: dict[str, list[int]]
    least: np.ndarray

    @staticmethod
    def of(terms: list[tuple[str, float]]) -> Lexicon:
        made = Lexicon({}, {}, np.array([share for _, share in terms], float))
        for k, (t, _) in enumerate(terms):
            (made.whole if t[-1] == " " else made.stems).setdefault(t.rstrip(" "), []).append(k)
        return made

    @property
    def size(self) -> int:
        return len(self.least)

    def features(self, text: str) -> np.ndarray:
        """Term presence, then the votes, then shares."""
        words = tokens(text)
        lengths = sorted({len(s) for s in self.stems})
        times, hits = np.zeros(self.size), 0
        for w, n in Counter(words).items():
            found = list(self.whole.get(w, ()))
            for size in lengths:
                found += self.stems.get(w[:size], ())
            if found:
                times[found] += n
                hits += n
        present = (times > 0) & (times >= self.least * len(words))
        place = np.arange(self.size) % SLOTS
        slots, parts = np.zeros(self.slots), np.zeros(self.slots)
        slots[place[present]] = 1
        np.add.at(parts, place, times)
        share = hits / max(len(words), 1)
        upper = sum(map(str.isupper, text)) / max(len(text), 1)
        votes = np.zeros(VOTERS)
        votes[np.flatnonzero(present) % LEXICON] = 1
        votes[LEXICON:] = [present.sum() >= 2, share >= 0.01, upper >= 0.3, text.count("!") >= 0.01 * len(text) > 0]
        return np.concatenate((slots, votes, 100 * np.minimum(parts / max(len(words), 1), 0.05),
                               [np.log1p(hits), np.log1p(100 * share)]))

    @property
    def slots(self) -> int:
        return min(self.size, SLOTS)

    @property
    def width(self) -> int:
        return 2 * self.slots + VOTERS + 2

    def matrix(self, found: list[str]) -> np.ndarray:
        return np.array([self.features(t) for t in found]).reshape(len(found), self.width)

    def cells(self, x: np.ndarray) -> np.ndarray:
        """Number of each row's combination of votes."""
        return x[:, self.slots:self.slots + VOTERS].astype(np.int64) @ (1 << np.arange(VOTERS))


def labelled_sample(docs: DataFrame, labels: DataFrame, max_rows: int) -> DataFrame:
    """text and y of at most ``max_rows`` labelled ids outside the held-out fold; copies count once."""
    ids = (labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~fold("doc_id", FOLDS, HELD))
           .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("y"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows))
    return (docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")
            .groupBy("text").agg(F.max("y").alias("y")))


def find_terms(sample: DataFrame) -> list[tuple[str, float]]:
    """Terms with the share (0 or DENSE) of a text's words that they must reach; their number is bounded by the sample's words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            toxic, seen = Counter(), Counter()
            for t, y in zip(texts(b), b.column("y").to_pylist()):
                words = tokens(t)
                own = _terms_of(words)
                found = [(x, 0.0) for x in own] + [("", 0.0)]
                found += [(x, DENSE) for x, n in own.items() if n >= DENSE * len(words)]
                seen.update(found)
                if y:
                    toxic.update(found)
            keys = list(seen)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in keys], pa.string()), pa.array([n for _, n in keys], pa.float64()),
                 pa.array([toxic[k] for k in keys], pa.int64()), pa.array([seen[k] for k in keys], pa.int64())],
                ["term", "least", "toxic", "seen"])

    sums = (sample.mapInArrow(run, "term string, least double, toxic long, seen long").groupBy("term", "least")
            .agg(F.sum("toxic").alias("toxic"), F.sum("seen").alias("seen")).checkpoint())
    whole = sums.where("term = ''").first()
    if whole is None:
        return []
    p, n, z2 = F.col("toxic") / F.col("seen"), F.col("seen"), 1.96 ** 2
    bound = (p + z2 / (2 * n) - 1.96 * F.sqrt(p * (1 - p) / n + z2 / (4 * n ** 2))) / (1 + z2 / n)
    least = max(5, whole["seen"] // 2000)
    good = sums.where((F.col("term") != "") & (F.col("toxic") >= least) & (bound >= 0.5))
    worth = F.col("toxic") - 2 * (n - F.col("toxic"))
    rows = good.orderBy(F.desc(worth), F.desc(F.length("term")), "term", "least").collect()
    longer: dict[tuple[str, float], list] = {}  # rows by each of their term's beginnings
    for x in rows:
        for k in range(min(STEMS), len(x["term"]) + 1):
            longer.setdefault((x["term"][:k], x["least"]), []).append(x)
    chosen: dict[str, float] = {}
    begun: set[str] = set()  # beginnings of chosen terms
    for r in rows:  # a term that begins a chosen one, or that one begins with, adds nothing
        # the longest form that keeps nearly all of the support says most
        r = max((x for x in longer.get((r["term"], r["least"]), [r]) if x["toxic"] >= 0.95 * r["toxic"]), key=lambda x: len(x["term"]))
        t = r["term"]
        if t not in begun and not any(t[:k] in chosen for k in range(1, len(t) + 1)):
            chosen[t] = r["least"]
            begun.update(t[:k] for k in range(1, len(t) + 1))
    return list(chosen.items())


class LabelModel:
    """P(votes, class) with a tree of class-conditional dependencies between voters."""

    def __init__(self, cells: np.ndarray, weight: np.ndarray, known: np.ndarray, rounds: int = 40):
        """``known``: per cell the numbers of labelled rows of class 0 and 1."""
        self.votes = (cells[:, None] >> np.arange(VOTERS)) & 1
        self.weight, self.known = weight, known
        self.parent = np.full(VOTERS, -1)
        fires = self.votes[:, :LEXICON + 2].any(1)
        post = np.where(fires, 0.9, 0.05)
        for step in range(2 * rounds):
            self._maximise(post)
            if step == rounds:
                self._tree(post)
                self._maximise(post)
            post = self.posterior(self.votes)
        self.answer = dict(zip(cells.tolist(), post.tolist()))

    def _mass(self, post: np.ndarray) -> np.ndarray:
        free = np.maximum(self.weight - self.known.sum(1), 0)
        return np.stack([free * (1 - post) + self.known[:, 0], free * post + self.known[:, 1]], 1)

    def _maximise(self, post: np.ndarray) -> None:
        mass = self._mass(post)
        self.share = (mass.sum(0) + 1) / (mass.sum() + 2)
        # rate[y, value of the parent, voter]
        self.rate = np.zeros((2, 2, VOTERS))
        for j, parent in enumerate(self.parent):
            given = self.votes[:, parent] if parent >= 0 else np.zeros(len(self.votes), int)
            for y in (0, 1):
                for value in (0, 1):
                    m = mass[:, y] * (given == value)
                    self.rate[y, value, j] = (m @ self.votes[:, j] + 0.1) / (m.sum() + 1)

    def _tree(self, post: np.ndarray) -> None:
        """Maximum spanning tree of the class-conditional mutual information."""
        mass = self._mass(post)
        gain = np.zeros((VOTERS, VOTERS))
        for y in (0, 1):
            total = mass[:, y].sum() + 1e-9
            both = self.votes.T @ (mass[:, [y]] * self.votes) / total
            p = np.diag(both)
            for a, b in ((1, 1), (1, 0), (0, 1), (0, 0)):
                pa_, pb = (p if a else 1 - p), (p if b else 1 - p)
                joint = {(1, 1): both, (1, 0): p[:, None] - both, (0, 1): p[None] - both,
                         (0, 0): 1 - p[:, None] - p[None] + both}[a, b].clip(1e-12)
                gain += total * joint * np.log(joint / np.maximum(pa_[:, None] * pb[None], 1e-12))
        inside = [0]
        while len(inside) < VOTERS:
            rest = [j for j in range(VOTERS) if j not in inside]
            a, j = max(((a, j) for a in inside for j in rest), key=lambda e: gain[e])
            if gain[a, j] > np.log(self.weight.sum() + 2):  # else the voter stays independent
                self.parent[j] = a
            inside.append(j)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        log = np.tile(np.log(self.share), (len(votes), 1))
        for j, parent in enumerate(self.parent):
            given = votes[:, parent] if parent >= 0 else np.zeros(len(votes), int)
            for y in (0, 1):
                p = self.rate[y][given, j]
                log[:, y] += np.log(np.where(votes[:, j] == 1, p, 1 - p))
        return 1 / (1 + np.exp(np.clip(log[:, 0] - log[:, 1], -700, 700)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, times: np.ndarray | None = None) -> np.ndarray:
    """Weights (the intercept last) by Newton steps on soft labels of rows that count ``times``."""
    times = np.ones(len(x)) if times is None else times
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = times * np.maximum(p * (1 - p), 1e-6)
        w += np.linalg.solve((x * h[:, None]).T @ x + np.diag(penalty), x.T @ (times * (y - p)) - penalty * w)
    return w


def _counted(docs: DataFrame, lexicon: Lexicon, names: list[str]) -> DataFrame:
    """How often each combination of votes occurs, by the columns ``names``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell = lexicon.cells(lexicon.matrix(texts(b)))
            yield pa.RecordBatch.from_arrays([pa.array(cell), *(b.column(n) for n in names)], ["cell", *names])

    return docs.mapInArrow(run, ", ".join(["cell long", *(f"{n} int" for n in names)])).groupBy("cell", *names).count()


def summed(docs: DataFrame, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Combinations of votes over all documents, ascending: their cells, numbers and sums of features.

    Sums are added up per batch, then by Spark; feature -1 is the number of documents.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = lexicon.matrix(texts(b))
            cells, which = np.unique(lexicon.cells(x), return_inverse=True)
            sums = np.zeros((len(cells), lexicon.width + 1))
            np.add.at(sums, which, np.hstack([np.ones((len(x), 1)), x]))
            row, col = np.nonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(cells[row]), pa.array(col - 1), pa.array(sums[row, col])], ["cell", "feature", "s"])

    rows = (docs.select("text").mapInArrow(run, "cell long, feature long, s double")
            .groupBy("cell", "feature").agg(F.sum("s").alias("s")).toArrow())  # at most the combinations times the width
    cell, feature, value = (rows.column(c).to_numpy() for c in ("cell", "feature", "s"))
    cells, which = np.unique(cell, return_inverse=True)
    sums = np.zeros((len(cells), lexicon.width + 1))
    sums[which, feature + 1] = value
    return cells, sums[:, 0], sums[:, 1:]


def _matrix(docs: DataFrame, lexicon: Lexicon, name: str) -> tuple[np.ndarray, np.ndarray]:
    """Features and the column ``name`` of a bounded sample."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = lexicon.matrix(texts(b))
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(x), pa.list_(pa.float64())), b.column(name)], ["x", name])

    rows = docs.mapInArrow(run, f"x array<double>, {name} int").collect()
    rows.sort(key=lambda r: (r[name], r["x"]))
    return (np.array([r["x"] for r in rows]).reshape(len(rows), lexicon.width),
            np.array([r[name] for r in rows], float))


@dataclass
class Model:
    lexicon: Lexicon
    weights: np.ndarray | None
    constant: float

    def score(self, found: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(found), self.constant)
        margin = self.lexicon.matrix(found) @ self.weights[:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_TRAIN_ROWS) -> Model:
    sample = labelled_sample(docs, labels, max_rows).checkpoint()
    lexicon = Lexicon.of(find_terms(sample))
    share = sample.agg(F.avg("y").alias("y")).first()["y"]
    if not lexicon.size:
        return Model(lexicon, None, 0.5 if share is None else float(share))
    cells, times, sums = summed(docs, lexicon)
    known = np.zeros((len(cells), 2))
    for r in _counted(sample.select("text", "y"), lexicon, ["y"]).collect():
        known[np.searchsorted(cells, r["cell"]), r["y"]] = r["count"]
    model = LabelModel(cells, times, known)
    soft = np.array([model.answer[c] for c in cells.tolist()])
    w = logistic(sums / times[:, None], soft, 1.0, times)
    known_x, known_y = _matrix(sample.select("text", "y"), lexicon, "y")
    # calibration: slope and intercept on the labelled sample
    line = logistic((known_x @ w[:-1] + w[-1])[:, None], known_y, 1e-3)
    if line[0] > 0:
        w = np.append(w[:-1] * line[0], w[-1] * line[0] + line[1])
    return Model(lexicon, w, 0.5)


def score(docs: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(model.score(texts(b)))], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")


def op8_toxicity_weak_supervision(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", fold("doc_id", FOLDS, HELD).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
