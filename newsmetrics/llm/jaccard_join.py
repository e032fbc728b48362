"""Operator 7, n-gram Jaccard join by vertical partitioning.

The global order of the n-grams (their hash order) is cut into fragments; a
document's set becomes one segment per fragment.

* Candidates. Documents in the same size class use the same cut into F fragments,
  F above the number of n-grams in which two linked sets may differ. So at least
  one of their segments is equal, and about a third if the differences fall at
  random. Documents meet that share a non-empty segment out of the first POSTED
  fragments. With F <= POSTED this finds every link (sets whose n-grams crowd
  into too few fragments post prefix n-grams besides); beyond, three shared
  segments are asked for, and a link at the very threshold has fewer with a
  probability of about 1e-10.
* Overlaps. Candidate pairs are joined with the segments of a coarse cut, the
  overlap of each fragment is counted separately and summed per pair.

Equal sets are collapsed first. Every set is verified against the hub with which it
shares most segments. Then every set joins the group of the component that it meets
most often (of those that prevail under its signatures). In a group, sets of other
components are compared with all members by the
differences to the group's consensus (the n-grams that half of it hold): two sets
overlap in the consensus less what either lacks, plus what both lack or both have
beyond it. If the sizes alone suffice, both are linked to the member nearest the
consensus; else they must share differences, and are joined on their rarest ones. So a
group of near copies costs its differences, not its pairs. Where more than CROWD sets of
several groups still meet under one signature, all of them become members of the group that prevails there,
besides their own, and are settled in the same way. Only sets of different groups that meet under less crowded
signatures are paired one by one.

Defined results: null text counts as empty; rows without words have no n-grams
and are linked with nothing; a null id takes no part in links and keeps a null
component; repeated rows get one row each; two texts of one id are sets of their own, and
links do not pass from one to the other through the id; texts of any length give their whole set;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsmetrics.llm.common import Workspace, mix, table, texts, written
from newsmetrics.llm.graph import components
from newsmetrics.llm.shingles import window_hashes, word_hashes

POSTED = 64  # segments that a set posts per size class
SHARED = 3  # of which linked sets share at least so many, if there are more fragments
CLASS_STEP = 1.4  # ratio of neighbouring size classes
GROUPINGS = 2  # rounds of grouping around components
CROWD = 32  # sets under one signature up to which those of different groups are paired one by one
COARSE = 4  # fragments in which overlaps are counted
BROADCAST_NODES = 300_000  # 40 bytes each
SETS = "doc_id long, n long, hi long, lo long, posts array<long>, needs array<int>"
SEGMENTS = "node long, n long, fragment int, segment array<long>"


def ngram_set(text: str, size: int) -> np.ndarray:
    return np.unique(window_hashes(word_hashes(text), size))


class Cuts:
    """Size classes and their fragment edges for one threshold (in per cent)."""

    def __init__(self, percent: int):
        self.percent = percent
        self.edges: dict[int, np.ndarray] = {}

    def size_class(self, n: int) -> int:
        return int(np.log(n) / np.log(CLASS_STEP) + 1e-9)

    def classes(self, n: int) -> range:
        """Own class and those of smaller sets it may be linked with."""
        least = -(-n * self.percent // 100)
        return range(self.size_class(max(least, 1)), self.size_class(n) + 1)

    def budget(self, c: int) -> int:
        """Largest symmetric difference of a link whose smaller set is in class c."""
        top = int(CLASS_STEP ** (c + 1)) + 1
        both = top + 100 * top // self.percent
        return both * (100 - self.percent) // (100 + self.percent)

    def fragments(self, c: int) -> np.ndarray:
        """Lower edges of the class's fragments in hash order."""
        if c not in self.edges:
            f = self.budget(c) + 2 + self.budget(c) // 16
            self.edges[c] = np.array([(g << 64) // f for g in range(f)], np.uint64)
        return self.edges[c]

    def posts(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Signatures under which a set meets others, the size class in the low byte, and
        how many of a class linked sets share at least."""
        n = len(grams)
        if not n:
            return grams, np.zeros(0, np.int32)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(grams))))
        found, needs = [], []

        def add(signatures: np.ndarray, tag: int, need: int) -> None:
            found.append(signatures & np.uint64(2 ** 64 - 256) | np.uint64(tag))
            needs.append(np.full(len(signatures), need, np.int32))

        for c in self.classes(n):
            edges = self.fragments(c)
            k = min(len(edges), POSTED)
            at = np.append(np.searchsorted(grams, edges[:k + 1]), n)[:k + 1]
            tags = mix(np.arange(k, dtype=np.uint64) + np.uint64((c + 1) << 32))
            full = at[1:] > at[:-1]
            sure = int(full.sum()) - self.budget(c) if k == len(edges) else min(SHARED, int(full.sum()))
            add(mix((total[at[1:]] - total[at[:-1]]) ^ tags)[full], c, max(sure, 1))
            if k == len(edges) and sure < 1:
                add(mix(grams[:n - -(-n * self.percent // 100) + 1] ^ np.uint64(0x5DEECE66D)), c + 128, 1)
        return np.concatenate(found), np.concatenate(needs)


def _longs(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def shingle_sets(docs: DataFrame, size: int, percent: int, keyed: bool = False) -> DataFrame:
    """One row per document: set size, 128-bit set signature, posted signatures, a hash of the text if ``keyed``."""
    cuts = Cuts(percent)
    extra = ["text_key"] if keyed else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = [ngram_set(t, size) for t in texts(b)]
            signature = np.array([[mix(s).sum(dtype=np.uint64), mix(~s).sum(dtype=np.uint64)]
                                  for s in sets], np.uint64).reshape(-1, 2)
            posts = [cuts.posts(s) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(_longs(signature[:, 0].copy())), pa.array(_longs(signature[:, 1].copy())),
                 pa.array([_longs(p) for p, _ in posts], pa.list_(pa.int64())),
                 pa.array([k for _, k in posts], pa.list_(pa.int32()))] + [b.column(k) for k in extra],
                ["doc_id", "n", "hi", "lo", "posts", "needs"] + extra)

    return (docs.select(F.col("doc_id").cast("long"), "text", *(text_key(docs).alias(k) for k in extra))
            .mapInArrow(run, SETS + "".join(f", {k} long" for k in extra)))


def text_key(docs: DataFrame) -> Column:
    """Tells rows with one id apart."""
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def segments(docs: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The coarse segments of the sets in ``nodes`` (node, doc_id, hi, lo)."""
    edges = np.array([(g << 64) // COARSE for g in range(COARSE)], np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, n, fragment, part = [], [], [], []
            keys = zip(*(b.column(k).to_pylist() for k in ("node", "hi", "lo")))
            for (k, hi, lo), t in zip(keys, texts(b)):
                s = ngram_set(t, size)
                own = np.array([mix(s).sum(dtype=np.uint64), mix(~s).sum(dtype=np.uint64)])
                if own.view(np.int64).tolist() != [hi, lo]:
                    continue  # another row with the same id
                at = np.append(np.searchsorted(s, edges), len(s))
                for g in range(COARSE):
                    node.append(k), n.append(len(s)), fragment.append(g)
                    part.append(_longs(s[at[g]:at[g + 1]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int64()), pa.array(n, pa.int64()), pa.array(fragment, pa.int32()),
                 pa.array(part, pa.list_(pa.int64()))], ["node", "n", "fragment", "segment"])

    # the ids of a few documents travel to the texts; of many, the texts to the ids
    few = nodes.count() <= BROADCAST_NODES
    wanted = (docs.select(F.col("doc_id").cast("long"), "text")
              .join(F.broadcast(nodes) if few else nodes, "doc_id").select("node", "hi", "lo", "text"))
    return wanted.mapInArrow(run, SEGMENTS)


def linked(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    left = parts.select(F.col("node").alias("a"), F.col("n").alias("na"), "fragment",
                        F.col("segment").alias("sa"))
    right = parts.select(F.col("node").alias("b"), F.col("n").alias("nb"), "fragment",
                         F.col("segment").alias("sb"))
    # a repeated row repeats its segments, hence the maximum
    partial = (pairs.join(left, "a").join(right, ["b", "fragment"])
               .select("a", "b", "na", "nb", "fragment", F.size(F.array_intersect("sa", "sb")).alias("common")))
    return (partial.groupBy("a", "b", "na", "nb", "fragment").agg(F.max("common").alias("common"))
            .groupBy("a", "b", "na", "nb").agg(F.sum("common").alias("common"))
            .where(100 * F.col("common") >= percent * (F.col("na") + F.col("nb") - F.col("common")))
            .select("a", "b"))


def parts_of(pairs: DataFrame, docs: DataFrame, nodes: DataFrame, size: int, step: Workspace) -> DataFrame:
    """The coarse segments of the sets in ``pairs``, among the tables of ``step``."""
    ends = pairs.select(F.col("a").alias("node")).unionAll(pairs.select("b")).distinct()
    parts = step.write(segments(docs, step.write(nodes.join(ends, "node"), "jaccard-ends"), size), "jaccard-segments")
    step.drop("jaccard-ends")
    return parts


def with_label(rows: DataFrame, label: DataFrame, node: str, name: str) -> DataFrame:
    """``rows`` with the component of the column ``node``, which is the node itself if it has no links."""
    own = label.select(F.col("node").alias("__node"), F.col("label").alias("__label"))
    return (rows.join(own, rows[node] == own["__node"], "left")
            .withColumn(name, F.coalesce("__label", node)).drop("__node", "__label"))


def grouped(met: DataFrame, ends: DataFrame, label: DataFrame) -> DataFrame:
    """node, label and group of the nodes in ``ends``: the component, among those that
    prevail under the node's signatures, which prevails under most."""
    step = Workspace(met.sparkSession, "jaccard-grouping")
    named = step.write(with_label(met.select("post", "node"), label, "node", "label"), "jaccard-named")
    prevails = step.write(named.groupBy("post", "label").count().groupBy("post")
                          .agg(F.max_by("label", F.struct("count", -F.col("label"))).alias("group")), "jaccard-prevails")
    times = named.join(prevails, "post").groupBy("node", "label", "group").count()
    found = written(times.groupBy("node", "label")
                        .agg(F.max_by("group", F.struct("count", -F.col("group"))).alias("group")).join(ends, "node"),
                        "jaccard-groups")
    step.drop()
    return found


def met_by_differences(rare: DataFrame, percent: int) -> tuple[DataFrame, Column]:
    """Pairs of ``rare`` rows of different components by the differences that both have, and (100 + percent) times
    what a pair must share to be linked.

    A pair that must share k differences meets before the last k - 1 of either.
    """
    other = rare.select("group", "gram", "kind", *(F.col(c).alias(f"{c}_b") for c in ("node", "label", "place", "e", "differences")))
    asked = F.col("e") + F.col("e_b") - F.col("free")
    after = F.least(F.col("differences") - F.col("place"), F.col("differences_b") - F.col("place_b"))
    return rare.join(other, ["group", "gram", "kind"]).where(
        (F.col("node") < F.col("node_b")) & (F.col("label") != F.col("label_b")) & ((100 + percent) * (after + 1) >= asked)), asked


def links_in_groups(members: DataFrame, parts: DataFrame, links: DataFrame, percent: int) -> DataFrame:
    """All links between different components inside the groups of ``members`` (group, node, label).

    A node may be a member of several groups. A table of the step goes when the last that is made of it is written.
    """
    step = Workspace(members.sparkSession, "jaccard-step")
    size = members.groupBy("group").agg(F.count("*").alias("size"), F.count_if(F.col("label") != F.col("group"))
                                        .alias("apart")).where("apart > 0")
    rows = step.write(members.join(size, "group").join(parts.dropDuplicates(["node", "fragment"]), "node"),
                       "jaccard-members")
    counted = (rows.select("group", "size", "fragment", F.explode("segment").alias("gram"))
               .groupBy("group", "fragment", "gram", "size").count().where("2 * count >= size"))
    counted = step.write(counted, "jaccard-consensus")
    consensus = counted.groupBy("group", "fragment").agg(F.collect_list("gram").alias("common"))
    whole = counted.groupBy("group").agg(F.count("*").alias("whole"))
    none = F.array().cast("array<bigint>")
    common = F.coalesce("common", none)
    apart = step.write(
        rows.join(consensus, ["group", "fragment"], "left")
        .select("group", "node", "n", F.array_except(common, F.col("segment")).alias("gone"),
                F.array_except(F.col("segment"), common).alias("extra")), "jaccard-apart")
    # with e = 100 * gone + percent * extra, x and y are linked if
    # e(x) + e(y) <= (100 - percent) * whole + (100 + percent) * shared differences
    total = (apart.groupBy("group", "node").agg(F.sum(F.size("gone")).alias("gone"), F.sum(F.size("extra")).alias("extra"))
             .join(whole, "group", "left")
             .select("group", "node", (100 * F.col("gone") + percent * F.col("extra")).alias("e"),
                     ((100 - percent) * F.coalesce("whole", F.lit(0))).alias("free")))
    total = step.write(total, "jaccard-totals")
    step.drop("jaccard-members", "jaccard-consensus")
    best = total.groupBy("group").agg(F.min_by("node", F.struct("e", "node")).alias("best"), F.min("e").alias("least"))
    sure = step.write(total.join(best, "group").where("node <> best AND e + least <= free")
                       .select(F.col("best").alias("a"), F.col("node").alias("b")), "jaccard-sure")

    # e(y) >= percent * shared and e(y) >= least, so x is linked beyond that only with sets that share at
    # least (e(x) - free) / 100 and (e(x) + least - free) / (100 + percent) of its differences; hence its
    # rarest ones suffice to meet them
    label = components(links.unionAll(sure), step)
    kinds = F.concat(F.transform("gone", lambda g: F.struct(g.alias("gram"), F.lit(0).alias("kind"))),
                     F.transform("extra", lambda g: F.struct(g.alias("gram"), F.lit(1).alias("kind"))))
    key = ["group", "gram", "kind"]
    grams = step.write(with_label(
        apart.select("group", "node", F.explode(kinds).alias("g")).select("group", "node", "g.gram", "g.kind"),
        label, "node", "label"), "jaccard-differences")
    step.drop("jaccard-apart")
    seen = step.write(grams.groupBy(key).agg(F.count("*").alias("seen"), F.min("label").alias("low"),
                                              F.max("label").alias("high")), "jaccard-seen")
    # only differences that a set of another component has too can be shared; a set that has too few is done
    member = Window.partitionBy("group", "node")
    least = F.greatest(F.ceil((F.col("e") - F.col("free")) / 100),
                       F.ceil((F.col("e") + F.col("least") - F.col("free")) / (100 + percent)), F.lit(1))
    total = total.join(best.select("group", "least"), "group")
    rare = (grams.join(seen.where("low <> high").select(*key, "seen"), key)
            .withColumn("place", F.row_number().over(member.orderBy("seen", "gram", "kind")))
            .withColumn("differences", F.count("*").over(member)).join(total, ["group", "node"])
            .where(F.col("place") <= F.col("differences") - least + 1)
            .select(*key, "node", "label", "place", "e", "differences", "free"))
    rare = step.write(rare, "jaccard-rare")
    step.drop("jaccard-differences", "jaccard-seen")
    met, asked = met_by_differences(rare, percent)
    # beyond the last rare difference that they share, neither can share more than it has left
    left = F.least(F.col("differences") - F.col("at"), F.col("differences_b") - F.col("at_b"))
    pairs = (met.groupBy(F.col("node").alias("a"), F.col("node_b").alias("b"), "e", "e_b", "differences", "differences_b",
                         "free").agg(F.count("*").alias("shared"), F.max("place").alias("at"), F.max("place_b").alias("at_b"))
             .where((100 + percent) * (F.col("shared") + left) >= asked).select("a", "b").distinct())
    found = written(sure.unionAll(linked(step.write(pairs, "jaccard-group-pairs"), parts, percent)), "jaccard-in-groups")
    step.drop()
    return found


def jaccard_components(docs: DataFrame, size: int = 4, percent: int = 85, keyed: bool = False) -> DataFrame:
    """doc_id, n_shingles, component_id and, if ``keyed``, text_key for every row of ``docs``."""
    extra = ["text_key"] if keyed else []
    # sets and posts are large, and go when all signatures that several sets have are written
    step = Workspace(docs.sparkSession, "jaccard-posted")
    sets = step.write(shingle_sets(docs, size, percent, keyed), "jaccard-sets")
    ids = written(sets.select("doc_id", "n", "hi", "lo", *extra), "jaccard-ids")
    nodes = written(
        ids.where("n > 0 AND doc_id IS NOT NULL").groupBy("hi", "lo")
        .agg(F.min("doc_id").alias("doc_id")).withColumn("node", F.monotonically_increasing_id()),
        "jaccard-nodes")
    posts = step.write(
        sets.join(nodes, ["hi", "lo", "doc_id"])
        .select("node", "n", F.explode(F.arrays_zip("posts", "needs")).alias("p"))
        .select("node", "n", F.col("p.posts").alias("post"), F.col("p.needs").alias("need")), "jaccard-posts")
    # aggregates are written before they are joined, so that AQE can split the partitions of a
    # frequent key: it does so for joins of plain shuffles only
    shared = step.write(posts.groupBy("post").agg(F.min("node").alias("hub"), F.max("node").alias("last"))
                        .where("hub <> last").select("post", "hub"), "jaccard-shared")
    between = Workspace(docs.sparkSession, "jaccard-between")
    met = between.write(posts.join(shared, "post"), "jaccard-met")
    step.drop()

    # 1: every set against the hub it meets most often
    star = (met.where("node <> hub").groupBy("hub", "node", "need").agg(F.count("*").alias("times"))
            .where("2 * times >= need").groupBy("node")
            .agg(F.max_by("hub", F.struct("times", -F.col("hub"))).alias("hub"))
            .select(F.col("hub").alias("a"), F.col("node").alias("b")))
    star = written(star, "jaccard-star")
    step = Workspace(docs.sparkSession, "jaccard-starred")
    parts = parts_of(star, docs, nodes, size, step)
    links = written(linked(star, parts, percent), "jaccard-links")

    # 2: inside the groups around prevailing components
    ends = parts.select("node").distinct()
    groups = []
    for number in range(GROUPINGS):
        label = components(links, between, f"label{number}")
        member = grouped(met, ends, label)
        links = written(links.unionAll(links_in_groups(member, parts, links, percent)), "jaccard-group-links")
        groups.append(member.select("node", F.col("group").alias(f"group{number}")))
    step.drop()

    # 3: what still meets across groups and components. Under a crowded signature no pairs are made: all
    # its sets are members, some once more, of the group that prevails there, and settled by its consensus
    label = components(links, between, "label")
    named = with_label(met, label, "node", "label").select("post", "need", "node", "n", "label")
    settled = [f"group{k}" for k in range(GROUPINGS)]
    for g, name in zip(groups, settled):
        named = named.join(g, "node", "left").withColumn(name, F.coalesce(name, -1 - F.col("node")))
    step = Workspace(docs.sparkSession, "jaccard-rest")
    named = step.write(named.distinct(), "named")
    between.drop()
    several = reduce(lambda x, y: x & y, (F.col(f"{c}_low") != F.col(f"{c}_high") for c in ("label", *settled)))
    last = settled[-1]
    open_posts = step.write(
        named.groupBy("post").agg(F.count("*").alias("crowd"), *(f(c).alias(f"{c}_{end}") for c in ("label", *settled)
                                                                for f, end in ((F.min, "low"), (F.max, "high"))))
        .where(several).select("post", "crowd"), "open-posts")
    named = step.write(named.join(open_posts, "post"), "open")
    step.drop("named", "open-posts")
    few, many = named.where(F.col("crowd") <= CROWD), named.where(F.col("crowd") > CROWD)
    prevails = step.write(many.groupBy("post", last).count().groupBy("post")
                          .agg(F.max_by(last, F.struct("count", -F.col(last))).alias("group")), "prevails")
    crowds = step.write(many.join(prevails, "post").select("group", "node", "label").distinct(), "crowds")
    other = few.select("post", *(F.col(c).alias(f"{c}_b") for c in ("need", "node", "n", "label", *settled)))
    apart = reduce(lambda x, y: x & y, (F.col(g) != F.col(f"{g}_b") for g in settled))
    rest = (few.join(other, "post")
            .where((F.col("node") < F.col("node_b")) & (F.col("label") != F.col("label_b"))
                   & apart
                   & (100 * F.least("n", "n_b") >= percent * F.greatest("n", "n_b")))
            .groupBy(F.col("node").alias("a"), F.col("node_b").alias("b"), F.col("post").bitwiseAND(255).alias("tag"))
            .agg(F.count("*").alias("times"), F.max(F.greatest("need", "need_b")).alias("need"))
            .where("times >= need").select("a", "b").distinct())
    rest = step.write(rest.join(star, ["a", "b"], "left_anti"), "rest")
    step.drop("open", "prevails")
    asked = rest.unionAll(crowds.select(F.col("node").alias("a"), F.col("node").alias("b")))
    parts = parts_of(asked, docs, nodes, size, step)
    more = written(linked(rest, parts, percent).unionAll(links_in_groups(crowds, parts, links, percent)), "jaccard-more")
    step.drop()
    label = components(written(links.unionAll(more), "jaccard-all-links"))

    named = nodes.join(label, "node", "left").select(
        "hi", "lo", "doc_id", F.coalesce("label", "node").alias("label"))
    least = named.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    classes = named.join(least, "label").select("hi", "lo", "component_id")
    return (ids.join(classes, ["hi", "lo"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"),
                    F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component_id")))
                    .otherwise(F.col("doc_id")).alias("component_id"), *extra))


def keep_one(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` but those linked to a smaller id, all columns as they are.

    Rows that repeat id and text are kept once, rows without id all. Rows of one id with
    different texts are judged each by its own text.
    """
    found = written(jaccard_components(docs, size, percent, keyed=True), "jaccard-result")
    gone = found.where("component_id < doc_id").select("doc_id", "text_key").distinct()
    kept = docs.join(gone, (docs["doc_id"] == gone["doc_id"]) & (text_key(docs) == gone["text_key"]), "left_anti")
    repeated = found.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not repeated.take(1):
        return kept
    again = docs["doc_id"] == repeated["doc_id"]
    return (kept.join(repeated, again, "left_anti")
            .unionAll(kept.join(repeated, again, "left_semi").dropDuplicates(["doc_id", "text"])))


def op7_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))
