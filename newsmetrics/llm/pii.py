"""Operator 10, personal data by candidate gradient boosting, DataFrame functions only.

Base rules find e-mail addresses, IP addresses, card and phone numbers. For each
kind a wider generator proposes further spans, which may overlap. Every candidate
falls into a cell of format and context features (digits, separators, style,
neighbouring characters, key words before it); Spark counts, per cell, how many
candidates are on target: they meet the base rule, or their value without
disguise passes checks that do not depend on the base expression (top-level
domain, octets, Luhn and issuer digit, digit count and key words). Per kind,
boosted trees are fitted on the cells outside a calibration fold; cells weigh by
the root of their share, so equal shares give equal trees at every size. The
lowest threshold is taken at which the calibration fold's precision reaches
PRECISION; a kind with fewer than LEAST_SEEN candidates there adds nothing. Candidates in cells above it
become spans, unless they overlap a base span. The number of cells is bounded by
the product of the feature levels (CELLS), whatever the input's size, so the
trees travel back as a list of accepted cells.

Regular expressions start at the begin of a run or at the end of the match
before, which finds the same matches as trying every start, in linear time.

Defined results: a null text counts as empty; offsets are code points; without
candidates nothing is added; repeated rows get a row each; null ids stay null;
other columns are ignored (``redact`` keeps them); an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsmetrics.llm import boosted
from newsmetrics.llm.common import fold, table

KINDS = ("email", "ip", "card", "phone")
PRECISION = 0.9
LEAST_SEEN = 20  # candidates that the calibration fold must hold above a threshold
LOCAL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++"
BASE = {
    "email": LOCAL + r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
WIDE = {
    "email": LOCAL + (r"(?: ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?:(?:\.| ?\(dot\) ?| ?\[dot\] ?| dot )[A-Za-z0-9-]++)++"
                      r"| at [A-Za-z0-9-]++(?: dot [A-Za-z0-9-]++)++)"),
    "ip": r"(?:\G|(?<![0-9]))[0-9]{1,3}+(?:(?:\.|\[\.\]|\(\.\)| ?\. )[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[\x20.-]?[0-9]){12,18}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])(?:(?:\+|00)[0-9]{0,3}[\x20.-]?|[0-9]{1,3}[\x20.-]?)?\(?[0-9]{2,4}\)?[\x20.-][0-9]{3,4}[\x20.-]?[0-9]{3,4}(?![0-9A-Za-z])",
}
#: Cheap tests without which an expression can't match; the first to fail saves the rest.
HINT = {
    "email": lambda t: F.contains(t, F.lit("@")),
    "ip": lambda t: t.rlike("[0-9]") & t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike("[0-9]") & t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": lambda t: F.contains(t, F.lit("+")) & t.rlike(r"\+[0-9]"),
}
WIDE_HINT = {
    "email": lambda t: (F.contains(t, F.lit("@")) | F.contains(t, F.lit("(at)")) | F.contains(t, F.lit("[at]"))
                        | F.contains(t, F.lit(" dot "))),
    "ip": lambda t: t.rlike("[0-9]") & t.rlike(r"[0-9](?:\.|\[\.\]|\(\.\)| ?\. )[0-9]"),
    "card": lambda t: t.rlike("[0-9]") & t.rlike(r"[0-9](?:[\x20.-]?[0-9]){12}"),
    "phone": lambda t: t.rlike("[0-9]") & t.rlike(r"[0-9]{2,4}\)?[\x20.-][0-9]{3}"),
}
KEYWORDS = {"email": "mail|contact|write", "ip": r"\bip\b|host|addr|server", "card": "card|visa|master|amex|credit",
            "phone": "tel|phone|call|mobile|fax"}
#: Top-level domains that an address in disguise must end in.
DOMAINS = "[a-z]{2}|com|org|net|edu|gov|mil|int|info|biz|name|app|dev|xyz|online|site|shop|news|example|test"
NATIONAL = r"^(?:[0-9]{0,3}[\x20.-]?\([0-9]{2,4}\)|(?:1[\x20.-])?[2-9][0-9]{2}[\x20.-][2-9][0-9]{2}[\x20.-][0-9]{4}$)"
WEIGHT = 10_000.0  # of all cells of a kind in fitting
LEVELS = (4, 8, 7, 8, 5, 5, 2)  # kind, digits, separators, style, before, after, key word
CELLS = int(np.prod(LEVELS))
FOLDS, HELD = 5, 0
SPANS = "array<struct<start:int,kind:int,end:int>>"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cut(text: Column, pattern: str) -> Column:
    return F.struct(F.split(text, pattern, -1).alias("gaps"),
                    F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"))


def _total(x: Column) -> Column:
    return F.aggregate(x, F.lit(0), lambda a, b: a + b)


def _starts(cut: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a function's table of block offsets: running sums in blocks of the
    square root of the number of matches, so long lists stay cheap."""
    size = F.size(cut["found"])
    lengths = F.zip_with(F.slice(cut["gaps"], F.lit(1), size), cut["found"],
                         lambda g, f: F.length(g) + F.length(f))
    width = F.greatest(F.lit(1), F.ceil(F.sqrt(size)).cast("int"))
    return let(F.struct(lengths.alias("all"), width.alias("width")), lambda s: let(
        F.transform(F.sequence(F.lit(0), s["width"]),
                    lambda b: _total(F.slice(s["all"], b * s["width"] + 1, s["width"]))),
        lambda sums: let(
            F.transform(F.sequence(F.lit(0), s["width"]), lambda b: _total(F.slice(sums, F.lit(1), b))),
            lambda offset: body(F.struct(s["all"].alias("all"), s["width"].alias("width"),
                                         offset.alias("offset"))))))


def _matches(text: Column, pattern: str) -> Column:
    """start, end, value, before (up to 24 characters) and after (up to 1) of every match."""
    def one(cut: Column, s: Column) -> Column:
        def item(v: Column, i: Column) -> Column:
            block = F.floor(i / s["width"]).cast("int")
            start = (F.get(s["offset"], block)
                     + _total(F.slice(s["all"], block * s["width"] + 1, i - block * s["width"]))
                     + F.length(F.get(cut["gaps"], i)))
            return let(start, lambda at: F.struct(
                at.alias("start"), (at + F.length(v)).alias("end"), v.alias("value"),
                F.right(F.get(cut["gaps"], i), F.lit(24)).alias("before"),
                F.left(F.get(cut["gaps"], i + 1), F.lit(1)).alias("after")))
        return F.transform(cut["found"], item)

    return let(_cut(text, pattern), lambda cut: _starts(cut, lambda s: one(cut, s)))


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, -i, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 0, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def valid(kind: str, value: Column) -> Column:
    """Whether a match of the base expression is one."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        def part(p: Column) -> Column:
            short = F.regexp_replace(p, "^0+", "")
            return (F.length(short) <= 3) & (F.coalesce(short.try_cast("int"), F.lit(0)) <= 255)
        return F.forall(F.split(value, r"\."), part)
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(14, 19), let(digits, _luhn)).otherwise(F.lit(False))
    return F.length(digits).between(10, 15)


def meets_base(kind: str, value: Column) -> Column:
    """Whether a candidate as a whole is a valid base match."""
    plain = BASE[kind].replace(r"(?:\G|(?<![A-Za-z0-9._%+-]))", "").replace(r"(?:\G|(?<![0-9]))", "")
    return F.when(value.rlike(f"^(?:{plain})$"), valid(kind, value)).otherwise(F.lit(False))


def _key(kind: str, c: Column) -> Column:
    return c["before"].rlike(f"(?i){KEYWORDS[kind]}")


def on_target(kind: str, c: Column) -> Column:
    """Whether candidate ``c`` meets the base rule, or its value without disguise passes the checks."""
    value = c["value"]
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "email":
        plain = F.regexp_replace(F.regexp_replace(value, r" ?(?:@|\(at\)|\[at\]) ?| at ", "@"),
                                 r" ?(?:\(dot\)|\[dot\]) ?| dot ", ".")
        found = plain.rlike(rf"(?i)^[a-z0-9._%+-]++@(?:[a-z0-9-]++\.)+(?:{DOMAINS})$")
    elif kind == "ip":
        spaced = F.contains(value, F.lit(" "))  # may be a numbered list
        found = valid("ip", F.regexp_replace(value, r"[\[\]()\x20]", "")) & (~spaced | _key(kind, c))
    elif kind == "card":
        found = digits.rlike("^[2-6][0-9]{12,18}$") & ~digits.rlike(r"^([0-9])\1*$") & let(digits, _luhn)
    else:
        size = F.length(F.regexp_replace(digits, "^00", ""))
        found = ((value.rlike(r"^(?:\+|00)") & size.between(8, 15))
                 | (value.rlike(NATIONAL) & size.between(9, 15)) | (_key(kind, c) & size.between(7, 15)))
    return meets_base(kind, value) | found


def _neighbour(c: Column) -> Column:
    return (F.when(c == "", 0).when(c.rlike(r"\p{L}"), 1).when(c.rlike("[0-9]"), 2)
            .when(c.rlike(r"\s"), 3).otherwise(4))


def cell(kind: str, c: Column) -> Column:
    """Number of the feature cell of candidate ``c``."""
    digits = F.length(F.regexp_replace(c["value"], "[^0-9]", ""))
    bucket = sum(((digits > n).cast("int") for n in (3, 6, 9, 12, 15, 16, 19)), F.lit(0))
    marks = F.least(F.length(F.regexp_replace(c["value"], "[0-9A-Za-z]", "")), F.lit(6))
    style = sum((F.contains(c["value"], F.lit(m)).cast("int") * w for m, w in (("(", 4), ("-", 2), (".", 1))),
                F.lit(0))
    key = _key(kind, c).cast("int")
    code = F.lit(KINDS.index(kind))
    for level, size in zip((bucket, marks, style, _neighbour(F.right(c["before"], F.lit(1))),
                            _neighbour(c["after"]), key), LEVELS[1:]):
        code = code * size + level
    return code


def base_spans(kind: str, text: Column) -> Column:
    found = F.filter(_matches(text, BASE[kind]), lambda m: valid(kind, m["value"]))
    spans = F.transform(found, lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))
    return F.when(HINT[kind](text), spans).otherwise(F.array().cast(SPANS))


def candidates(kind: str, text: Column, target: bool = False) -> Column:
    """start, kind, end, cell and label (1: meets the base rule, or is on target) of the wide generator's matches."""
    def label(m: Column) -> Column:
        return on_target(kind, m) if target else meets_base(kind, m["value"])

    spans = F.transform(_matches(text, WIDE[kind]), lambda m: F.struct(
        m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end"),
        cell(kind, m).alias("cell"), label(m).cast("int").alias("label")))
    nothing = F.array().cast("array<struct<start:int,kind:int,end:int,cell:int,label:int>>")
    return F.when(WIDE_HINT[kind](text), spans).otherwise(nothing)


def cell_features(codes: np.ndarray) -> np.ndarray:
    rest, columns = codes.copy(), []
    for size in LEVELS[::-1]:
        columns.append(rest % size)
        rest //= size
    return np.stack(columns[::-1], 1).astype(float)


def cell_weights(rows: np.ndarray) -> np.ndarray:
    """Weight of every row (cell, label, fold, count): the root of its cell's share, dealt to the labels by count."""
    if not len(rows):
        return np.zeros(0)
    _, place = np.unique(rows[:, 0], return_inverse=True)
    count = rows[:, 3].astype(float)
    total = np.bincount(place, count)
    root = np.sqrt(total / total.sum())
    return WEIGHT * (root / root.sum())[place] * count / total[place]


def accepted_cells(docs: DataFrame) -> list[int]:
    """Cells whose boosted score passes the calibrated threshold of their kind."""
    text = F.coalesce("text", F.lit(""))
    each = docs.select(fold("doc_id", FOLDS, HELD).alias("held"),
                       F.explode(F.concat(*(candidates(k, text, target=True) for k in KINDS))).alias("c"))
    counts = each.groupBy(F.col("c.cell").alias("cell"), F.col("c.label").alias("label"), "held").count().collect()
    if not counts:
        return []
    rows = np.array([[r["cell"], r["label"], r["held"], r["count"]] for r in counts], np.int64)
    rows = rows[np.lexsort(rows.T[::-1])]
    fit, held = rows[rows[:, 2] == 0], rows[rows[:, 2] == 1]
    accepted = []
    for k in range(len(KINDS)):
        kind = CELLS // len(KINDS)
        mine = fit[fit[:, 0] // kind == k]
        forest = boosted.fit(cell_features(mine[:, 0]), mine[:, 1].astype(float), depth=3, bins=16,
                             weight=cell_weights(mine))
        own = np.unique(rows[rows[:, 0] // kind == k, 0])
        score = dict(zip(own.tolist(), forest.probability(cell_features(own)).tolist()))
        own = list(score)
        for t in sorted({score[c] for c in own if score[c] > 0.5}):
            above = [c for c in own if score[c] >= t]
            seen = held[np.isin(held[:, 0], above)]
            total, good = seen[:, 3].sum(), (seen[:, 3] * seen[:, 1]).sum()
            if total >= LEAST_SEEN and good >= PRECISION * total:
                accepted += above
                break
    return sorted(accepted)


def find(docs: DataFrame, accepted: list[int]) -> DataFrame:
    """doc_id and, per row, the base and added spans as arrays sorted by start and kind."""
    text = F.coalesce("text", F.lit(""))

    def extra(row_base: Column) -> Column:
        chosen = F.filter(F.concat(*(candidates(k, text) for k in KINDS)),
                          lambda c: (c["label"] == 0) & c["cell"].isin(accepted))
        free = F.filter(chosen, lambda c: ~F.exists(
            row_base, lambda b: (b["start"] < c["end"]) & (c["start"] < b["end"])))
        return F.transform(free, lambda c: F.struct(c["start"], c["kind"], c["end"]))

    both = let(F.array_sort(F.concat(*(base_spans(k, text) for k in KINDS))), lambda base: F.struct(
        base.alias("base"), (extra(base) if accepted else F.array().cast(SPANS)).alias("added")))
    return docs.select("doc_id", both.alias("s")).select("doc_id", "s.base", "s.added")


def listing(spans: Column) -> Column:
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(docs: DataFrame, accepted: list[int]) -> DataFrame:
    """``docs`` with every span in ``text`` replaced by its kind in brackets, and n_chars to match.

    Kinds are redacted one after the other in the listed order, accepted
    candidates after the base spans; a null text stays null. All other columns
    are kept.
    """
    def cover(text: Column, hint: Column, kind: str, pattern: str, test: Callable[[Column], Column]) -> Column:
        def join(cut: Column) -> Column:
            def piece(v: Column, i: Column) -> Column:
                m = F.struct(v.alias("value"), F.right(F.get(cut["gaps"], i), F.lit(24)).alias("before"),
                             F.left(F.get(cut["gaps"], i + 1), F.lit(1)).alias("after"))
                return F.concat(F.get(cut["gaps"], i), F.when(test(m), f"[{kind.upper()}]").otherwise(v))
            return F.concat(F.array_join(F.transform(cut["found"], piece), ""),
                            F.element_at(cut["gaps"], -1))
        return F.when(hint, let(_cut(text, pattern), join)).otherwise(text)

    def base_rule(kind: str) -> Column:
        return let(F.col("text"), lambda t: cover(
            t, HINT[kind](t), kind, BASE[kind], lambda m: valid(kind, m["value"])))

    def wide_rule(kind: str) -> Column:
        return let(F.col("text"), lambda t: cover(
            t, WIDE_HINT[kind](t), kind, WIDE[kind], lambda m: cell(kind, m).isin(accepted)))

    out = docs
    for kind in KINDS:
        out = out.withColumn("text", base_rule(kind))
    for kind in KINDS if accepted else ():
        out = out.withColumn("text", wide_rule(kind))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(docs.columns)


def op10_pii_boosted_candidates(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, accepted_cells(docs))

    def count(k: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("long").alias(f"n_{k}")

    return found.select("doc_id", *(count(k) for k in KINDS),
                        F.sha2(listing(F.col("base")).cast("binary"), 256).alias("base_sha256"),
                        listing(F.array_sort(F.concat("base", "added"))).alias("spans"),
                        F.size("added").cast("long").alias("n_added"))
