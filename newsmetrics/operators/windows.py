"""Ordered computations that stay parallel when one key holds most of the rows.

A plain ``Window.partitionBy(medio).orderBy(seq)`` sends every row of an outlet
to one task; with two or three outlets that is a third of the data in one
task. These helpers split each key's order into blocks (a block column that
is non-decreasing in the order), work inside ``(key, block)`` window
partitions, and repair block boundaries from a per-block summary table that
is ``block_size`` times smaller than the input:

* ``running_sums``: inclusive prefix sums. Block totals come from a partial
  aggregate of the input (map-side combined, one small row per block); block
  offsets are a prefix sum over that table, either one window per key
  (``depth=0``: N / block_size rows per key, e.g. 15M rows for 10^12 input
  rows) or, for larger inputs, the same method one level up (``depth=1``,
  blocks of blocks).
* ``ordered_sums``: the same sums, with blocks cut by row counts instead of a rule on the
  order: Spark's range partitioning samples (keys, order), so one busy second of one
  key is spread over as many tasks as its share of the rows asks for.
* ``lag``: previous row's values. The first row of each block takes the last
  row of the previous non-empty block of the same key.

Joins back to the input are equi-joins on (key, block); AQE picks broadcast or
shuffle from the measured size of the block table at run time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

DEFAULT_BLOCK = 1 << 16     # rows per block when the order column is a dense sequence
FANOUT = 1 << 12            # blocks per super-block


def _key_join(left: DataFrame, right: DataFrame, keys: list[str], blk: str,
              how: str = "left") -> DataFrame:
    """Join on keys (null-safe) and the block id; right's key columns are dropped."""
    ren = {k: f"__rk{i}" for i, k in enumerate(keys)}
    r = right
    for k, n in ren.items():
        r = r.withColumnRenamed(k, n)
    r = r.withColumnRenamed(blk, "__rblk")
    cond = [left[blk] == r["__rblk"]] + [left[k].eqNullSafe(r[n]) for k, n in ren.items()]
    return left.join(r, cond, how).drop("__rblk", *ren.values())


def running_sums(df: DataFrame, keys: list[str], order: str, sums: dict[str, str],
                 block: Column | None = None, block_size: int = DEFAULT_BLOCK,
                 depth: int = 0, _lvl: int = 0) -> DataFrame:
    """Add inclusive running sums ``out = sum(src) over (keys order by order)``.

    ``block`` must be non-decreasing in ``order`` within a key (default:
    ``floor(order / block_size)`` for a numeric order). Ties in ``order`` are
    not allowed (rows frame). The input is read twice: once through the
    (key, block) window shuffle and once through a map-side combined block
    total aggregate; callers materialize expensive inputs first.
    """
    blk = f"__blk{_lvl}"
    b = block if block is not None else F.floor(F.col(order) / F.lit(block_size))
    d = df.withColumn(blk, b.cast("long"))
    w_in = (Window.partitionBy(*keys, blk).orderBy(order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    dw = d.select("*", *[F.sum(F.col(src)).over(w_in).alias(f"__in_{out}")
                         for out, src in sums.items()])
    bt = d.groupBy(*keys, blk).agg(*[F.sum(F.col(src)).alias(f"__tot_{out}")
                                     for out, src in sums.items()])
    if depth > 0:
        inc = running_sums(
            bt, keys, blk, {f"__inc_{out}": f"__tot_{out}" for out in sums},
            block=F.floor(F.col(blk) / F.lit(FANOUT)), depth=depth - 1, _lvl=_lvl + 1)
    else:
        w_b = (Window.partitionBy(*keys).orderBy(blk)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        inc = bt.select("*", *[F.sum(F.col(f"__tot_{out}")).over(w_b).alias(f"__inc_{out}")
                               for out in sums])
    off = inc.select(*keys, blk, *[(F.col(f"__inc_{out}") - F.col(f"__tot_{out}"))
                                   .alias(f"__off_{out}") for out in sums])
    j = _key_join(dw, off, keys, blk)
    j = j.select("*", *[(F.col(f"__in_{out}") + F.coalesce(F.col(f"__off_{out}"), F.lit(0)))
                        .alias(out) for out in sums])
    return j.drop(blk, *[f"__in_{o}" for o in sums], *[f"__off_{o}" for o in sums])


def ordered_sums(df: DataFrame, keys: list[str], order: list[str], sums: dict[str, str],
                 ranges: int | None = None) -> DataFrame:
    """Add inclusive running sums ``out = sum(src) over (keys order by order)``; src: long.

    One range shuffle deals and sorts the rows; every task adds up its own range as the
    rows stream by and the result is written. A range's offset is the sum of the ranges
    before it, from a table with one row per key and range. Rows equal in keys and order
    count one after the other in any order; a null src adds nothing.
    """
    spark = df.sparkSession
    n = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (df.repartitionByRange(n, *keys, *order).sortWithinPartitions(*keys, *order)
             .withColumn("__range", F.spark_partition_id()))
    schema = T.StructType([*dealt.schema.fields, *(T.StructField(f"__in_{out}", T.LongType()) for out in sums)])

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carried = None, dict.fromkeys(sums, 0)
        for b in batches:
            if not b.num_rows:
                continue
            new = np.zeros(b.num_rows, bool)
            for k in keys:
                c = b.column(k)
                differs = pc.fill_null(pc.not_equal(c[1:], c[:-1]), pc.xor(pc.is_null(c[1:]), pc.is_null(c[:-1])))
                new[1:] |= pc.fill_null(differs, False).to_numpy(zero_copy_only=False)
            here = [b.column(k)[0].as_py() for k in keys]
            begins = np.concatenate(([0], np.flatnonzero(new)))
            for out, src in sums.items():
                total = np.cumsum(pc.fill_null(b.column(src), 0).to_numpy(zero_copy_only=False))
                start = np.concatenate(([0], total[begins[1:] - 1])) if len(begins) > 1 else np.zeros(1, np.int64)
                start[0] = -carried[out] if here == last else 0
                total = total - np.repeat(start, np.diff(np.append(begins, len(total))))
                carried[out] = int(total[-1])
                b = b.append_column(f"__in_{out}", pa.array(total.astype(np.int64)))
            last = [b.column(k)[-1].as_py() for k in keys]
            yield b

    part = materialize(dealt.mapInArrow(add_up, schema), "ordered-sums")
    totals = part.groupBy(*keys, "__range").agg(*[F.sum(src).alias(f"__tot_{out}") for out, src in sums.items()])
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "__range", *[F.coalesce(F.sum(f"__tot_{out}").over(before), F.lit(0)).alias(f"__off_{out}")
                                                for out in sums])
    whole = _key_join(part, offsets, keys, "__range")
    return whole.select(*df.columns, *[(F.col(f"__in_{out}") + F.col(f"__off_{out}")).alias(out) for out in sums])


def lag(df: DataFrame, keys: list[str], order: str, cols: list[str],
        block: Column | None = None, block_size: int = DEFAULT_BLOCK,
        prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row (same key, by order)."""
    blk = "__lblk"
    b = block if block is not None else F.floor(F.col(order) / F.lit(block_size))
    d = df.withColumn(blk, b.cast("long"))
    w = Window.partitionBy(*keys, blk).orderBy(order)
    dw = d.select("*", F.row_number().over(w).alias("__rn"),
                  *[F.lag(F.col(c)).over(w).alias(f"__in_{c}") for c in cols])
    # last row of each block: a map-side combined max_by over the input
    last = d.groupBy(*keys, blk).agg(
        F.max_by(F.struct(*[F.col(c) for c in cols]), F.col(order)).alias("__last"))
    # previous non-empty block of the same key: a window over the block table
    wb = Window.partitionBy(*keys).orderBy(blk)
    prevb = last.select(*keys, blk, F.lag("__last").over(wb).alias("__pb"))
    j = _key_join(dw, prevb, keys, blk)
    j = j.select("*", *[F.when(F.col("__rn") == 1, F.col("__pb")[c])
                        .otherwise(F.col(f"__in_{c}")).alias(prefix + c) for c in cols])
    return j.drop(blk, "__rn", "__pb", *[f"__in_{c}" for c in cols])

