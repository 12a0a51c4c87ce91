"""Sharding by sampled splitters: shards of near equal bytes, cut from one key order.

Keys are sampled with a probability in proportion to their record's load (its size and
ROW_LOAD, so that very many small records are split too); quantiles of the sample are the
splitters of RANGES_PER_SHARD ranges per shard, or more where a range's due would pass
RANGE_LOAD. Records are counted per range; a range that is overfull gets a sample and
splitters of its own, again and again, until none holds more than twice its due beside its
largest record, so no task sorts more than that at any input size. A record's place is then
its range's offset plus its place in the range, and its shard follows from the bytes before
it, exactly.

The driver holds SAMPLED_PER_RANGE keys and one count per range: at 100 TB some 100,000
ranges, which are 60 MB.

The order is by the given key, then by a row number, so records of one key stay side by
side and a hot key is cut like any other stretch.

Defined results: a null key sorts first; records of size 0 lie where their key lies;
rows that repeat get places of their own; an empty table gives an empty result; with
fewer records than shards, some shards stay empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from siltstone.llm.shared import written

RANGES_PER_SHARD = 16
#: The largest due of a range: what one task sorts is about this.
RANGE_LOAD = 1 << 30
#: What a record counts for beside its size.
ROW_LOAD = 64
#: Sampled keys per range: what the driver holds is this times the number of ranges.
SAMPLED_PER_RANGE = 24
_KEY = np.dtype([("k0", "<i8"), ("k1", "<i8"), ("k2", "<i8")])


def _keys(batch: pa.RecordBatch) -> np.ndarray:
    out = np.empty(batch.num_rows, dtype=_KEY)
    for name in _KEY.names:
        out[name] = batch.column(name).to_numpy(zero_copy_only=False)
    return out


def _ranged(keyed: DataFrame, splitters: np.ndarray) -> DataFrame:
    """keyed with `range`: the number of splitters at or below the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(splitters, _keys(batch), side="right").astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(at)], [*batch.schema.names, "range"])

    return keyed.mapInArrow(run, keyed.withColumn("range", F.lit(0).cast("long")).schema)


#: Times that overfull ranges are divided; keys are distinct, so a few suffice.
ROUNDS = 63


def _load() -> Column:
    return F.col("size") + ROW_LOAD


def _sampled(keyed: DataFrame, per_load: float, salt: int) -> np.ndarray:
    """Sorted keys, each drawn with the probability load * per_load."""
    chance = F.shiftrightunsigned(F.xxhash64(F.lit(salt), "k2"), 11) / F.lit(float(1 << 53))
    rows = keyed.filter(chance < _load() * F.lit(per_load)).select(*_KEY.names).toArrow()
    out = np.empty(rows.num_rows, dtype=_KEY)
    for name in _KEY.names:
        out[name] = rows.column(name).to_numpy()
    return np.sort(out)


def _quantiles(keys: np.ndarray, parts: int) -> np.ndarray:
    at = (np.arange(1, parts) * len(keys)) // parts
    return np.unique(keys[at]) if len(keys) else keys


def _counted(ranged: DataFrame) -> list:
    """A row per range: their number is bounded by that of the splitters."""
    return (
        ranged.groupBy("range")
        .agg(
            F.sum("size").alias("bytes"), F.sum(_load()).alias("load"), F.max(_load()).alias("largest"),
            F.count("*").alias("n"),
        )
        .orderBy("range")
        .collect()
    )


def splitter_shards(records: DataFrame, size: Column, key: list[Column], shards: int) -> DataFrame:
    """`row` (all columns of records), `size`, `shard` and `slot` (place in the shard, from 0).

    key: one or two whole-number columns."""
    parts = [F.coalesce(k.cast("long"), F.lit(-(1 << 63))) for k in [*key, F.lit(0)][:2]]
    keyed = written(
        records.select(
            F.struct("*").alias("row"), F.coalesce(size.cast("long"), F.lit(0)).alias("size"),
            parts[0].alias("k0"), parts[1].alias("k1"), F.monotonically_increasing_id().alias("k2"),
        ),
        "keyed",
    )
    slim = keyed.drop("row")
    total, load = (found or 0 for found in slim.agg(F.sum("size"), F.sum(_load())).first())
    ranges = max(shards * RANGES_PER_SHARD, -(-load // RANGE_LOAD))
    due = max(1.0, load / ranges)
    splitters = _quantiles(_sampled(slim, SAMPLED_PER_RANGE / due, 0), ranges)
    for salt in range(1, ROUNDS + 1):
        counted = _counted(_ranged(slim, splitters))
        over = [r for r in counted if r["load"] - r["largest"] > 2 * due]
        if not over:
            break
        inside = _ranged(slim, splitters).filter(F.col("range").isin([r["range"] for r in over]))
        keys = _sampled(inside, SAMPLED_PER_RANGE / due, salt)
        at = np.searchsorted(splitters, keys, side="right")
        new = [_quantiles(keys[at == r["range"]], int(r["load"] / due) + 2) for r in over]
        splitters = np.unique(np.concatenate([splitters, *new]))
    else:  # ranges that stay overfull are only large; counts must be those of the last splitters
        counted = _counted(_ranged(slim, splitters))
    spark = records.sparkSession
    before, rows = 0, []
    place = 0
    for r in counted:
        rows.append((r["range"], before, place))
        before, place = before + r["bytes"], place + r["n"]
    offsets = spark.createDataFrame(rows, "of bigint, bytes_before bigint, rows_before bigint")
    order = Window.partitionBy("range").orderBy(*_KEY.names)
    through = F.col("bytes_before") + F.sum("size").over(order)
    shard = F.least(
        F.lit(shards - 1), F.expr(f"((2 * through - size) * {shards}L) div {max(1, 2 * total)}L").cast("int")
    )
    placed = written(
        _ranged(keyed, splitters)
        .join(F.broadcast(offsets), F.col("range") == F.col("of"))
        .withColumn("through", through)
        .withColumn("place", F.col("rows_before") + F.row_number().over(order) - 1)
        .select("row", "size", "place", shard.alias("shard")),
        "placed",
    )
    first = placed.groupBy("shard").agg(F.min("place").alias("first")).withColumnRenamed("shard", "of")
    return placed.join(F.broadcast(first), F.col("shard") == F.col("of")).select(
        "row", "size", "shard", (F.col("place") - F.col("first")).alias("slot")
    )
