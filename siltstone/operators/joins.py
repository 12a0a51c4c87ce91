"""Feature joins: blocks of columns added to a base table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from siltstone.operators.dedup import keep_first


def attach(base: DataFrame, blocks: Sequence[DataFrame], keys: Sequence[str], *, dedup: bool = True) -> DataFrame:
    """Left joins each block to the base by the same keys; null keys never match.

    With ``dedup`` all inputs first keep one row per key, so no join multiplies
    rows and no hot key reaches a join. Dedup and joins share their keys: each
    input is shuffled once.
    """
    once = (lambda df: keep_first(df, keys)) if dedup else (lambda df: df)
    joined = once(base)
    for block in blocks:
        joined = joined.join(once(block), list(keys), "left")
    return joined
