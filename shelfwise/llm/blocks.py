"""Comparing the members of large groups block by block."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.shipping import by_value

by_value(__name__)


def block_groups(members: DataFrame, key: str, row: str, size: int) -> DataFrame:
    """``members`` once per block that its block of the same key is compared with.

    A key's rows fall into blocks of about ``size``. ``group`` names a pair of
    blocks; ``alone`` says that both are the same, else rows of different
    ``block`` are to be compared. Every pair of rows of a key meets in one group.
    """
    counted = members.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / size).alias("blocks"))
    return (
        members.join(counted, key)
        .withColumn("block", F.pmod(F.xxhash64(key, row), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .withColumn("alone", F.col("block") == F.col("other"))
        .withColumn("group", F.xxhash64(key, F.least("block", "other"), F.greatest("block", "other")))
        .drop("other", "blocks")
    )


def each_group(
    batches: Iterator[pd.DataFrame], work: Callable[[pd.DataFrame], pd.DataFrame | None], columns: list[str]
) -> Iterator[pd.DataFrame]:
    """Results of ``work`` on each run of rows with the same ``group``; groups are
    of bounded size and may lie across batches."""

    def runs(rows: pd.DataFrame) -> pd.DataFrame:
        edges = np.flatnonzero(rows["group"].values[1:] != rows["group"].values[:-1]) + 1
        found = [work(rows.iloc[part]) for part in np.split(np.arange(len(rows)), edges) if len(part) > 1]
        found = [f for f in found if f is not None]
        return pd.concat(found) if found else pd.DataFrame({c: [] for c in columns}, dtype="int64")

    rest = None
    for pdf in batches:
        rows = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
        if len(rows):
            last = rows["group"].values == rows["group"].values[-1]
            yield runs(rows[~last])
            rest = rows[last]
    if rest is not None:
        yield runs(rest)
