"""Near-duplicate vectors by binary codes of randomly rotated vectors.

A unit vector, randomly rotated, is coded by its signs. The inner product of the
rotated vector with its own code is stored as a correction factor: with it the
code gives an unbiased estimate of the inner product with any other vector, and
a bound on the error. Pairs whose estimate plus bound stays below the limit go
no further; the others are computed exactly, in double precision.

Candidates share the signs of some 16 rotated coordinates in one of 24 tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.functions.staging import Scratch, stage
from shelfwise.llm.components import connected_components
from shelfwise.llm.shipping import by_value
from shelfwise.llm.tables import numbered

by_value(__name__)

#: At cosine 0.98 two vectors share no table with chance 4e-5.
TABLES, KEY_BITS = 24, 16
#: Rows of a block; a bucket is compared block by block.
BLOCK = 512
#: Standard deviations of the estimate that the bound covers.
DEVIATIONS = 5.0


_ROTATIONS: dict[int, np.ndarray] = {}


def rotations(dim: int) -> np.ndarray:
    """Random orthogonal matrices side by side: one for the codes, then those of the tables."""
    if dim not in _ROTATIONS:
        random = np.random.default_rng(dim)
        count = 1 + math.ceil(TABLES * KEY_BITS / dim)
        _ROTATIONS[dim] = np.hstack([np.linalg.qr(random.standard_normal((dim, dim)))[0] for _ in range(count)])
    return _ROTATIONS[dim]


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table keys, sign codes and correction factors of vectors of one length."""
    dim = vectors.shape[1]
    turned = unit(vectors) @ rotations(dim)
    bits = turned[:, dim : dim + TABLES * KEY_BITS] > 0
    keys = bits.reshape(len(bits), TABLES, KEY_BITS) @ (1 << np.arange(KEY_BITS))
    factors = np.abs(turned[:, :dim]).sum(1) / math.sqrt(dim)
    return keys.astype(np.uint16), turned[:, :dim] > 0, factors


def usable(vector: Column) -> Column:
    """Not null, without null or non-finite components and not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def linked(vectors, codes, factors, keys, labels, sides, table: int, least: float) -> np.ndarray:
    """Which rows of a block link, each pair in the first table only that it shares."""
    dim = vectors.shape[1]
    units = unit(vectors)
    turned = (units @ rotations(dim)[:, :dim]).astype(np.float32)
    signs = np.where(codes, 1, -1).astype(np.float32)
    estimates = turned @ signs.T / (math.sqrt(dim) * factors)
    spread = np.sqrt(np.maximum(1 - factors**2, 0)) / factors / math.sqrt(max(dim - 1, 1))
    open_pairs = estimates + DEVIATIONS * spread >= least - 1e-3
    open_pairs &= labels[:, None] == labels[None, :]
    open_pairs &= keys[:, table][:, None] == keys[:, table][None, :]
    if sides is not None:
        open_pairs &= sides[:, None] != sides[None, :]
    np.fill_diagonal(open_pairs, False)
    open_pairs |= open_pairs.T
    if not open_pairs.any():
        return open_pairs
    for earlier in range(table):
        open_pairs &= keys[:, earlier][:, None] != keys[:, earlier][None, :]
    return open_pairs & (units @ units.T >= least)


def roots(links: np.ndarray) -> np.ndarray:
    """First row of each row's component within a block."""
    label = np.arange(len(links))
    while True:
        near = np.where(links, label[None, :], len(links)).min(1)
        new = np.minimum(label, near)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare_blocks(least: float):
    """Function over rows sorted by group: links of each row within its groups."""

    def scan(rows: pd.DataFrame) -> pd.DataFrame:
        out = []
        edges = np.flatnonzero((rows["group"].values[1:] != rows["group"].values[:-1])) + 1
        for part in np.split(np.arange(len(rows)), edges):
            if len(part) < 2:
                continue
            group = rows.iloc[part]
            dim = len(group["vector"].iloc[0])
            vectors = np.array(group["vector"].tolist(), float)
            codes = np.unpackbits(
                np.frombuffer(b"".join(group["code"]), np.uint8).reshape(len(group), -1), axis=1, count=dim
            )
            keys = np.frombuffer(b"".join(group["keys"]), np.uint16).reshape(len(group), -1)
            sides = None if group["alone"].iloc[0] else group["block"].values
            found = linked(
                vectors, codes, group["factor"].values, keys, group["label"].values, sides,
                int(group["table"].iloc[0]), least,
            )
            if found.any():
                ids, counts = group["rep"].values, found @ group["n"].values
                some = np.flatnonzero(counts)
                out.append(pd.DataFrame({"rep": ids[some], "root": ids[roots(found)[some]], "links": counts[some]}))
        return pd.concat(out) if out else pd.DataFrame({"rep": [], "root": [], "links": []}, dtype="int64")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for pdf in batches:
            rows = pdf if rest is None else pd.concat([rest, pdf], ignore_index=True)
            last = rows["group"].values == rows["group"].values[-1] if len(rows) else np.empty(0, bool)
            yield scan(rows[~last])
            rest = rows[last]
        if rest is not None:
            yield scan(rest)

    return compare


def near_vectors(
    vectors: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.98,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` of each vector.

    Vectors of one label whose cosine is at least ``least`` are linked; pairs of a
    table bucket are all tested, in blocks, and counted where they are tested, so
    no pair is ever a row. Equal vectors of a label are one node with a weight.
    Null labels, null, empty or zero vectors and those with null or non-finite
    components link with nothing, nor do vectors of different lengths.
    ``component_id`` is the smallest id reached, null ids aside; ``kept`` says that
    it is the row's own. Repeated ids are rows of their own. Empty in, empty out.
    """
    with Scratch(vectors.sparkSession) as scratch:
        return scratch.result(_near_vectors(vectors, vec_id, vector, label, least), "near")


def _near_vectors(vectors: DataFrame, vec_id: str, vector: str, label: str, least: float) -> DataFrame:
    rows = numbered(
        vectors.select(
            quoted(vec_id).alias("vec_id"),
            quoted(vector).cast("array<double>").alias("vector"),
            quoted(label).cast("string").alias("label"),
        ).withColumn("sound", usable(F.col("vector")) & F.col("label").isNotNull()),
        "vectors",
    )
    sound = rows.where("sound")
    classes = stage(
        sound.groupBy("label", "vector").agg(F.min("row").alias("rep"), F.count(F.lit(1)).alias("n")), "classes"
    )

    def code(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim, part in pdf.groupby(pdf["vector"].map(len)):
                keys, bits, factors = encode(np.array(part["vector"].tolist(), float))
                yield pd.DataFrame({
                    "rep": part["rep"], "n": part["n"], "label": part["label"], "dim": dim, "vector": part["vector"],
                    "keys": [k.tobytes() for k in keys],
                    "code": [c.tobytes() for c in np.packbits(bits, axis=1)],
                    "factor": factors,
                })

    coded = stage(
        classes.select("rep", "n", "label", "vector").mapInPandas(
            code,
            "rep bigint, n bigint, label string, dim int, vector array<double>, keys binary, code binary, factor double",
        ),
        "coded",
    )
    entries = coded.select(
        "rep", "label", "dim", "keys", F.explode(F.sequence(F.lit(0), F.lit(TABLES - 1))).alias("table")
    ).select(
        "rep", "table",
        F.xxhash64("label", "dim", "table", F.expr("substring(keys, 2 * table + 1, 2)")).alias("bucket"),
    )
    sizes = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    blocks = F.ceil(F.col("size") / BLOCK)
    members = (
        entries.join(sizes, "bucket")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("bucket", "rep"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select(
            "rep", "table", "block",
            (F.col("block") == F.col("other")).alias("alone"),
            F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("group"),
        )
    )
    found = stage(
        members.join(coded, "rep")
        .select("group", "rep", "table", "block", "alone", "n", "label", "vector", "keys", "code", "factor")
        .repartition("group")
        .sortWithinPartitions("group", "table")
        .mapInPandas(compare_blocks(least), "rep bigint, root bigint, links bigint"),
        "found",
    )
    components = connected_components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    nodes = (
        classes.join(counts, "rep", "left")
        .join(components.withColumnRenamed("node", "rep"), "rep", "left")
        .select(
            "label", "vector",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "rep").alias("component"),
        )
    )
    placed = stage(
        sound.join(nodes, ["label", "vector"]).select("vec_id", "links", "component").unionByName(
            rows.where("NOT sound").select(
                "vec_id", F.lit(0).cast("bigint").alias("links"), F.col("row").alias("component")
            )
        ),
        "placed",
    )
    firsts = placed.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    return placed.join(firsts, "component").select(
        "vec_id",
        F.col("links").cast("bigint").alias("n_links"),
        "component_id",
        F.col("vec_id").eqNullSafe(F.col("component_id")).alias("kept"),
    )
