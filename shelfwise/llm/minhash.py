"""Near-duplicate documents by b-bit MinHash.

A document is the set of its word shingles. Bands of minima give the candidate
buckets; of the minima themselves only the low two bits are kept, packed into
longs. The bits of two documents, counted where they agree and corrected for
chance agreement, estimate their similarity; pairs far below the limit go no
further, the others are confirmed on their full sets.

A group of near copies is not expanded into pairs: the members of a bucket are
compared with its first document, the links found are contracted, and only pairs
that are still in different components are compared with each other, block by
block, without a row per pair.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.functions.staging import Scratch, stage
from shelfwise.llm.blocks import block_groups, each_group
from shelfwise.llm.components import connected_components
from shelfwise.llm.shipping import by_value
from shelfwise.llm.tables import FILE, POSITION, filed, located, numbered

by_value(__name__)

#: 32 bands of 5 minima: a pair at 0.8 shares no band with chance 3e-6.
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
BITS = 2
_LANES = 64 // BITS
_WORDS = HASHES // _LANES
#: Members compared with one copy of a bucket's first document; rows of a block with
#: texts, and of one that is compared by bits only, ``SLICE`` rows of it at a time.
GROUP, BLOCK = 256, 512
WIDE_BLOCK, SLICE = 8_192, 256

_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(29)
_MEMO = 100_000


class WordHashes(dict):
    """Hash of each word; bounded."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= _MEMO:
            self.clear()
        self[word] = value
        return value


def shingle_set(text: str, k: int, memo: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the ``k``-word shingles of a whole text.

    A-Z count as lower case and words are parted by ASCII white space. A text of
    fewer words has one shingle, the sequence of all; one without words has none.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))
    k = min(k, len(hashes))
    n = len(hashes) - k + 1
    value = np.full(n, k, np.uint64)
    for j in range(k):
        value = (value ^ (value >> _SHIFT)) * _MIX + hashes[j : j + n]
    value = (value ^ (value >> _SHIFT)) * _MIX
    return np.unique(value ^ (value >> _SHIFT))


def _permutations() -> tuple[np.ndarray, np.ndarray]:
    draw = np.random.default_rng(20).integers(0, 1 << 63, (2, HASHES), dtype=np.uint64)
    return draw[0] * np.uint64(2) + np.uint64(1), draw[1]


def minima(shingles: np.ndarray, factors: np.ndarray, terms: np.ndarray) -> np.ndarray:
    """Least value of each hash function over the set, as 32-bit numbers."""
    least = np.full(HASHES, (1 << 32) - 1, np.uint64)
    for start in range(0, len(shingles), 512):
        part = shingles[start : start + 512, None] * factors + terms
        least = np.minimum(least, (part >> np.uint64(32)).min(0))
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    value = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        value = (value ^ (value >> _SHIFT)) * _MIX + column
    value = (value ^ (value >> _SHIFT)) * _MIX
    return (value ^ (value >> _SHIFT)).view(np.int64)


def low_bits(least: np.ndarray) -> np.ndarray:
    """Low bits of the minima, ``_LANES`` to a long."""
    lanes = (least & np.uint64((1 << BITS) - 1)).reshape(_WORDS, _LANES)
    return np.bitwise_or.reduce(lanes << (np.arange(_LANES, dtype=np.uint64) * np.uint64(BITS)), axis=1).view(np.int64)


def signatures(texts: DataFrame, k: int) -> DataFrame:
    """Place and id of each row with the size and digest of its set, bands and bits."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, (factors, terms) = WordHashes(), _permutations()
        for pdf in batches:
            rows = []
            for text in pdf["text"]:
                shingles = shingle_set(text, k, memo) if text else np.empty(0, np.uint64)
                if len(shingles):
                    least = minima(shingles, factors, terms)
                    digest = xxhash.xxh3_128_digest(shingles.tobytes())
                    rows.append((len(shingles), digest, band_keys(least), low_bits(least)))
                else:
                    rows.append((0, None, None, None))
            made = pd.DataFrame(rows, columns=["n_shingles", "digest", "bands", "bits"], index=pdf.index)
            yield pd.concat([pdf.drop(columns="text"), made], axis=1)

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInPandas(
        sign,
        f"doc_id {kind}, {FILE} string, {POSITION} bigint, "
        "n_shingles bigint, digest binary, bands array<bigint>, bits array<bigint>",
    )


def estimate(a: str, b: str) -> Column:
    """Similarity estimated from two columns of packed bits, corrected for the
    agreement that different minima show by chance."""
    differing = reduce(
        lambda x, y: x + y,
        [F.bit_count(_unequal(F.get(F.col(a), F.lit(i)).bitwiseXOR(F.get(F.col(b), F.lit(i))))) for i in range(_WORDS)],
    )
    chance = 2.0**-BITS
    return ((HASHES - differing) / float(HASHES) - chance) / (1 - chance)


def _unequal(x: Column) -> Column:
    """One bit per lane that is not zero."""
    low = int("01" * _LANES, 2)
    return x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(low))


def least_estimate(similarity: float, deviations: float = 5.0) -> float:
    """Estimates of pairs at ``similarity`` fall below this with a chance under 1e-6."""
    chance = 2.0**-BITS
    agree = similarity * (1 - chance) + chance
    return similarity - deviations * math.sqrt(agree * (1 - agree) / HASHES) / (1 - chance)


def confirm(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full sets reach the similarity.

    The text of ``b`` is sent once per ``GROUP`` of its partners and stands before
    them, so a task holds one set at a time besides the one it compares.
    """
    groups = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / GROUP).alias("groups"))
    partners = (
        pairs.join(groups, "b")
        .join(texts.withColumnsRenamed({"rep": "a"}), "a")
        .select("b", F.pmod(F.xxhash64("a"), F.col("groups")).alias("part"), F.lit(1).alias("later"), "a", "text")
    )
    firsts = groups.join(texts.withColumnsRenamed({"rep": "b"}), "b").select(
        "b",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("groups") - 1)).alias("part"),
        F.lit(0).alias("later"),
        F.col("b").alias("a"),
        "text",
    )

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo, first = WordHashes(), np.empty(0, np.uint64)
        for pdf in batches:
            found = []
            for b, later, a, text in zip(pdf["b"], pdf["later"], pdf["a"], pdf["text"], strict=True):
                own = shingle_set(text, k, memo)
                if not later:
                    first = own
                    continue
                both = len(np.intersect1d(first, own, assume_unique=True))
                if 100 * both >= percent * (len(first) + len(own) - both):
                    found.append((a, b))
            yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return (
        partners.unionByName(firsts)
        .repartition("b", "part")
        .sortWithinPartitions("b", "part", "later")
        .mapInPandas(compare, "a bigint, b bigint")
    )


def component_links(reps: DataFrame, docs: DataFrame, text: str, k: int, percent: int) -> DataFrame:
    """``node, component`` of the representatives that have a link."""
    rows = reps.select("rep", F.explode("bands").alias("key"))
    buckets = rows.groupBy("key").agg(F.min("rep").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = stage(rows.join(buckets, "key").select("key", "rep", "first", "n"), "members")
    bits = reps.select("rep", "bits")
    limit = least_estimate(percent / 100)

    # The first document of each bucket against the others.
    star = stage(
        members.where("rep <> first").select("rep", "first").distinct()
        .join(bits.withColumnRenamed("bits", "own"), "rep")
        .join(bits.withColumnsRenamed({"rep": "first", "bits": "other"}), "first")
        .withColumn("estimate", estimate("own", "other"))
        .where(F.col("estimate") >= limit)
        .select(F.col("rep").alias("a"), F.col("first").alias("b"), "estimate"),
        "star",
    )
    placed, file, position = located(docs)
    wanted = members.select("rep").distinct().join(reps, "rep").select(
        "rep", F.col(FILE).alias("f"), F.col(POSITION).alias("p")
    )
    texts = stage(
        placed.select(F.col(file).alias("f"), F.col(position).alias("p"), quoted(text).cast("string").alias("text"))
        .join(wanted, ["f", "p"])
        .select("rep", "text"),
        "texts",
    )

    best = star.groupBy("a").agg(F.max(F.struct("estimate", (-F.col("b")).alias("minus"))).alias("best")).select(
        "a", (-F.col("best.minus")).alias("b")
    )
    links = stage(confirm(best, texts, k, percent), "links")
    found = connected_components(links)

    rest = _apart(star.join(best, ["a", "b"], "left_anti").select("a", "b"), found)
    links = links.unionByName(stage(confirm(rest, texts, k, percent), "links"))
    found = stage(connected_components(links), "found")

    # All other pairs of a bucket that are still apart, block by block: first which
    # rows have a partner by their bits, then the texts of those.
    placed_members = stage(
        members.where("n > 2").join(found.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")),
        "placed",
    )
    mixed = placed_members.groupBy("key").agg(
        F.min("component").alias("low"), F.max("component").alias("high")
    ).where("low <> high")
    open_rows = placed_members.join(mixed, "key").where("rep <> first").select("key", "rep", "component")
    marks = reps.select("rep", "n_shingles", "bits", "bands")
    by_bits = stage(
        block_groups(open_rows, "key", "rep", WIDE_BLOCK).join(marks, "rep")
        .repartition("group").sortWithinPartitions("group")
        .mapInPandas(partners(limit, percent), f"{', '.join(f'{c} bigint' for c in _OPEN)}, bits array<bigint>, bands array<bigint>"),
        "by-bits",
    ).dropDuplicates(["key", "rep"])
    more = stage(
        block_groups(by_bits, "key", "rep", BLOCK).join(texts, "rep")
        .repartition("group").sortWithinPartitions("group")
        .mapInPandas(block_links(limit, k, percent), "a bigint, b bigint"),
        "links",
    )
    return connected_components(links.unionByName(more))


#: Numbers that come out of the comparison by bits with each row, besides its marks.
_OPEN = ["key", "rep", "component", "n_shingles"]


def open_pairs(rows: pd.DataFrame, limit: float, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """Which rows of a block may link: apart, in their first common band, of sizes that
    allow the similarity, and similar by bits. Gives the first row of each slice and the
    slice's rows against all."""
    size = rows["n_shingles"].values
    component, bands = rows["component"].values, np.stack(rows["bands"].to_numpy())
    bits = np.stack(rows["bits"].to_numpy()).view(np.uint64)
    alone, block = rows["alone"].iloc[0], rows["block"].values
    band = int(np.flatnonzero(bands[0] == rows["key"].iloc[0])[0])
    chance = 2.0**-BITS
    for start in range(0, len(rows), SLICE):
        own = slice(start, start + SLICE)
        differ = np.zeros((len(bits[own]), len(rows)), np.uint8)
        for word in bits.T:
            x = word[own, None] ^ word[None, :]
            differ += np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(int("01" * _LANES, 2)))
        pairs = ((HASHES - differ.astype(np.int64)) / HASHES - chance) / (1 - chance) >= limit
        pairs &= component[own, None] != component[None, :]
        # The smaller set bounds the intersection, the larger one the union.
        pairs &= 100 * np.minimum.outer(size[own], size) >= percent * np.maximum.outer(size[own], size)
        if not alone:
            pairs &= block[own, None] != block[None, :]
        if pairs.any():
            for earlier in bands[:, :band].T:
                pairs &= earlier[own, None] != earlier[None, :]
        yield start, pairs


def partners(limit: float, percent: int):
    """Function over blocks: the rows that have a partner, with their marks."""
    columns = [*_OPEN, "bits", "bands"]

    def work(rows: pd.DataFrame) -> pd.DataFrame | None:
        some = np.concatenate([pairs.any(1) for _, pairs in open_pairs(rows, limit, percent)])
        return rows.loc[some, columns] if some.any() else None

    return lambda batches: (found for found in each_group(batches, work, columns) if len(found))


def block_links(limit: float, k: int, percent: int):
    """Function over blocks with texts: links confirmed on full sets, no more than
    it takes to connect what is connected within the block."""
    memo = WordHashes()

    def work(rows: pd.DataFrame) -> pd.DataFrame | None:
        ids, found = rows["rep"].values, []
        parent = {c: c for c in rows["component"].values.tolist()}

        def root(c: int) -> int:
            while parent[c] != c:
                parent[c] = parent[parent[c]]
                c = parent[c]
            return c

        sets = [shingle_set(text, k, memo) for text in rows["text"]]
        component = rows["component"].values.tolist()
        wanted = (
            (start + i, j)
            for start, pairs in open_pairs(rows, limit, percent)
            for i, j in np.argwhere(np.triu(pairs, start + 1)).tolist()
        )
        for i, j in wanted:
            x, y = root(component[i]), root(component[j])
            a, b = sets[i], sets[j]
            # The smaller set bounds the intersection, the larger one the union.
            if x == y or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                continue
            both = len(np.intersect1d(a, b, assume_unique=True))
            if 100 * both >= percent * (len(a) + len(b) - both):
                parent[x] = y
                found.append((ids[i], ids[j]))
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64") if found else None

    return lambda batches: each_group(batches, work, ["a", "b"])


def _apart(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs whose ends are not yet in one component."""
    return (
        pairs.join(found.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a", "left")
        .join(found.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b", "left")
        .where(F.coalesce("ca", "a") != F.coalesce("cb", "b"))
        .select("a", "b")
    )


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle_words: int = 5,
    percent: int = 80,
) -> DataFrame:
    """One row per document: its place, ``doc_id, n_shingles, component_id, kept, stays``.

    Documents are linked when the intersection of their shingle sets is at least
    ``percent`` of the union. ``component_id`` is the smallest id that links reach,
    ``kept`` says that it is the document's own. Null and empty texts and texts
    without words have no shingles and no links. Null ids take part but are never
    the smallest if another is there. ``stays`` marks one row per component, also
    where ids repeat. An empty table gives none.
    """
    with Scratch(docs.sparkSession) as scratch:
        return scratch.result(_near_duplicates(docs, doc_id, text, shingle_words, percent), "near")


def _near_duplicates(docs: DataFrame, doc_id: str, text: str, shingle_words: int, percent: int) -> DataFrame:
    docs = filed(docs)
    placed, file, position = located(docs)
    texts = placed.select(
        quoted(doc_id).alias("doc_id"), F.col(file).alias(FILE), F.col(position).alias(POSITION),
        quoted(text).cast("string").alias("text"),
    )
    signed = numbered(signatures(texts, shingle_words), "signatures")
    # Documents with the same set are one node from here on.
    classes = stage(
        signed.where("n_shingles > 0").groupBy("digest").agg(F.min("row").alias("rep")), "classes"
    )
    reps = stage(
        signed.join(classes.select("rep"), F.col("row") == F.col("rep")).select(
            "rep", FILE, POSITION, "n_shingles", "bands", "bits"
        ),
        "reps",
    )
    found = component_links(reps, docs, text, shingle_words, percent)
    nodes = classes.join(found, F.col("rep") == F.col("node"), "left").select(
        "digest", F.coalesce("component", "rep").alias("component")
    )
    rows = stage(
        signed.select("row", "doc_id", FILE, POSITION, "n_shingles", "digest")
        .join(nodes, "digest", "left")
        .withColumn("component", F.coalesce("component", "row")),
        "placed",
    )
    firsts = rows.groupBy("component").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("first")
    )
    return rows.join(firsts, "component").select(
        FILE, POSITION, "doc_id", "n_shingles",
        F.col("first.doc_id").alias("component_id"),
        F.col("doc_id").eqNullSafe(F.col("first.doc_id")).alias("kept"),
        (F.col("row") == F.col("first.row")).alias("stays"),
    )
