"""Mixing sources to target weights with a low-discrepancy schedule.

Each source's documents are shuffled and laid end to end, once per epoch, and
the line of words is cut into blocks of equal size. Golden-ratio points mapped
through the cumulative targets say which source fills each slot of the mix; the
r-th slot of a source takes its r-th block.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.functions.columns import key_hash, quoted
from shelfwise.functions.ordering import running_totals
from shelfwise.functions.staging import Scratch, stage
from shelfwise.llm.tables import FILE, POSITION, WORD, filed, located, numbered

# Golden ratio as a fraction of 2^62, in two 31-bit halves: products of halves
# never overflow a long.
_HALF = 31
_STEP = int((math.sqrt(5) - 1) / 2 * (1 << 62)) | 1
_HIGH, _LOW = _STEP >> _HALF, _STEP & ((1 << _HALF) - 1)


class Mix(NamedTuple):
    documents: DataFrame  # row, place, doc_id, source, source_no, size, source_size, target
    sources: DataFrame  # source, source_no, weight, source_size, target, quota
    pieces: DataFrame  # slot, source_no, row, epoch, first_word, n_words, in slot order of the mix


def words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def mix(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: Sequence[int] = (3, 1, 2),
    share: float = 1.5,
    max_repeats: int = 2,
    block_words: int = 512,
    seed: int = 7,
) -> Mix:
    """Schedule ``share`` times the words of ``docs``, split over the sources by weight.

    Sources in code-point order, null last, get the weights in turn, repeating. A
    source takes at most ``max_repeats`` times its words; what it cannot take is
    shared again by weight. A source takes its target rounded to a whole word.
    No document is taken more than ``max_repeats`` times over.

    Null or empty texts have no words and no place in the mix. Rows are told
    apart by their place, so null and repeated ids and repeated rows each count.
    The order of a source depends on ids, epoch and seed alone (rows with the
    same id: on their place). An empty table gives an empty mix.
    """
    with Scratch(docs.sparkSession) as scratch:
        found = _mix(docs, doc_id, text, source, weights, share, max_repeats, block_words, seed)
        return Mix(*[scratch.result(df, name) for name, df in found._asdict().items()])


def _mix(docs, doc_id, text, source, weights, share, max_repeats, block_words, seed) -> Mix:
    placed, file, position = located(filed(docs))
    sized = numbered(
        placed.select(
            quoted(doc_id).alias("doc_id"),
            quoted(source).cast("string").alias("source"),
            words(quoted(text)).alias("size"),
            F.col(file).alias(FILE),
            F.col(position).alias(POSITION),
        ),
        "sized",
    )
    sources = source_targets(sized, weights, share, max_repeats)
    documents = sized.alias("d").join(
        sources.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source"))
    ).select("d.*", "source_no", "source_size", "target", "quota")
    slots = schedule(docs.sparkSession, sources, block_words)
    pieces = blocks(documents, block_words, seed).join(slots, ["source_no", "block"])
    return Mix(
        documents.drop("quota"),
        sources,
        pieces.select("slot", "source_no", "row", "epoch", "first_word", "n_words"),
    )


def source_targets(
    sized: DataFrame, weights: Sequence[int], share: float, max_repeats: int
) -> DataFrame:
    """One row per source with its weight, words, target and whole quota.

    Sources whose cap binds are those with the least cap per weight; the rest
    share what is left by weight. Running totals over that order give the point
    where caps stop to bind.
    """
    totals = stage(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    cycle = F.array(*[F.lit(int(w)).cast("bigint") for w in weights])
    placed = stage(
        running_totals(
            totals.withColumns({"unnamed": F.col("source").isNull().cast("int"), "one": F.lit(1).cast("bigint")}),
            [],
            ["unnamed", "source"],
            ["one"],
        )
        .withColumn("source_no", F.col("cum_one") - 1)
        .withColumn("weight", F.get(cycle, (F.col("source_no") % len(weights)).cast("int")))
        .withColumn("cap", F.col("source_size") * max_repeats)
        .withColumn("room", F.col("cap").cast("double") / F.col("weight"))
        .select("source", "source_no", "weight", "source_size", "cap", "room"),
        "sources",
    )
    whole = placed.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    if whole.words is None:
        return placed.select(
            "source", "source_no", "weight", "source_size",
            F.lit(0.0).alias("target"), F.lit(0).cast("bigint").alias("quota"),
        )
    wanted = share * whole.words
    ranked = stage(
        running_totals(placed, [], ["room", "source_no"], ["cap", "weight"]).select(
            *placed.columns,
            (F.lit(wanted) - (F.col("cum_cap") - F.col("cap"))).alias("left_words"),
            (F.lit(whole.weight) - (F.col("cum_weight") - F.col("weight"))).alias("left_weight"),
        ),
        "sources",
    )
    fits = F.col("left_words") * F.col("weight") / F.col("left_weight") <= F.col("cap")
    first = ranked.where(fits).agg(
        F.min(F.struct("room", "source_no", "left_words", "left_weight")).alias("f")
    ).first().f
    if first is None:
        target = F.col("cap").cast("double")
    else:
        free = F.struct("room", "source_no") >= F.struct(
            F.lit(first.room), F.lit(first.source_no).cast("bigint")
        )
        target = F.when(
            free, F.lit(first.left_words) * F.col("weight") / F.lit(first.left_weight)
        ).otherwise(F.col("cap").cast("double"))
    return stage(
        ranked.withColumn("target", target).select(
            "source", "source_no", "weight", "source_size", "target",
            F.round("target").cast("bigint").alias("quota"),
        ),
        "targets",
    )


def golden(slot: Column) -> Column:
    """``slot`` times the golden ratio, modulo 1, as a fraction of 2^62; exact."""
    mask = (1 << _HALF) - 1
    high, low = F.shiftright(slot, _HALF).bitwiseAND(mask), slot.bitwiseAND(mask)
    upper = (high * _LOW + low * _HIGH).bitwiseAND(mask)
    return (F.shiftleft(upper, _HALF) + low * _LOW).bitwiseAND((1 << 62) - 1)


def schedule(spark: SparkSession, sources: DataFrame, block_words: int) -> DataFrame:
    """``slot, source_no, block``: which block of which source fills each slot.

    Slots come from golden-ratio points. A source that has got all its blocks
    leaves its further slots empty; blocks that the points have not reached by
    then (a few per source) follow at the end.
    """
    needed = sources.withColumn("n_blocks", F.ceil(F.col("quota") / block_words)).where("n_blocks > 0")
    placed = stage(
        running_totals(needed.select("source_no", "n_blocks"), [], ["source_no"], ["n_blocks"]), "needed"
    )
    whole = placed.agg(F.sum("n_blocks").alias("n"), F.count(F.lit(1)).alias("sources")).first()
    n = whole.n or 0
    # Points and intervals meet by equality on a bin; there are at least as many
    # bins as sources, so a point meets few intervals.
    bits = max(6, (whole.sources or 1).bit_length())
    low = (F.col("cum_n_blocks") - F.col("n_blocks")) / F.lit(float(n or 1))
    high = F.col("cum_n_blocks") / F.lit(float(n or 1))
    bounds = placed.select("source_no", low.alias("low"), high.alias("high")).select(
        "*",
        F.explode(
            F.sequence(
                F.floor(F.col("low") * (1 << bits)), F.ceil(F.col("high") * (1 << bits)) - 1
            )
        ).alias("bin"),
    )
    points = spark.range(n).select(
        F.col("id").alias("slot"), golden(F.col("id")).alias("point")
    ).select(
        "slot",
        F.shiftright("point", 62 - bits).alias("bin"),
        (F.shiftright("point", 9) / F.lit(float(1 << 53))).alias("at"),
    )
    drawn = points.join(bounds, "bin").where("low <= at AND at < high").select(
        "source_no", "slot", F.lit(1).cast("bigint").alias("one")
    )
    ranked = stage(running_totals(drawn, ["source_no"], ["slot"], ["one"]), "slots")
    body = ranked.join(placed, "source_no").where("cum_one <= n_blocks").select(
        "slot", "source_no", (F.col("cum_one") - 1).alias("block")
    )
    got = ranked.groupBy("source_no").agg(F.count(F.lit(1)).alias("got"))
    tail = (
        placed.join(got, "source_no", "left")
        .withColumn("got", F.coalesce("got", F.lit(0)))
        .where("got < n_blocks")
        .select("source_no", F.explode(F.sequence("got", F.col("n_blocks") - 1)).alias("block"))
        .select((F.lit(n) + F.col("block")).alias("slot"), "source_no", "block")
    )
    return body.unionByName(tail)


def blocks(documents: DataFrame, block_words: int, seed: int) -> DataFrame:
    """Parts of documents by the block of their source that they lie in."""
    copies = documents.where("size > 0 AND quota > 0").select(
        "row", "doc_id", "source_no", "source_size", "quota", "size",
        F.explode(
            F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("quota") - 1) / F.col("source_size")))
        ).alias("epoch"),
    )
    ordered = copies.withColumn("key", key_hash(F.col("doc_id").cast("string"), F.col("epoch").cast("string"), seed=seed))
    laid = (
        running_totals(ordered, ["source_no", "epoch"], ["key", "row"], ["size"])
        .withColumn("end", F.col("epoch") * F.col("source_size") + F.col("cum_size"))
        .withColumn("start", F.col("end") - F.col("size"))
        .where("start < quota")
        .withColumn("stop", F.least("end", "quota"))
    )
    cut = laid.withColumn(
        "block",
        F.explode(F.sequence(F.floor(F.col("start") / block_words), F.floor((F.col("stop") - 1) / block_words))),
    )
    first = F.greatest("start", F.col("block") * block_words)
    last = F.least("stop", (F.col("block") + 1) * block_words)
    return cut.select(
        "source_no", "block", "row", "epoch",
        (first - F.col("start")).alias("first_word"), (last - first).alias("n_words"),
    )


def taken_words(result: Mix) -> DataFrame:
    """Documents with ``taken``, the words the mix takes of each, repeats counted."""
    taken = result.pieces.groupBy("row").agg(F.sum("n_words").alias("taken"))
    return result.documents.join(taken, "row", "left").withColumn(
        "taken", F.coalesce("taken", F.lit(0)).cast("bigint")
    )
