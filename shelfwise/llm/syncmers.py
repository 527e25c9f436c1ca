"""Document fingerprints of closed syncmers.

A text is a row of tokens: its words, those of more than ``WHOLE`` bytes cut into
pieces of ``PIECE`` characters, or into single characters where a script is written
without spaces or the whole text has at most ``SHORT`` characters. Of the windows of
``K`` tokens those are anchors whose least inner group of ``S`` tokens, by hash, lies
at the window's start or end. Whether a window is an anchor depends on its own tokens
alone, so an edit changes the anchors that touch it and no others, and anchors of two
texts can be matched by their hashes together with their positions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.functions.staging import Scratch, stage
from shelfwise.llm.tables import FILE, POSITION, SPACE, filed, located

K, S = 6, 2
WHOLE, PIECE, SHORT = 16, 8, 64
_UNSPACED = "".join(rf"\p{{Is{s}}}" for s in ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar"))
_PIECES = rf"([{_UNSPACED}]|[^{_UNSPACED}]{{1,{PIECE}}})"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokens(text: Column) -> Column:
    """Tokens of a text in lower case."""
    words = F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), f"{SPACE}+"), "")
    # The test of the whole text stands outside the function of a word.
    return F.when(
        F.char_length(text) <= SHORT, F.flatten(F.transform(words, lambda w: F.split(w, "")))
    ).otherwise(F.flatten(F.transform(words, lambda w: F.when(F.octet_length(w) <= WHOLE, F.array(w)).otherwise(
        F.regexp_extract_all(w, F.lit(_PIECES), F.lit(1))
    ))))


def anchors(text: Column, k: int = K, s: int = S) -> Column:
    """Array of ``position, hash`` of the closed syncmers of a text, by token position.

    A text with tokens but without a syncmer has one anchor, at 0, made of all its
    tokens. Null texts and texts of white space have none.
    """
    inner = k - s + 1  # inner groups of a window
    none = F.array().cast("array<struct<position:int,hash:bigint>>")

    def groups(words: Column) -> Column:
        n = F.greatest(F.size(words) - (s - 1), F.lit(0))
        made = F.slice(words, F.lit(1), n)
        for j in range(1, s):
            made = F.zip_with(made, F.slice(words, F.lit(j + 1), n), lambda a, b: F.xxhash64(a, b))
        return made

    def chosen(h: Column) -> Column:
        def is_anchor(i: Column) -> Column:
            edge = F.least(F.get(h, i), F.get(h, i + (inner - 1)))
            between = [F.get(h, i + j) for j in range(1, inner - 1)]
            return edge <= F.least(*between) if len(between) > 1 else edge <= between[0]

        # Groups at these offsets cover the window.
        cover = sorted({*range(0, inner, s), inner - 1})
        starts = F.sequence(F.lit(0), F.size(h) - inner)
        return F.when(
            F.size(h) >= inner,
            F.transform(
                F.filter(starts, is_anchor),
                lambda i: F.struct(i.alias("position"), F.xxhash64(*[F.get(h, i + j) for j in cover]).alias("hash")),
            ),
        ).otherwise(none)

    def whole(words: Column) -> Column:
        one = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(words).alias("hash")))
        return let(
            let(groups(words), chosen),
            lambda found: F.when((F.size(found) > 0) | (F.size(words) == 0), found).otherwise(one),
        )

    return let(F.transform(tokens(text), lambda t: F.xxhash64(t)), whole)


def written(found: Column) -> Column:
    """Anchors as text: ``gap hash`` one after the other, the gap to the anchor before
    (from 0) in one digit or letter up to ``z`` for 35 and more, the hash in 8 hex digits.

    Syncmers are never further apart than ``K - S`` tokens, so the gaps give all positions."""
    before = F.concat(F.array(F.lit(0)), F.transform(found, lambda a: a["position"]))
    low = lambda a: F.substring(F.hex(a["hash"].bitwiseOR(F.lit(-(1 << 63)))), 9, 8)
    digit = lambda gap: F.lower(F.conv(F.least(gap, F.lit(35)).cast("string"), 10, 36))
    return F.array_join(
        F.zip_with(found, F.slice(before, F.lit(1), F.size(found)), lambda a, p: F.concat(digit(a["position"] - p), low(a))), ""
    )


def packed(found: Column) -> Column:
    """Anchors in few bytes: ``hashes``, the 32 bits that ``written`` shows, and ``positions``."""
    low = lambda a: (a["hash"].bitwiseAND(F.lit(0xFFFFFFFF)) - F.lit(1 << 31)).cast("int")
    return F.struct(
        F.transform(found, low).alias("hashes"), F.transform(found, lambda a: a["position"]).alias("positions")
    )


def marks_of(pack: Column) -> Column:
    """Struct of the distinct hashes of ``packed`` anchors (``free``) and of the hashes of
    each anchor with its position (``placed``)."""
    return F.struct(
        F.array_distinct(pack["hashes"]).alias("free"),
        F.zip_with(pack["hashes"], pack["positions"], lambda h, p: F.xxhash64(h, p)).alias("placed"),
    )


def marks(found: Column) -> Column:
    """``marks_of`` anchors."""
    return let(packed(found), marks_of)


def likeness(a: Column, b: Column) -> Column:
    """Shared part of the anchors of two texts, given as ``marks``: 0 to 1.

    The greater of two shares of all anchors: of those in the same place, which counts
    repeats, and of the distinct ones in any place, which bears insertions. 1 if neither
    text has an anchor."""

    def shared(x: Column, y: Column) -> Column:
        both = F.size(F.array_intersect(x, y))
        return both / F.greatest(F.size(x) + F.size(y) - both, F.lit(1))

    return F.when(F.size(a["free"]) + F.size(b["free"]) == 0, F.lit(1.0)).otherwise(
        F.greatest(shared(a["free"], b["free"]), shared(a["placed"], b["placed"]))
    )


def in_order(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """``file, position, doc_id, n_chars, rank`` of each row in ascending order of the
    id, and the number of rows. Texts stay where they are.

    Null ids come last; rows of one id are ordered by a hash of their text, then by place.
    """
    placed, file, position = located(docs)
    value = F.coalesce(quoted(text).cast("string"), F.lit(""))
    order = [F.col("doc_id").asc_nulls_last(), F.col("tie"), F.col(FILE), F.col(POSITION)]
    bits = 33  # layout of monotonically_increasing_id
    ordered = stage(
        placed.select(
            F.col(file).alias(FILE), F.col(position).alias(POSITION), quoted(doc_id).alias("doc_id"),
            F.char_length(value).alias("n_chars"), F.xxhash64(value).alias("tie"),
        )
        .repartitionByRange(*order).sortWithinPartitions(*order).drop("tie")
        .withColumn("at", F.monotonically_increasing_id()),
        "ordered",
    ).withColumn("piece", F.shiftright("at", bits)).withColumn("inside", F.col("at").bitwiseAND((1 << bits) - 1))
    pieces = ordered.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    ranked = stage(
        ordered.join(starts, "piece").select(FILE, POSITION, "doc_id", "n_chars", (F.col("start") + F.col("inside")).alias("rank")),
        "ranked",
    )
    return ranked, ranked.count()


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprint of each text and of its edited form, one row per document.

    The edited form has its last quarter of characters replaced by the first as many of
    the next document (or all of it), by ascending ``doc_id``, the first after the last.
    Returns ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
    near_edited, near_next``, the latter two being the ``likeness`` of the text to its
    edited form and to the next text.

    Null counts as an empty text, whose fingerprint is empty. Null ids are last; rows of
    one id follow each other by a hash of the text. A single row is its own next one. An
    empty table gives none. Other columns are not read.

    Texts are shuffled once. The join that tells each row how much the row before it
    wants also lays the texts out by place, so only the wanted heads and the anchors of
    the next document travel again. The result is larger than the texts' shuffle and is
    not stored here; the table of places it reads stays until ``drop_stages``.
    """
    docs = filed(docs)
    with Scratch(docs.sparkSession) as scratch:
        ranked, n = in_order(docs, doc_id, text)
        before = ranked.select(
            F.pmod(F.col("rank") + 1, F.lit(max(n, 1))).alias("rank"),
            F.col(FILE).alias("prev_file"), F.col(POSITION).alias("prev_position"),
            F.floor(F.col("n_chars") / 4).cast("int").alias("wanted"),
        )
        places = scratch.result(ranked.join(before.hint("merge"), "rank").drop("rank"), "places")
    placed, file, position = located(docs)
    # Sorted joins at every size: which table is small must not change the plan.
    rows = placed.select(
        F.col(file).alias(FILE), F.col(position).alias(POSITION),
        F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"),
    ).join(places.hint("merge"), [FILE, POSITION])
    heads = rows.select(
        F.col("prev_file").alias("to_file"), F.col("prev_position").alias("to_position"),
        F.substring("text", F.lit(1), F.col("wanted")).alias("head"),
        let(anchors(F.col("text")), packed).alias("next_anchors"),
    )
    joined = rows.join(
        heads.hint("merge"), (F.col(FILE) == F.col("to_file")) & (F.col(POSITION) == F.col("to_position"))
    )
    kept = F.substring("text", F.lit(1), F.col("n_chars") - F.floor(F.col("n_chars") / 4).cast("int"))
    found = joined.select(
        "doc_id", "n_chars", "next_anchors", anchors(F.col("text")).alias("own"), F.concat(kept, "head").alias("edited")
    ).select("doc_id", "n_chars", "next_anchors", "own", "edited", anchors(F.col("edited")).alias("other"))
    return found.select(
        "doc_id", F.col("n_chars").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        written(F.col("own")).alias("fingerprint"),
        written(F.col("other")).alias("edited_fingerprint"),
        let(marks(F.col("own")), lambda a: let(marks(F.col("other")), lambda b: likeness(a, b))).alias("near_edited"),
        let(marks(F.col("own")), lambda a: let(marks_of(F.col("next_anchors")), lambda b: likeness(a, b))).alias("near_next"),
    )
