"""Line deduplication with a fixed-depth log-template tree.

A line goes to a leaf by its number of tokens and its leading tokens; tokens with
a digit are variable from the start. A leaf has any number of templates: each
line as it is, and each line with one field, a window of tokens after the leading
ones, made variable. A template recurs if enough documents hold it, whatever
other lines its leaf has, so that what recurs in a corpus recurs in a larger one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.functions.staging import Scratch, stage
from shelfwise.llm.tables import FILE, POSITION, filed, fresh, located

VARIABLE = "<*>"
#: Leading tokens that choose the leaf.
DEPTH = 3
#: Documents from which on a template recurs, and tokens from which on a line
#: recurs in any second document.
MIN_DOCUMENTS, LONG = 8, 50
#: Part of the tokens after the leading ones that the field takes; tokens with a digit
#: may be as many again, so that at least half of these tokens are constant.
PART = 4


def prepared(text: Column) -> Column:
    """Whole text with one space between the tokens of a line and with tokens that
    hold a digit as ``<*>``.

    Both are done once per text, not per line. The look-behind and the possessive
    repeats visit each character once, however long a token is.
    """
    even = F.regexp_replace(text, r"[\x20\x09\x0B-\x0D]{2,}|[\x09\x0B-\x0D]", " ")
    return F.when(
        text.rlike("[0-9]"), F.regexp_replace(even, r"(?<![^ \n])[^ \n0-9]*+[0-9][^ \n]*+", VARIABLE)
    ).otherwise(even)


def lines_of(docs: DataFrame, text: str) -> DataFrame:
    """``doc, file, position, line_no, tokens, masked`` of the lines with a constant token."""
    placed, file, position = located(docs)
    # Numbered before the lines are parted: one number per document.
    numbered = placed.select(
        F.monotonically_increasing_id().alias("doc"), F.col(file).alias(FILE), F.col(position).alias(POSITION),
        prepared(quoted(text).cast("string")).alias("text"),
    )
    lines = numbered.select("doc", FILE, POSITION, F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    # Spaces between tokens; those at the ends of a line are at most one each.
    masked = F.btrim(F.col("line"), F.lit(" "))
    spaces = F.char_length(masked) - F.char_length(F.replace(masked, F.lit(" ")))
    constant = F.replace(F.replace(masked, F.lit(VARIABLE)), F.lit(" "))
    return lines.where(constant != "").select(
        "doc", FILE, POSITION, "line_no", (spaces + 1).alias("tokens"), masked.alias("masked")
    )


def leaf() -> Column:
    return F.xxhash64("tokens", F.substring_index("masked", " ", DEPTH))


def field_starts() -> Column:
    """Numbers of the tokens at which a field of a line starts: half a field apart, and
    the last one; none where the line is short or holds many tokens with digits."""
    width = F.expr(f"(tokens - {DEPTH}) div {PART}").cast("int")
    digits = F.expr(f"(char_length(masked) - char_length(replace(masked, '{VARIABLE}'))) div {len(VARIABLE)}")
    last = F.col("tokens") - width
    starts = F.array_union(
        F.sequence(F.lit(DEPTH), last, F.expr(f"((tokens - {DEPTH}) div {PART} + 1) div 2").cast("int")), F.array(last)
    )
    return F.when((width >= 1) & (digits <= width), starts).otherwise(F.array().cast("array<int>"))


def field_width() -> Column:
    return F.expr(f"(tokens - {DEPTH}) div {PART}").cast("int")


def before(start: Column) -> Column:
    return F.call_function("substring_index", F.col("masked"), F.lit(" "), start)


def behind(start: Column) -> Column:
    return F.call_function("substring_index", F.col("masked"), F.lit(" "), start + field_width() - F.col("tokens"))


def keyed_lines(lines: DataFrame) -> DataFrame:
    """``lines`` with ``leaf`` and ``keys``: the digests of the line's templates, that of
    the line itself first."""
    fields = F.transform(field_starts(), lambda s: F.xxhash64(s, before(s), behind(s)))
    return lines.withColumns({"leaf": leaf(), "keys": F.concat(F.array(F.xxhash64("masked")), fields)})


def recurring_lines(docs: DataFrame, text: str = "text", min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Places ``file, position, line_no`` of the lines to drop, each once per template."""
    with Scratch(docs.sparkSession) as scratch:
        keyed, counts = _recurring(filed(docs), text, min_documents)
        return scratch.result(_gone(keyed, counts, min_documents), "places")


def recurring_templates(docs: DataFrame, text: str = "text", min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Templates that recur: ``template, n_documents``, the field as one ``<*>``.

    The text is taken from one line of each template; the texts are read again for it.
    """
    with Scratch(docs.sparkSession) as scratch:
        docs = filed(docs)
        keyed, counts = _recurring(docs, text, min_documents)
        one = (
            keyed.join(counts, ["leaf", "key", "at_field"])
            .groupBy("leaf", "key", "at_field", "n_documents")
            .agg(F.min(F.struct(FILE, POSITION, "line_no")).alias("place"))
            .select("key", "at_field", "n_documents", f"place.{FILE}", f"place.{POSITION}", "place.line_no")
        )
        lines = lines_of(docs, text).drop("doc").join(one, [FILE, POSITION, "line_no"])
        fields = F.transform(
            field_starts(),
            lambda s: F.struct(
                F.xxhash64(s, before(s), behind(s)).alias("key"),
                F.btrim(F.concat_ws(" ", before(s), F.lit(VARIABLE), behind(s)), F.lit(" ")).alias("template"),
            ),
        )
        own = F.filter(fields, lambda f: f["key"] == F.col("key"))[0]["template"]
        return scratch.result(
            lines.select(F.when(F.col("at_field"), own).otherwise(F.col("masked")).alias("template"), "n_documents"),
            "templates",
        )


def _recurring(docs: DataFrame, text: str, min_documents: int) -> tuple[DataFrame, DataFrame]:
    """Lines of leaves that may hold a recurring template, one row per template, and the
    numbers of documents of the templates that recur."""
    # Parsed once; from here on digests travel, never lines.
    lines = stage(
        keyed_lines(lines_of(docs, text)).select(
            "doc", FILE, POSITION, "line_no", (F.col("tokens") >= LONG).alias("is_long"), "leaf", "keys"
        ),
        "lines",
    )
    enough = F.when(F.col("is_long"), F.least(F.lit(2), F.lit(min_documents))).otherwise(F.lit(min_documents))
    leaves = (
        lines.select("leaf", "is_long", "doc").distinct()
        .groupBy("leaf", "is_long").agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= enough)
        .select("leaf")
    )
    # Leaves grow with the corpus, so the join is a sorted one at every size.
    hot = stage(lines.join(leaves.hint("shuffle_merge"), "leaf"), "hot")
    keyed = hot.select(
        "doc", FILE, POSITION, "line_no", "is_long", "leaf", F.posexplode("keys").alias("at", "key")
    ).withColumn("at_field", F.col("at") > 0).drop("at")
    wanted = F.when(F.col("at_field"), F.lit(min_documents)).otherwise(enough)
    counts = stage(
        keyed.select("leaf", "key", "at_field", "is_long", "doc").distinct()
        .groupBy("leaf", "key", "at_field", "is_long").agg(F.count(F.lit(1)).alias("n_documents"))
        .where(F.col("n_documents") >= wanted)
        .drop("is_long"),
        "counts",
    )
    return keyed, counts


def _gone(keyed: DataFrame, counts: DataFrame, min_documents: int) -> DataFrame:
    place = [FILE, POSITION, "line_no"]
    found = stage(keyed.join(counts, ["leaf", "key", "at_field"]).select("leaf", "key", *place, "n_documents"), "found")
    few = F.col("n_documents") < min_documents
    # Fewer than min_documents rows of documents each.
    first = found.where(few).groupBy("leaf", "key").agg(F.min(F.struct(FILE, POSITION)).alias("first"))
    later = found.where(few).join(first, ["leaf", "key"]).where(F.struct(FILE, POSITION) != F.col("first"))
    return found.where(~few).select(place).unionByName(later.select(place))


def drop_recurring_lines(
    docs: DataFrame, text: str = "text", min_documents: int = MIN_DOCUMENTS, dropped: str = "dropped_lines"
) -> DataFrame:
    """All columns of ``docs``, ``text`` without the lines of recurring templates, and
    ``dropped``, the numbers (from 0) of the lines that went.

    Lines are parted by ``\\n``; lines of fewer than three tokens always stay. A
    template recurs if lines of at least ``min_documents`` rows have it; repeated
    lines of a row count once. Null texts stay null and empty texts empty; a text
    whose lines all go becomes empty. Rows are told apart by their place, so null
    and repeated ids do no harm. ``dropped`` replaces a column of that name, in any case;
    all other columns are kept, whatever they are called.
    """
    docs = filed(docs)
    places = recurring_lines(docs, text, min_documents)
    name = fresh([*docs.columns, dropped], "gone")
    gone = places.groupBy(FILE, POSITION).agg(F.sort_array(F.collect_set("line_no")).alias(name))
    placed, file, position = located(docs)
    f, p = fresh(placed.columns, "gone_file"), fresh(placed.columns, "gone_position")
    joined = placed.join(
        gone.withColumnsRenamed({FILE: f, POSITION: p}),
        (F.col(file) == F.col(f)) & (F.col(position) == F.col(p)),
        "left",
    )
    kept = F.array_join(
        F.filter(F.split(quoted(text), "\n"), lambda line, i: ~F.array_contains(name, i)), "\n"
    )
    out = F.when(F.col(name).isNull(), quoted(text)).otherwise(kept)
    return joined.select(
        *[out.alias(c) if c == text else quoted(c) for c in docs.columns if c.lower() != dropped.lower()],
        F.coalesce(F.col(name), F.array().cast("array<int>")).alias(dropped),
    )
