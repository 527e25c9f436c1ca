"""Divergence of sources: how differently the sources of a language use its terms.

Terms are counted by 64-bit digests; the tables of counts hold no text. Each counting
task also writes the terms that it has met, once each. Their strings come back in two
places only: the least and the greatest string of each digest that may be kept show
whether several terms share it (those are then counted again by their text), and the
rows that are returned get theirs.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.functions.staging import Scratch, stage, stage_all
from shelfwise.llm.shipping import by_value

by_value(__name__)

#: Documents of a language that a kept term is in, what is added to every count, and the scale of shares.
MIN_DOCUMENTS, PRIOR, SCALE = 30, 5, 1_000_000_000
#: Ranks of the term part.
TOP_TERMS = 50
#: Terms, and uses of a term by a document, that a task holds before it hands on its
#: counts; cells of a block of shares.
HELD_TERMS, HELD_USES, BLOCK_CELLS = 400_000, 3_000_000, 1 << 16

#: Bytes of UTF-8 that belong to a term, A-Z in lower case; every other byte is a space.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def terms_of(text: str) -> list[bytes]:
    """Runs of letters A-Z, in lower case, and of characters outside ASCII."""
    return split_terms(text.encode("utf-8", "surrogatepass"))


def split_terms(text: bytes) -> list[bytes]:
    return text.translate(_LETTERS).split()


class Numbers(dict):
    """Terms numbered as they are met."""

    def __missing__(self, term: bytes) -> int:
        self[term] = number = len(self)
        return number


def digest(term: bytes) -> int:
    return xxhash.xxh3_64_intdigest(term) - (1 << 63)


def frame(n: list[int], digest: list[int], **columns) -> pd.DataFrame:
    """Rows of counts; a single text or null stands for a column of it."""
    rows = len(n)
    made = {"digest": np.array(digest, np.int64), "n": np.array(n, np.int64)}
    for name, values in columns.items():
        made[name] = values if isinstance(values, list) else [values] * rows
    return pd.DataFrame({c: pd.Series(v, dtype=None if isinstance(v, np.ndarray) else object) for c, v in made.items()})


def term_counts(docs: DataFrame, text: str, lang: str, source: str, digest: Callable[[bytes], int]) -> DataFrame:
    """Partial counts, several rows per term: of kind ``uses`` with ``n``, the occurrences
    in a source of a language, and of kind ``terms`` with ``n``, the documents of a
    language, and the term itself."""

    def totals(numbers: list[np.ndarray], times: list[np.ndarray] | None, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers met and the sum of their times (or of ones)."""
        numbers = np.concatenate(numbers)
        times = None if times is None else np.concatenate(times)
        met, at = None, numbers
        if len(numbers) < size // 8:
            met, at = np.unique(numbers, return_inverse=True)
        # Sums of whole numbers, far below 2^53.
        sums = np.bincount(at, times).astype(np.int64)
        if met is None:
            met = np.flatnonzero(sums)
            sums = sums[met]
        return met, sums

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, held = Numbers(), 0
        uses: dict[tuple[str, str], tuple[list, list]] = {}

        def rows() -> Iterator[pa.RecordBatch]:
            digests = np.fromiter(map(digest, known), np.int64, len(known))
            # Of bytes that are UTF-8, none was taken out of a character.
            terms = pa.array(known, pa.binary(), size=len(known)).cast(pa.string())
            documents: dict[str, list] = {}
            for (lang, source), (numbers, times) in uses.items():
                documents.setdefault(lang, []).extend(numbers)
                met, n = totals(numbers, times, len(known))
                yield batch("uses", lang, source, digests[met], pa.nulls(len(met), pa.string()), n)
            for lang, numbers in documents.items():
                met, n = totals(numbers, None, len(known))
                yield batch("terms", lang, None, digests[met], terms.take(pa.array(met)), n)
            known.clear()
            uses.clear()

        def batch(kind: str, lang: str, source: str | None, digests: np.ndarray, terms: pa.Array, n: np.ndarray):
            words = [pa.repeat(pa.scalar(v, pa.string()), len(n)) for v in (kind, lang, source)]
            columns = [*words, pa.array(digests), terms, pa.array(n)]
            return pa.RecordBatch.from_arrays(columns, ["kind", "lang", "source", "digest", "term", "n"])

        for documents in batches:
            for lang, source, text in zip(*[documents.column(c).to_pylist() for c in ("lang", "source", "text")], strict=True):
                found = Counter(split_terms(text))
                numbers, times = uses.setdefault((lang, source), ([], []))
                numbers.append(np.fromiter(map(known.__getitem__, found), np.int32, len(found)))
                times.append(np.fromiter(found.values(), np.int32, len(found)))
                held += len(found) + 32  # the arrays themselves
                if len(known) > HELD_TERMS or held > HELD_USES:
                    yield from rows()
                    held = 0
        yield from rows()

    return _filled(docs, lang, source, text).withColumn("text", F.col("text").cast("binary")).mapInArrow(
        count, "kind string, lang string, source string, digest bigint, term string, n bigint"
    )


_SPELLED = "lang string, source string, digest bigint, split string, n bigint, n_documents bigint"


def spelled_counts(digest: Callable[[bytes], int]):
    """Function over batches of documents: counts of each term by its text."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for (lang, source), part in pdf.groupby(["lang", "source"]):
                words, documents = Counter(), Counter()
                for text in part["text"]:
                    found = terms_of(text)
                    words.update(found)
                    documents.update(set(found))
                yield frame(
                    lang=lang, source=source, digest=[digest(t) for t in words],
                    split=[t.decode("utf-8", "surrogatepass") for t in words],
                    n=list(words.values()), n_documents=[documents[t] for t in words],
                )

    return count


def _filled(docs: DataFrame, *columns: str) -> DataFrame:
    names = ("lang", "source", "text")
    return docs.select(
        *[F.coalesce(quoted(c).cast("string"), F.lit("")).alias(n) for c, n in zip(columns, names, strict=False)]
    )


def share(count: Column, total: Column, terms: Column) -> Column:
    """``1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms))`` in exact arithmetic."""
    top = (count + PRIOR).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    bottom = (total + PRIOR * terms).cast("decimal(20,0)")
    return F.lit(1) + F.call_function("div", top, bottom)


def audit_sources(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    source: str = "source",
    min_documents: int = MIN_DOCUMENTS,
    top_terms: int = TOP_TERMS,
    digest: Callable[[bytes], int] = digest,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: what sets a source apart in its language.

    A language keeps the terms of at least ``min_documents`` of its documents. Shares of
    kept terms are smoothed; part ``pair`` has the total difference from each other
    source of the language, part ``term`` the terms used more than in the language as a
    whole, up to rank ``top_terms``. Ranks go by value, descending, then by item.

    Null texts, languages and sources count as empty strings, which are a language and a
    source like others; ids are not read, so repeated rows count each time. A language
    that keeps no term has pairs of value 0. An empty table gives no row. Terms of equal
    ``digest`` are told apart whatever the digest is.
    """
    with Scratch(docs.sparkSession) as scratch:
        return scratch.result(_audit(docs, text, lang, source, min_documents, top_terms, digest), "audit")


def _audit(docs, text, lang, source, min_documents, top_terms, digest) -> DataFrame:
    first = stage_all({
        "counts": term_counts(docs, text, lang, source, digest),
        "groups": _filled(docs, lang, source).distinct(),
    })
    groups = first["groups"]
    uses, terms = (first["counts"].where(F.col("kind") == kind) for kind in ("uses", "terms"))
    # A digest in too few documents holds no kept term, however many terms share it.
    likely = stage(
        terms.groupBy("lang", "digest").agg(F.sum("n").alias("n_documents"))
        .where(F.col("n_documents") >= min_documents).select("lang", "digest"),
        "likely",
    )
    spelled = stage(
        terms.groupBy("digest").agg(F.min("term").alias("least"), F.max("term").alias("most"))
        .join(likely.select("digest").distinct(), "digest"),
        "spelled",
    )
    shared = spelled.where("least <> most").select("digest")
    # ``split`` is the text of a term whose digest is shared, else empty.
    key = ["lang", "digest", "split"]
    entries = (
        # Both sides are dealt evenly by digest; the uses need no order to be summed.
        uses.select("lang", "source", "digest", "n").join(likely.hint("shuffle_hash"), ["lang", "digest"], "left_semi")
        .groupBy("lang", "digest", "source").agg(F.sum("n").alias("n"))
        .select("source", "lang", "digest", F.lit("").alias("split"), "n")
    )
    documents = terms.groupBy("lang", "digest", F.lit("").alias("split")).agg(F.sum("n").alias("n_documents"))
    if not shared.isEmpty():
        entries = entries.join(shared, "digest", "left_anti")
        documents = documents.join(shared, "digest", "left_anti")
        # Once more over the texts, for the terms of these digests only.
        again = stage(
            _filled(docs, lang, source, text).mapInPandas(spelled_counts(digest), _SPELLED)
            .join(shared, "digest", "left_semi"),
            "again",
        )
        entries = entries.unionByName(again.groupBy("source", *key).agg(F.sum("n").alias("n")))
        documents = documents.unionByName(again.groupBy(*key).agg(F.sum("n_documents").alias("n_documents")))
    entries = stage(entries, "entries")
    kept = stage(
        documents.where(F.col("n_documents") >= min_documents).select(*key)
        .join(entries.groupBy(*key).agg(F.sum("n").alias("lang_n")), key),
        "kept",
    )
    used = stage(entries.join(kept, key).select("source", *key, "n", "lang_n"), "used")

    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("n_terms"), F.sum("lang_n").alias("lang_total"))
    totals = used.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # One row per occurring group, with terms or without.
    sized = stage(
        groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
            "lang", "source", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "n_terms", "lang_total")]
        ),
        "sized",
    )
    shares = stage(
        used.join(sized, ["lang", "source"]).select(
            "source", *key,
            share(F.col("n"), F.col("total"), F.col("n_terms")).alias("p"),
            share(F.col("lang_n"), F.col("lang_total"), F.col("n_terms")).alias("q"),
        ),
        "shares",
    )
    return source_pairs(shares, sized).unionByName(leading_terms(shares, spelled, top_terms))


def leading_terms(shares: DataFrame, spelled: DataFrame, top_terms: int) -> DataFrame:
    """Part ``term``. Ranks by value alone choose the rows that get their text; all ties
    of the last rank are among them, so the text then settles the order."""
    group = Window.partitionBy("lang", "source")
    ahead = (
        shares.where("p > q").withColumn("value", F.col("p") - F.col("q"))
        .withColumn("place", F.rank().over(group.orderBy(F.col("value").desc())))
        .where(F.col("place") <= top_terms)
        .select("lang", "source", "digest", "split", "value")
    )
    item = F.when(F.col("split") == "", F.col("least")).otherwise(F.col("split"))
    return (
        ahead.join(spelled.select("digest", "least"), "digest")
        .select("lang", "source", F.lit("term").alias("part"), item.alias("item"), "value")
        .withColumn("rank", F.row_number().over(group.orderBy(F.col("value").desc(), "item")))
        .where(F.col("rank") <= top_terms)
    )


def source_pairs(shares: DataFrame, sized: DataFrame) -> DataFrame:
    """Part ``pair``: the differences are summed per block of terms, then over the blocks.

    A block has about ``BLOCK_CELLS`` cells, one per term and source of the language.
    Terms that a source does not use have that source's share for no occurrence.
    """
    langs = sized.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n_sources"), F.max("n_terms").alias("n_terms")
    ).withColumn("blocks", F.greatest(F.lit(1), F.ceil(F.col("n_terms") * F.col("n_sources") / BLOCK_CELLS)).cast("bigint"))
    in_lang = Window.partitionBy("lang").orderBy("source")
    numbered = stage(
        sized.join(langs.select("lang", "blocks"), "lang").select(
            "lang", "source", "n_terms", "blocks",
            (F.row_number().over(in_lang) - 1).alias("no"),
            F.when(F.col("n_terms") > 0, share(F.lit(0).cast("bigint"), F.col("total"), F.col("n_terms"))).alias("unused"),
        ),
        "numbered",
    )
    block = F.pmod(F.xxhash64("digest", "split"), F.col("blocks"))
    cells = shares.join(numbered.select("lang", "source", "no", "blocks"), ["lang", "source"]).select(
        "lang", block.alias("block"), "no", "digest", "split", "p"
    )
    every = numbered.where("n_terms > 0").select(
        "lang", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)).alias("block"), "no",
        F.lit(None).cast("bigint").alias("digest"), F.lit("").alias("split"), F.col("unused").alias("p"),
    )

    def differ(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        base = rows["digest"].isna().to_numpy()
        unused = rows[base].sort_values("no")["p"].to_numpy(np.int64)
        own = rows[~base]
        column = own.groupby(["digest", "split"], sort=False).ngroup().to_numpy()
        table = np.repeat(unused[:, None], column.max(initial=-1) + 1, axis=1)
        table[own["no"].to_numpy(), column] = own["p"].to_numpy(np.int64)
        found = [np.abs(table[i + 1 :] - table[i]).sum(1) for i in range(len(table))]
        a, b = np.triu_indices(len(table), 1)
        return pd.DataFrame({"lang": key[0], "a": a, "b": b, "value": np.concatenate(found) if found else []})

    sums = (
        cells.unionByName(every)
        .groupBy("lang", "block").applyInPandas(differ, "lang string, a int, b int, value bigint")
        .groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    )
    both = sums.select("lang", F.explode(F.array(
        F.struct(F.col("a").alias("no"), F.col("b").alias("other"), "value"),
        F.struct(F.col("b").alias("no"), F.col("a").alias("other"), "value"),
    )).alias("pair")).select("lang", "pair.*")
    # Languages without a kept term: every other source, at 0.
    names = numbered.select("lang", "source", "no")
    others = names.select("lang", F.col("source").alias("item"), F.col("no").alias("other"))
    bare = numbered.where("n_terms = 0").select("lang", "source", "no")
    pairs = (
        both.join(names, ["lang", "no"]).join(others, ["lang", "other"]).select("lang", "source", "item", "value")
    ).unionByName(
        bare.join(others, "lang").where(F.col("no") != F.col("other"))
        .select("lang", "source", "item", F.lit(0).cast("bigint").alias("value"))
    )
    group = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return pairs.select("lang", "source", F.lit("pair").alias("part"), "item", "value").withColumn(
        "rank", F.row_number().over(group)
    )
