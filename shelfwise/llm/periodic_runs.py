"""Runs of periodic words, found with a dictionary of basic factors.

The factors of power-of-two length are named level by level: a factor of ``2m``
words is the pair of the names of its halves, and two factors are equal exactly if
their names are. At each level the successor of a factor is its next occurrence in
the document; successors within twice the length lie in arithmetic progressions,
whose step is proposed as a period. A proposal is extended to both sides by the
names, longest factors first, and equal results are one run.

A run of period ``q`` and at least three periods is always proposed: let ``m`` be
the least power of two that is not below ``q``. The factor of ``m`` words at the
run's start occurs again ``q`` words later, inside the run, and no sooner, since the
run's first ``q`` words are no power of a shorter sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from itertools import accumulate

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.llm.shipping import by_value
from shelfwise.llm.tables import WORD, fresh

by_value(__name__)

MIN_WORDS, MIN_PERIODS = 24, 3
#: Words of the documents that are named together; a longer document stands alone.
CHUNK_WORDS = 50_000


class Numbers(dict):
    """Consecutive number of each key asked for."""

    def __missing__(self, key):
        self[key] = value = len(self)
        return value


def factor_names(first: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per level: length of its factors, their names, and the positions of factors that
    occur again with their successors.

    Names of factors that occur once are negative and differ from all others, so they
    need no further care: a longer factor occurs twice only if both halves do.
    """
    n, length = len(first), 1
    at, key = np.arange(n), first.astype(np.int64)
    while len(at):
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        same = key[1:] == key[:-1]
        again = np.zeros(len(at), bool)
        again[1:] |= same
        again[:-1] |= same
        names = -1 - np.arange(n)
        number = np.cumsum(np.concatenate([[True], ~same]))
        names[at[again]] = number[again]
        yield length, names, at[:-1][same], at[1:][same]
        at = np.sort(at[again])
        at = at[at + length < n]
        at = at[names[at + length] >= 0]
        key = names[at] * (int(number[-1]) + 1) + names[at + length]
        length *= 2


def matching(levels: list[tuple[int, np.ndarray]], a: np.ndarray, b: np.ndarray, step: int) -> np.ndarray:
    """How many words agree from ``a`` and ``b`` on, ``a < b``, forwards (``step`` 1) or
    before them (``step`` -1)."""
    total = np.zeros(len(a), np.int64)
    for length, names in reversed(levels):
        if step > 0:
            x, y = a + total, b + total
            good = y < len(names)
        else:
            x, y = a - total - length, b - total - length
            good = x >= 0
        # Halves of a longer factor that was cut off by the end are tried again at their own level.
        good[good] = names[x[good]] == names[y[good]]
        total[good] += length
    return total


def runs_of(first: np.ndarray, min_words: int, min_periods: int) -> np.ndarray:
    """``start, length, period`` of the runs over word numbers, ordered by start and period."""
    levels, proposed = [], []
    for length, names, at, successor in factor_names(first):
        levels.append((length, names))
        step = successor - at
        near = step <= 2 * length
        at, step = at[near], step[near]
        order = np.lexsort((at, step))
        at, step = at[order], step[order]
        # Neighbouring positions with one step belong to one run: the first proposes it.
        head = np.ones(len(at), bool)
        head[1:] = (at[1:] != at[:-1] + 1) | (step[1:] != step[:-1])
        proposed.append(np.stack([at[head], step[head]]))
    if not proposed:
        return np.empty((0, 3), np.int64)
    at, period = np.unique(np.concatenate(proposed, axis=1), axis=1)
    before = matching(levels, at, at + period, -1)
    length = before + matching(levels, at, at + period, 1) + period
    found = np.stack([at - before, length, period], axis=1)
    found = found[(length >= min_words) & (length >= min_periods * period)]
    found = np.unique(found, axis=0)
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def document_runs(
    documents: list[list[bytes]], min_words: int = MIN_WORDS, min_periods: int = MIN_PERIODS
) -> list[np.ndarray]:
    """Runs of each of several documents, given as words, named in one go.

    A word counts as different in different documents, and a word that occurs nowhere
    else stands between them, so no run leaves its document.
    """
    if not documents:
        return []
    starts = np.array(list(accumulate((len(d) + 1 for d in documents), initial=0)), np.int64)
    numbers = Numbers()
    first = np.fromiter(
        (x for d in documents for x in (*map(numbers.__getitem__, d), -1)), np.int64, int(starts[-1])
    )
    document = np.repeat(np.arange(len(documents)), np.diff(starts))
    first = np.where(first < 0, -1 - np.arange(len(first)), document * len(numbers) + first)
    found = runs_of(first, min_words, min_periods)
    owner = np.searchsorted(starts, found[:, 0], side="right") - 1
    found[:, 0] -= starts[owner]
    return np.split(found, np.searchsorted(owner, np.arange(1, len(documents))))


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """Words without those that stand in a run after its first period."""
    if not len(runs):
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, runs[:, 0] + runs[:, 2], 1)
    np.add.at(edge, runs[:, 0] + runs[:, 1], -1)
    return [w for w, inside in zip(words, np.cumsum(edge[:-1]).tolist(), strict=True) if not inside]


def strongest(runs: np.ndarray) -> int:
    """Index of the run with the greatest exact length / period, the first of equal ones."""
    return min(
        range(len(runs)),
        key=lambda i: (-Fraction(int(runs[i, 1]), int(runs[i, 2])), runs[i, 0], runs[i, 2]),
        default=-1,
    )


def find_runs(
    docs: DataFrame,
    text: str = "text",
    runs: str = "runs",
    collapsed: str = "collapsed",
    best: str = "best",
    min_words: int = MIN_WORDS,
    min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """All columns of ``docs`` with the periodic runs of ``text`` and its collapsed form.

    ``runs`` is an array of ``start, length, period`` (word numbers from 0, words
    parted by ASCII white space), ordered by start and period: every maximal stretch
    with the smallest period ``period`` of at least ``min_words`` words and
    ``min_periods`` periods. ``best`` is the index (from 0) of the run with the
    greatest exact length / period, ties by start and period; null without runs.
    ``collapsed`` joins with one space the words that no run holds after its first
    period. Null and empty texts have no words, no runs and an empty collapsed text.

    Rows are independent: repeated rows and null ids do no harm, and an empty table
    gives none. A document is worked on whole, in memory that grows with its words
    times the logarithm of its longest repeat. Columns of ``docs`` that are called as
    an output, in any case, are replaced.
    """

    @F.pandas_udf(
        "starts array<bigint>, lengths array<bigint>, periods array<bigint>, best int, collapsed string"
    )
    def work(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows, chunk, size = [], [], 0

            def finish(documents: list[list[bytes]]) -> None:
                for words, found in zip(documents, document_runs(documents, min_words, min_periods), strict=True):
                    top = strongest(found)
                    rows.append((
                        *found.T.tolist(),
                        top if top >= 0 else None,
                        b" ".join(collapse(words, found)).decode("utf-8", "surrogatepass"),
                    ))

            for value in texts:
                words = value.encode("utf-8", "surrogatepass").split() if value else []
                if chunk and size + len(words) > CHUNK_WORDS:
                    finish(chunk)
                    chunk, size = [], 0
                chunk.append(words)
                size += len(words)
            finish(chunk)
            made = pd.DataFrame(rows, columns=["starts", "lengths", "periods", "best", "collapsed"])
            made["best"] = made["best"].astype("Int32")
            yield made

    name = fresh(docs.columns, "found")
    taken = {c.lower() for c in (runs, collapsed, best)}
    zipped = F.arrays_zip(
        F.col(f"{name}.starts").alias("start"), F.col(f"{name}.lengths").alias("length"), F.col(f"{name}.periods").alias("period")
    ).cast("array<struct<start:bigint,length:bigint,period:bigint>>")
    return docs.withColumn(name, work(quoted(text).cast("string"))).select(
        *[quoted(c) for c in docs.columns if c.lower() not in taken],
        zipped.alias(runs), F.col(f"{name}.best").alias(best), F.col(f"{name}.collapsed").alias(collapsed),
    )


def with_planted_runs(doc_id: Column, text: Column) -> Column:
    """Text of which, for one id in ten, the words from a place on repeat with a period.

    Place and period follow from the crc32 of the decimal id. A null id changes
    nothing; null counts as an empty text.
    """
    text = F.coalesce(text, F.lit(""))
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def changed(words: Column) -> Column:
        n = F.size(words).cast("bigint")
        a = g % n
        p = F.lit(1) + F.floor((n - a) / (F.lit(3) + g % 8))
        # Words before the place, and the repeated ones as often as they fit.
        block = F.slice(words, (a + 1).cast("int"), F.least(p, n - a).cast("int"))
        whole = F.flatten(F.array_repeat(block, F.ceil((n - a) / p).cast("int")))
        return F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(whole, F.lit(1), (n - a).cast("int")))

    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    repeated = F.get(F.transform(F.array(words), lambda w: F.array_join(F.when(F.size(w) > 0, changed(w)).otherwise(w), " ")), F.lit(0))
    return F.when(h % 10 == 0, repeated).otherwise(text)


def run_digests(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of the texts with planted ones, one row per document: ``doc_id, n_runs``, the
    strongest run's ``start, length, period, exponent_milli``, ``runs_sha256``,
    ``collapsed_sha256``."""
    planted = docs.select(quoted(doc_id).alias("doc_id"), with_planted_runs(quoted(doc_id), quoted(text)).alias("text"))
    found = find_runs(planted).withColumn("top", F.get("runs", F.col("best")))
    listed = F.array_join(
        F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n"
    )
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("top.start").alias("start"), F.col("top.length").alias("length"), F.col("top.period").alias("period"),
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
