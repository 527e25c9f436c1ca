"""Language identification with a string kernel.

A text is the set of its character n-grams of one to three characters, hashed
into a fixed number of bins. The kernel of two texts is the size of the
intersection over the root of the product of the sizes (a blended-spectrum
presence kernel). The classifier is one-versus-rest kernel ridge regression in
the Nyström space of landmark texts. As the kernel is linear in the presence
vectors, landmarks and regression fold into one matrix of bins x languages, and
a batch of documents is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.functions.columns import quoted
from shelfwise.llm.shipping import by_value
from shelfwise.llm.tables import FILE, POSITION, filed, located

by_value(__name__)

BINS = 1 << 15
ORDERS = (1, 2, 3)
UNKNOWN = "und"
_SLICE = 1 << 20  # characters hashed at a time
_ROWS = 64  # documents in one matrix product


def is_held_out(doc_id: Column) -> Column:
    """Documents never learnt from; a null id is not held out (and not learnt from)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def present_bins(text: str) -> np.ndarray:
    """Sorted distinct bins of the n-grams of a whole text, lower-cased."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    seen = np.zeros(BINS, bool)
    for start in range(0, len(codes), _SLICE):
        part = codes[start : start + _SLICE + max(ORDERS) - 1]
        gram = np.zeros(len(part), np.uint64)
        for n in ORDERS:
            if len(part) < n:
                break
            gram = gram[: len(part) - n + 1] * np.uint64(0x100000001B3) + part[n - 1 :] + np.uint64(1)
            mixed = (gram ^ (gram >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            seen[(mixed >> np.uint64(49)).astype(np.int64)] = True
    return np.flatnonzero(seen)


def _kernel(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Kernel of two tables of packed presence rows."""
    right = np.unpackbits(b, axis=1).astype(np.float32)
    right /= np.sqrt(np.maximum(right.sum(1), 1))[:, None]
    out = np.empty((len(a), len(b)))
    for i in range(0, len(a), 256):
        left = np.unpackbits(a[i : i + 256], axis=1).astype(np.float32)
        left /= np.sqrt(np.maximum(left.sum(1), 1))[:, None]
        out[i : i + 256] = left @ right.T
    return out


class Model(NamedTuple):
    languages: list[str]
    weights: np.ndarray  # bins x languages

    def scores(self, texts: list[str]) -> np.ndarray:
        """Regression value of each text and language."""
        batch = np.zeros((len(texts), BINS), np.float32)
        for i, text in enumerate(texts):
            bins = present_bins(text)
            batch[i, bins] = 1 / np.sqrt(max(len(bins), 1))
        return batch @ self.weights


def training_rows(
    docs: DataFrame, doc_id: str, text: str, lang: str, per_language: int, max_rows: int
) -> DataFrame:
    """``order, lang, bins`` (packed presence) of the bounded sample that the model is fitted on.

    Rows come in the order of a hash of their id: about ``per_language`` of each
    language, ``max_rows`` in all. Null and empty texts, which have no n-grams, are
    left out, and equal texts of a language are one row, before the sample is
    drawn. Hashes of the texts, languages and counts are read first, then only the
    texts of the sample.
    """
    placed, file, position = located(filed(docs))
    labelled = placed.select(
        quoted(lang).cast("string").alias("lang"),
        F.col(file).alias(FILE),
        F.col(position).alias(POSITION),
        (F.xxhash64(quoted(doc_id).cast("string"), F.col(position)) / float(1 << 64) + 0.5).alias("draw"),
        quoted(doc_id).isNotNull().alias("has_id"),
        is_held_out(quoted(doc_id)).alias("held_out"),
        (F.length(quoted(text).cast("string")) > 0).alias("has_text"),
        F.xxhash64(quoted(text).cast("string")).alias("text_hash"),
    ).where("lang IS NOT NULL AND has_id AND NOT held_out AND has_text")
    labelled = (
        labelled.groupBy("lang", "text_hash").agg(F.min(F.struct("draw", FILE, POSITION)).alias("first"))
        .select("lang", "first.*")
    )
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    chosen = (
        labelled.join(counts, "lang")
        .withColumn("order", F.col("draw") * F.col("n"))
        .where(F.col("order") <= per_language)
        .orderBy("order", FILE, POSITION)
        .limit(max_rows)
        .select(F.col(FILE).alias("f"), F.col(POSITION).alias("p"), F.col("order").alias("draw_order"))
    )
    # At most max_rows places: a bounded broadcast.
    sample = placed.join(
        F.broadcast(chosen), (F.col(file) == F.col("f")) & (F.col(position) == F.col("p"))
    ).select(F.col("draw_order").alias("order"), quoted(lang).cast("string").alias("lang"), quoted(text).cast("string").alias("text"))

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for value in pdf["text"].fillna(""):
                seen = np.zeros(BINS, bool)
                seen[present_bins(value)] = True
                rows.append(np.packbits(seen).tobytes())
            yield pd.DataFrame({"order": pdf["order"], "lang": pdf["lang"], "bins": rows})

    return sample.mapInPandas(pack, "order double, lang string, bins binary")


def fit(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    per_language: int = 600,
    max_rows: int = 4000,
    landmarks: int = 256,
    ridge: float = 1e-2,
) -> Model:
    """Fit on a sample of at most ``max_rows`` labelled rows (bounded: packed sets
    of 4 KB each come to the driver). Equal sets of a language are one row. Landmarks
    are the first rows of each language in the order of the draw, without a set
    that another language has given.
    """
    rows = training_rows(docs, doc_id, text, lang, per_language, max_rows).collect()
    rows.sort(key=lambda r: (r["order"], r["lang"], bytes(r["bins"])))
    rows = list({(r["lang"], bytes(r["bins"])): r for r in reversed(rows)}.values())[::-1]
    languages = sorted({r["lang"] for r in rows})
    if not rows:
        return Model([], np.zeros((BINS, 0), np.float32))
    packed = np.frombuffer(b"".join(bytes(r["bins"]) for r in rows), np.uint8).reshape(len(rows), -1)
    labels = np.array([r["lang"] for r in rows])
    target = (labels[:, None] == np.array(languages)[None, :]).astype(float)
    share = max(1, landmarks // len(languages))
    chosen, sets = [], set()
    for one in languages:
        new = [i for i in np.flatnonzero(labels == one) if bytes(rows[i]["bins"]) not in sets][:share]
        sets |= {bytes(rows[i]["bins"]) for i in new}
        chosen += new
    chosen = chosen[: max(landmarks, len(languages))]
    marks = packed[chosen]
    values, vectors = np.linalg.eigh(_kernel(marks, marks))
    good = values > 1e-6 * values.max()
    to_nystroem = vectors[:, good] / np.sqrt(values[good])
    features = _kernel(packed, marks) @ to_nystroem
    # Each language has the same weight in the regression.
    weight = (1 / target.sum(0))[np.argmax(target, 1)]
    weight /= weight.mean()
    gram = features.T @ (features * weight[:, None]) + ridge * len(rows) * 1e-2 * np.eye(features.shape[1])
    regression = to_nystroem @ np.linalg.solve(gram, features.T @ (target * weight[:, None]))
    marks_on = np.unpackbits(marks, axis=1).astype(np.float32)
    marks_on /= np.sqrt(np.maximum(marks_on.sum(1), 1))[:, None]
    return Model(languages, (marks_on.T @ regression).astype(np.float32))


def predict(docs: DataFrame, model: Model, text: str = "text", out: str = "language") -> DataFrame:
    """All columns of ``docs`` and ``out``, a struct of ``lang``, ``score`` and ``letters``.

    The score is the regression value of the language, clipped to 0..1. A text
    that is null, empty or without a letter is ``und`` with score 0, and so is
    every text if there was nothing to learn from; ``letters`` tells whether the
    text has a letter, whatever was learnt. Rows are independent.
    """
    spread = docs.sparkSession.sparkContext.broadcast((model.languages, model.weights))

    @F.pandas_udf("lang string, score double, letters boolean")
    def classify(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = Model(*spread.value)
        for texts in batches:
            letters = [bool(t) and any(map(str.isalpha, t)) for t in texts]
            values = [t if known.languages and good else None for t, good in zip(texts, letters, strict=True)]
            lang, score = [UNKNOWN] * len(values), np.zeros(len(values))
            real = [i for i, t in enumerate(values) if t is not None]
            for start in range(0, len(real), _ROWS):
                part = real[start : start + _ROWS]
                result = known.scores([values[i] for i in part])
                best = result.argmax(1)
                for i, b, row in zip(part, best, result, strict=True):
                    lang[i], score[i] = known.languages[b], float(np.clip(row[b], 0, 1))
            yield pd.DataFrame({"lang": lang, "score": score, "letters": letters})

    return docs.withColumn(out, classify(quoted(text).cast("string")))


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", **settings) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of each document, learnt from the
    labelled documents that are not held out."""
    model = fit(docs, doc_id, text, lang, **settings)
    rows = docs.select(quoted(doc_id).alias("doc_id"), quoted(text).alias("text"))
    return predict(rows, model).select(
        "doc_id",
        is_held_out(F.col("doc_id")).alias("held_out"),
        F.col("language.lang").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )
