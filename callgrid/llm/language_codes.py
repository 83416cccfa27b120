"""Language identification by error-correcting output codes (Dietterich and Bakiri, 1995).

Every language has a codeword. For each bit a binary classifier on hashed character n-grams tells languages with a 1 from those
with a 0: naive Bayes with equal weight for every language, so its weights follow from counts per language and n-gram that
Spark sums up over all labelled documents. A text gets the language whose codeword has the lowest loss against the
margins of the bits, each bit weighted by how well its classifier separates; close seconds are flagged.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .tables import small_batches
from .textbytes import U, mixed, pieces
from .tokens import release

BUCKET_BITS = 13
BUCKETS = 1 << BUCKET_BITS
ROWS_AT_ONCE = 256
# letters stay, A-Z lower-cased; other ASCII bytes are one kind of gap
FOLD = np.full(256, 32, np.uint32)
FOLD[97:123] = FOLD[65:91] = np.arange(97, 123)
FOLD[128:] = np.arange(128, 256)


def _trigrams(buf: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of all runs of three bytes within rows."""
    n = len(buf) - 2
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    b = FOLD[buf]
    gram = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    bucket = ((gram * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    inside = row[:-2] == row[2:]
    return row[:-2][inside], bucket[inside]


def codewords(languages: int) -> np.ndarray:
    """A row of -1 and 1 for each language. Up to six: all ways to part them; more: distinct pseudo-random columns."""
    if languages < 2:
        return np.ones((languages, 0))
    if languages <= 6:
        columns = np.arange(1, 1 << (languages - 1))
        bits = (columns[None, :] >> np.arange(languages - 1)[:, None]) & 1
        return np.vstack([np.zeros((1, len(columns)), np.int64), bits]) * 2.0 - 1
    wanted = 15 * (languages - 1).bit_length()
    found: dict[bytes, np.ndarray] = {}
    for k in range(64 * wanted):
        order = np.argsort(mixed(np.arange(languages, dtype=U) + U((k + 1) << 20)))
        column = np.where(order < languages // 2, -1.0, 1.0)
        column *= -column[0]
        found.setdefault(column.tobytes(), column)
        if len(found) == wanted:
            break
    return np.array(list(found.values())).T


@dataclass
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # n-gram buckets x bits
    strength: np.ndarray  # of bits
    sharpness: float = 40.0

    def decode(self, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(scores in 0 .. 1 per language, order of languages) from mean margins per n-gram."""
        z = self.codes[None, :, :] * (margins * self.sharpness)[:, None, :]
        loss = (np.logaddexp(0, -z) * self.strength).sum(axis=2)
        p = np.exp(loss.min(axis=1, keepdims=True) - loss)
        p /= p.sum(axis=1, keepdims=True)
        return p, np.argsort(-p, axis=1, kind="stable")


def held_out():
    """Whether a document is kept from training: crc32 of its doc_id as text is a multiple of 5 (null: no)."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_languages(docs: DataFrame, smoothing: float = 0.5) -> LanguageModel:
    """From all documents with a language that are not held out. The driver gets languages x 8192 counts."""

    def count(batches: Iterator[pa.RecordBatch]):
        release()
        totals: dict[str, np.ndarray] = {}
        for rows, buf, bounds in pieces(batches, "text"):
            row, bucket = _trigrams(buf, bounds)
            codes = rows.column("lang").dictionary_encode()
            names = codes.dictionary.to_pylist()
            of = codes.indices.to_numpy(zero_copy_only=False)[row]
            found = np.bincount(of * BUCKETS + bucket, minlength=len(names) * BUCKETS).reshape(-1, BUCKETS)
            for name, counts in zip(names, found, strict=True):
                totals[name] = totals.get(name, 0) + counts
        for name, counts in totals.items():
            at = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(counts[at])],
                names=["lang", "bucket", "n"],
            )

    known = docs.where(F.col("doc_id").isNotNull() & ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    found = known.select("lang", "text").mapInArrow(count, "lang string, bucket int, n long")
    with small_batches(docs.sparkSession):
        table = found.groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(table["lang"].unique())
    counts = np.zeros((len(languages), BUCKETS))
    counts[np.searchsorted(languages, table["lang"].to_numpy(str)) if len(languages) else [], table["bucket"]] = table["n"]
    codes = codewords(len(languages))
    share = (counts + smoothing) / (counts.sum(axis=1, keepdims=True) + smoothing * BUCKETS)
    one, zero = codes > 0, codes < 0
    p1 = (share.T @ one) / np.maximum(one.sum(axis=0), 1)
    p0 = (share.T @ zero) / np.maximum(zero.sum(axis=0), 1)
    weights = np.log(p1) - np.log(p0)
    strength = ((p1 - p0) * weights).sum(axis=0)
    strength *= len(strength) / max(strength.sum(), 1e-12)
    return LanguageModel(languages, codes, weights, strength)


def predict_languages(docs: DataFrame, model: LanguageModel, margin: float = 0.2) -> DataFrame:
    """The rows of `docs` (text and any other columns) with lang_pred, score, ambiguous.

    Null texts, texts without a letter, and all texts if nothing was learned, are `und` with score 0, ambiguous. Texts of
    fewer than three bytes give no n-gram: every language is as likely, the first by name is named. Nothing but the
    text is looked at. Given columns of those names are replaced. ambiguous: the second is less than `margin` behind.
    """
    made = ["lang_pred", "score", "ambiguous"]
    kept = [c for c in docs.columns if c not in made]
    others = [c for c in kept if c != "text"]
    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")
    row = F.struct(F.lit(0).alias("none"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)])
    packed = docs.select(row.alias("row"), F.col("text").cast("string").alias("text"), letters)

    def predict(batches: Iterator[pa.RecordBatch]):
        release()
        for rows, buf, bounds in pieces(batches, "text"):
            n = rows.num_rows
            names, score, close = ["und"] * n, np.zeros(n), np.ones(n, bool)
            there = rows.column("letters").to_numpy(zero_copy_only=False)
            for a in range(0, n if model.languages else 0, ROWS_AT_ONCE):
                b = min(n, a + ROWS_AT_ONCE)
                cut = bounds[a : b + 1]
                row, bucket = _trigrams(buf[cut[0] : cut[-1]], cut - cut[0])
                counts = np.bincount(row * BUCKETS + bucket, minlength=(b - a) * BUCKETS).reshape(-1, BUCKETS)
                margins = counts @ model.weights / np.maximum(counts.sum(axis=1, keepdims=True), 1)
                p, order = model.decode(margins)
                for i in np.flatnonzero(there[a:b]).tolist():
                    best = order[i, 0]
                    names[a + i], score[a + i] = model.languages[best], p[i, best]
                    close[a + i] = p.shape[1] > 1 and p[i, best] - p[i, order[i, 1]] < margin
            yield pa.RecordBatch.from_arrays(
                [rows.column("row"), rows.column("text"), pa.array(names), pa.array(score), pa.array(close)],
                names=["row", "text", *made],
            )

    schema = packed.select("row", "text").schema.add("lang_pred", "string").add("score", "double").add("ambiguous", "boolean")
    found = packed.mapInArrow(predict, schema)
    own = {c: F.col(f"row.c{i}") for i, c in enumerate(others)} | {"text": F.col("text")}
    return found.select(*[own[c].alias(c) for c in kept], *made)
