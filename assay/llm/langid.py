"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from assay.llm.common import bounded, id_class, prepare, records, spread_sample
from assay.session import stage

BUCKETS = 1 << 16
ORDERS = (2, 3)
SMOOTHING = 0.1
# Characters of labelled text to learn from. Beyond it, an even sample by a hash of the id.
TRAINING_CHARS = 20_000_000
# A model has one column of logarithms per language, 256 KB each.
MOST_MODEL_BYTES = 256 << 20
# Confidence stops growing with the text here: neighbouring n-grams are not independent.
EVIDENCE = 100
UNKNOWN = "und"

SPLIT, HELD_OUT = 4, 2
PIECE = 1 << 20  # characters handled at once
FACTORS = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)


@dataclass(frozen=True)
class Model:
    """``logs[b, k]``: log probability of bucket b in language k; ``priors[k]``: of language k."""

    languages: tuple[str, ...]
    logs: np.ndarray
    priors: np.ndarray


@lru_cache(1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def ngrams(chunk: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The bucket of each n-gram of the texts, and the number of its text, in any order.

    Letters are lower-cased, all else between them counts as one blank.
    """
    low = [t.lower() for t in chunk]
    lengths = np.fromiter(map(len, low), np.int64, len(low))
    codes = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    of_text = np.repeat(np.arange(len(low)), lengths)
    letter = _letters()[codes]
    first = np.ones(len(codes), bool)
    first[1:] = letter[:-1] | (of_text[1:] != of_text[:-1])
    kept = letter | first
    codes, of_text = np.where(letter, codes, 0).astype(np.uint32)[kept], of_text[kept]
    found, texts = [], []
    for n in ORDERS:
        if len(codes) < n:
            continue
        last = len(codes) - n + 1
        mixed = np.full(last, n, np.uint32)
        for i in range(n):
            mixed = (mixed + codes[i : i + last]) * np.uint32(FACTORS[i])
        inside = of_text[:last] == of_text[n - 1 :]
        found.append((mixed >> np.uint32(16))[inside])
        texts.append(of_text[:last][inside])
    if not found:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(texts)


def chunks(values: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    """Runs of texts of about ``PIECE`` characters with the number of the first. A longer text comes
    in several runs of its own; the one or two n-grams across each cut are left out."""
    start, run, size = 0, [], 0
    for i, value in enumerate(values):
        text = value or ""
        if run and size + len(text) > PIECE:
            yield start, run
            run, size = [], 0
        if len(text) > PIECE:
            for at in range(0, len(text), PIECE):
                yield i, [text[at : at + PIECE]]
            continue
        if not run:
            start = i
        run.append(text)
        size += len(text)
    if run:
        yield start, run


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text, lang) to (lang, bucket, n); bucket -1 counts documents."""
    counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + 1, np.int64))
    for batch in records(batches):
        values, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for lang in langs:
            counts[lang][-1] += 1
        for start, run in chunks(values):
            buckets, texts = ngrams(run)
            names = langs[start : start + len(run)]
            for lang in set(names):
                own = np.array([x == lang for x in names])
                counts[lang][:-1] += np.bincount(buckets[own[texts]], minlength=BUCKETS)
    for lang, array in counts.items():
        at = np.flatnonzero(array)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(at), pa.string()),
                pa.array(np.where(at == BUCKETS, -1, at), pa.int64()),
                pa.array(array[at]),
            ],
            ["lang", "bucket", "n"],
        )


def train(
    docs: DataFrame, text: str = "text", label: str = "lang", sample_key: str = "doc_id"
) -> Model:
    """Count the n-grams of the labelled rows, on Spark; the driver gets one number per language and
    bucket, after a check of their size. Rows without text or label are left out. No labelled row
    gives a model without languages."""
    prepare(docs.sparkSession)
    labelled = docs.select(
        F.col(text).alias("text"), F.col(label).alias("lang"), F.col(sample_key).alias("key")
    ).where("text is not null and lang is not null")
    labelled = spread_sample(labelled, F.col("key"), F.length("text"), TRAINING_CHARS)
    counted = labelled.select("text", "lang").mapInArrow(_count, "lang string, bucket long, n long")
    counted = stage(counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n")), "ngrams")
    languages = tuple(sorted(x.lang for x in counted.where("bucket = -1").select("lang").collect()))
    if len(languages) * BUCKETS * 4 > MOST_MODEL_BYTES:
        raise ValueError(f"{len(languages)} languages: more than the model may hold")
    place = {lang: k for k, lang in enumerate(languages)}
    counts = np.zeros((BUCKETS + 1, len(languages)))
    for row in bounded(counted, F.lit(32), 2 * MOST_MODEL_BYTES, "n-gram counts"):
        counts[row.bucket, place[row.lang]] = row.n
    grams, documents = counts[:-1], counts[-1]
    logs = np.log((grams + SMOOTHING) / (grams.sum(axis=0) + SMOOTHING * BUCKETS))
    priors = np.log(documents / max(1, documents.sum()))
    return Model(languages, logs.astype(np.float32), priors)


def score(model: Model, values: list[str | None]) -> tuple[list[str], np.ndarray]:
    """Language and confidence of each text."""
    count = len(values)
    sums, grams = np.zeros((count, len(model.languages))), np.zeros(count)
    has_letter = np.zeros(count, bool)
    for start, run in chunks(values):
        buckets, texts = ngrams(run)
        order = np.argsort(texts, kind="stable")
        buckets, texts = buckets[order], texts[order]
        for i, t in enumerate(run):
            has_letter[start + i] |= any(map(str.isalpha, t))
        if not len(texts):
            continue
        starts = np.flatnonzero(np.diff(texts, prepend=-1))
        at = start + texts[starts]
        sums[at] += np.add.reduceat(model.logs[buckets], starts, axis=0, dtype=np.float64)
        grams[at] += np.diff(np.append(starts, len(texts)))
    if not model.languages:
        return [UNKNOWN] * count, np.zeros(count)
    logits = sums * (np.minimum(grams, EVIDENCE) / np.maximum(grams, 1))[:, None] + model.priors
    logits -= logits.max(axis=1, keepdims=True)
    best, odds = logits.argmax(axis=1), np.exp(logits)
    sure = 1 / odds.sum(axis=1)
    names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, has_letter, strict=True)]
    return names, np.where(has_letter, sure, 0.0)


PREDICTION = StructType(
    [StructField("lang_pred", StringType()), StructField("score", DoubleType())]
)


def predicted(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column of structs ``(lang_pred, score)`` for a text column of ``docs``.

    Null, empty and letterless texts are ``und`` with score 0. The score is the posterior of the
    language, its evidence held at that of about 100 n-grams. Ties go to the first name.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(PREDICTION)
    def predict(column: pa.Array) -> pa.Array:
        names, sure = score(shared.value, column.to_pylist())
        return pa.StructArray.from_arrays(
            [pa.array(names, pa.string()), pa.array(sure, pa.float64())], ["lang_pred", "score"]
        )

    return predict(F.col(text))


def identify(docs: DataFrame) -> DataFrame:
    """Rows ``(doc_id, held_out, lang_pred, score)``, one per row of ``docs``; learned from the rows
    whose id class is not 2. Other columns are not read; a null id is in class 0."""
    held_out = id_class(F.col("doc_id"), SPLIT) == HELD_OUT
    model = train(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), predicted(docs, model).alias("p"))
    return found.select("doc_id", "held_out", "p.lang_pred", "p.score")


def keep_identified(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs``, all columns, with a known language and at least this confidence."""
    held_out = id_class(F.col("doc_id"), SPLIT) == HELD_OUT
    model = train(docs.where(~held_out))
    found = docs.select(F.struct(*docs.columns).alias("whole"), predicted(docs, model).alias("found"))
    sure = (F.col("found.lang_pred") != UNKNOWN) & (F.col("found.score") >= least)
    return found.where(sure).select("whole.*")
