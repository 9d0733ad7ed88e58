"""Quality classifier: a factorisation machine over hashed words, structure and metadata.

    score(x) = sigmoid( b + sum w_i x_i + 1/2 sum_f [ (sum v_if x_i)^2 - sum v_if^2 x_i^2 ] )

The bracket is the sum-of-squares identity: all pairwise interactions in time linear in the features.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from assay.llm.common import id_class, prepare, records, spread_sample, texts
from assay.session import stage

WORD_BUCKETS = 1 << 15
RANK = 8
EPOCHS = 12
STEP = 0.05
DECAY = 1e-4
BATCH = 64
SEED = 7
# Labelled rows and bytes of their text to learn from; beyond, an even sample by a hash of the id.
TRAINING_ROWS = 20_000
TRAINING_BYTES = 20_000_000
THRESHOLD = 0.7

SPLIT, HELD_OUT = 4, 2

# Classes of bytes whose shares describe a text's structure.
_CLASSES = {
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": b"0123456789",
    "space": b" \t\r",
    "line": b"\n",
    "stop": b".",
    "comma": b",;:",
    "loud": b"!?",
    "mark": b"#$%&*+=<>@^_|~/\\`",
    "bracket": b"()[]{}\"'-",
}
_OF_BYTE = np.full(256, len(_CLASSES) + 1, np.int64)  # control characters
_OF_BYTE[128:] = len(_CLASSES)  # parts of non-ASCII characters
for _number, _bytes in enumerate(_CLASSES.values()):
    _OF_BYTE[list(_bytes)] = _number
_SHARES = len(_CLASSES) + 2

STRUCTURE = _SHARES + 10
FEATURES = WORD_BUCKETS + STRUCTURE


def structure(text: bytes, words: list[bytes], distinct: int, n_chars: int | None) -> np.ndarray:
    """Shares of byte classes, repetition and lengths, all of about unit size."""
    codes = np.frombuffer(text, np.uint8)
    size, count = max(1, len(codes)), max(1, len(words))
    shares = np.bincount(_OF_BYTE[codes], minlength=_SHARES) / size
    lines = [x for x in text.split(b"\n") if x.strip()]
    longest = max(map(len, words), default=0)
    repeated = 1 - len(set(lines)) / max(1, len(lines))
    more = [
        1.0,
        np.log1p(len(codes)) / 10,
        np.log1p(len(words)) / 10,
        distinct / count,
        distinct / np.sqrt(count) / 10,
        repeated,
        np.log1p(len(lines)) / 5,
        len(codes) / count / 10,
        min(longest, 100) / 50,
        np.log1p(max(0, n_chars or 0)) / 10,
    ]
    return np.concatenate([np.sqrt(shares), more])


def features(text: bytes, n_chars: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and values: distinct hashed words of unit length together, then structure."""
    words = text.split()
    distinct = set(words)
    hashed = np.fromiter(map(zlib.crc32, distinct), np.int64, len(distinct)) % WORD_BUCKETS
    buckets, counts = np.unique(hashed, return_counts=True)
    values = counts / max(1.0, np.sqrt(np.sum(counts.astype(np.float64) ** 2)))
    shape = structure(text, words, len(distinct), n_chars)
    numbers = np.concatenate([buckets, np.arange(WORD_BUCKETS, FEATURES)])
    return numbers.astype(np.int32), np.concatenate([values, shape]).astype(np.float32)


@dataclass
class Model:
    """Bias, weights, factors, and the means and scales the structure features are brought to."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray


def _normal(numbers: np.ndarray, values: np.ndarray, mean: np.ndarray, scale: np.ndarray) -> np.ndarray:
    own = numbers >= WORD_BUCKETS
    out = values.astype(np.float64)
    at = numbers[own] - WORD_BUCKETS
    out[own] = np.clip((out[own] - mean[at]) / scale[at], -5, 5)
    return out


def _logits(model: Model, numbers: np.ndarray, values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For rows of features laid end to end; every row has some."""
    linear = np.add.reduceat(model.weights[numbers] * values, starts)
    weighted = model.factors[numbers] * values[:, None]
    sums = np.add.reduceat(weighted, starts, axis=0)
    squares = np.add.reduceat(weighted**2, starts, axis=0)
    return model.bias + linear + 0.5 * (sums**2 - squares).sum(axis=1)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, epochs: int = EPOCHS) -> Model:
    """Adagrad on the log loss over minibatches of a bounded sample."""
    random = np.random.default_rng(SEED)
    shapes = np.array([v[-STRUCTURE:] for _, v in rows], np.float64).reshape(-1, STRUCTURE)
    mean = shapes.mean(axis=0) if len(rows) else np.zeros(STRUCTURE)
    scale = shapes.std(axis=0) + 1e-3 if len(rows) else np.ones(STRUCTURE)
    model = Model(
        0.0, np.zeros(FEATURES), random.normal(0, 0.02, (FEATURES, RANK)), mean, scale
    )
    if len(rows):
        rate = (labels.sum() + 1) / (len(labels) + 2)
        model.bias = float(np.log(rate / (1 - rate)))
    seen_w, seen_v = np.full(FEATURES, 1e-6), np.full((FEATURES, RANK), 1e-6)
    normal = [(n, _normal(n, v, mean, scale)) for n, v in rows]
    for _ in range(epochs if 0 < labels.sum() < len(labels) else 0):
        order = random.permutation(len(rows))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            numbers = np.concatenate([normal[k][0] for k in chosen])
            values = np.concatenate([normal[k][1] for k in chosen])
            sizes = np.array([len(normal[k][0]) for k in chosen])
            starts = np.cumsum(sizes) - sizes
            error = 1 / (1 + np.exp(-_logits(model, numbers, values, starts))) - labels[chosen]
            each = np.repeat(error, sizes) * values / len(chosen)
            used, place = np.unique(numbers, return_inverse=True)
            grad = np.bincount(place, each) + DECAY * model.weights[used]
            weighted = model.factors[numbers] * values[:, None]
            sums = np.repeat(np.add.reduceat(weighted, starts, axis=0), sizes, axis=0)
            pulls = each[:, None] * (sums - weighted)
            grads = np.stack([np.bincount(place, pulls[:, f]) for f in range(RANK)], axis=1)
            grads += DECAY * model.factors[used]
            seen_w[used] += grad**2
            seen_v[used] += grads**2
            model.weights[used] -= STEP * grad / np.sqrt(seen_w[used])
            model.factors[used] -= STEP * grads / np.sqrt(seen_v[used])
            model.bias -= STEP * error.mean()
    return model


def _featured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in records(batches):
        chars = batch.column(1).to_pylist()
        rows = [features(t, n) for t, n in zip(texts(batch.column(0)), chars, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([n.tobytes() for n, _ in rows], pa.binary()),
                pa.array([v.tobytes() for _, v in rows], pa.binary()),
                batch.column(2),
            ],
            ["numbers", "values", "label"],
        )


def _n_chars(docs: DataFrame, text: str) -> Column:
    """The metadata column n_chars, if the table has it, else the length itself."""
    if "n_chars" in docs.columns:
        return F.col("n_chars").cast("long")
    return F.length(text).cast("long")


def train(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality"
) -> Model:
    """Learn from a bounded sample of labelled documents; their features are made on Spark.

    Labels other than 0 and 1 and null keys are left out; a key labelled twice counts with its larger
    label. Without labels of both kinds the model gives their share to every text.
    """
    prepare(docs.sparkSession)
    wanted = (
        labels.select(F.col(key).alias("key"), F.col(label).cast("int").alias("label"))
        .where("key is not null and label in (0, 1)")
        .groupBy("key")
        .agg(F.max("label").alias("label"))
    )
    wanted = F.broadcast(spread_sample(wanted, F.col("key"), F.lit(1), TRAINING_ROWS))
    sample = docs.select(
        F.col(key).alias("key"), F.col(text).alias("text"), _n_chars(docs, text).alias("n")
    ).join(wanted, "key")
    sizes = F.octet_length("text")
    sample = spread_sample(sample, F.concat_ws(" ", "key", F.lit("rows")), sizes, TRAINING_BYTES)
    made = sample.select("text", "n", "label").mapInArrow(
        _featured, "numbers binary, values binary, label int"
    )
    made = stage(made, "features").collect()  # bounded by TRAINING_ROWS and TRAINING_BYTES
    made.sort(key=lambda x: (bytes(x.numbers), bytes(x["values"]), x.label))
    rows = [(np.frombuffer(x.numbers, np.int32), np.frombuffer(x["values"], np.float32)) for x in made]
    return fit(rows, np.array([x.label for x in made], np.float64))


def score(model: Model, rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    numbers = np.concatenate([n for n, _ in rows])
    values = _normal(numbers, np.concatenate([v for _, v in rows]), model.mean, model.scale)
    sizes = np.array([len(n) for n, _ in rows])
    return 1 / (1 + np.exp(-_logits(model, numbers, values, np.cumsum(sizes) - sizes)))


def scored(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """A column of scores from 0 to 1. Null texts are scored as empty ones."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(DoubleType())
    def run(column: pa.Array, chars: pa.Array) -> pa.Array:
        rows = [features(t, n) for t, n in zip(texts(column), chars.to_pylist(), strict=True)]
        found = [score(shared.value, rows[k : k + 64]) for k in range(0, len(rows), 64)]
        return pa.array(np.concatenate(found) if found else np.zeros(0))

    return run(F.col(text), _n_chars(docs, text))


def assess(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Rows ``(doc_id, held_out, score, predicted)``, one per row of ``docs``.

    Learned from the labelled rows whose id class is not 2. Inputs of a score are the text and the
    metadata n_chars; never labels, lang, source or doc_id. A null id is in class 0.
    """
    held_out = id_class(F.col("doc_id"), SPLIT) == HELD_OUT
    model = train(docs.where(~held_out), labels)
    found = docs.select("doc_id", held_out.alias("held_out"), scored(docs, model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
