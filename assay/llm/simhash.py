"""SimHash near-copies: Golay-code fuzzy hashing of 64-bit fingerprints.

A fingerprint is cut into three segments of 22, 21 and 21 bits. The perfect (23, 12) Golay code
decodes a segment to its nearest codeword; a segment at the covering radius (3) also gets the
codewords that one more flipped bit would lead to, six in all. Two segments that differ in at most
two bits then share a codeword. Of two differing bits at least one segment has none, so fingerprints
that link agree exactly in one segment and share a codeword in the next: these are the keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from assay.llm.common import ASCII_LOWER, prepare, records, texts
from assay.llm.components import connected_components
from assay.session import stage

SHINGLE_WORDS = 3
SEED = 42
MAX_DISTANCE = 2
SEGMENTS = (22, 21, 21)
# Keys with more fingerprints than this also have to share a codeword in the third segment.
CROWDED = 64
PIECE = 1 << 17  # shingles whose bits are counted at once

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1, generator of the Golay code


def fingerprint(text: bytes) -> int:
    """The SimHash of the word shingles of a text, as a signed long; 0 if it has no words."""
    words = text.translate(ASCII_LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE_WORDS:
        shingles, count = iter([b" ".join(words)]), 1
    else:
        shifted = (words[i:] for i in range(SHINGLE_WORDS))
        shingles, count = map(b" ".join, zip(*shifted)), len(words) - SHINGLE_WORDS + 1
    digest = partial(xxhash.xxh64_intdigest, seed=SEED)
    set_bits = np.zeros(64, np.int64)
    for start in range(0, count, PIECE):
        size = min(PIECE, count - start)
        hashes = np.fromiter(map(digest, _take(shingles, size)), "<u8", size)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        set_bits += bits.sum(axis=0, dtype=np.int64)
    on = np.packbits(set_bits * 2 > count, bitorder="little")
    return int(on.view("<i8")[0])


def _take(items: Iterator[bytes], count: int) -> Iterator[bytes]:
    for _, item in zip(range(count), items, strict=False):
        yield item


@F.arrow_udf(LongType())
def fingerprint_of(column: pa.Array) -> pa.Array:
    return pa.array([fingerprint(x) for x in texts(column)], pa.int64())


def hex_fingerprint(column: Column) -> Column:
    return F.lower(F.lpad(F.hex(column), 16, "0"))


@lru_cache(1)
def _code() -> tuple[np.ndarray, np.ndarray]:
    """The syndrome of each single bit, and the lightest error with each syndrome."""

    def syndrome(word: int) -> int:
        for bit in range(22, 10, -1):
            if word >> bit & 1:
                word ^= GENERATOR << (bit - 11)
        return word

    singles = np.array([syndrome(1 << bit) for bit in range(23)], np.int64)
    errors = np.zeros(2048, np.int64)
    for weight in range(4):
        for bits in combinations(range(23), weight):
            errors[syndrome(sum(1 << b for b in bits))] = sum(1 << b for b in bits)
    return singles, errors


def codewords(segments: np.ndarray) -> np.ndarray:
    """For each segment a row of codeword numbers in increasing order, repeats set to -1."""
    singles, errors = _code()
    syndromes = np.zeros(len(segments), np.int64)
    for bit in range(23):
        syndromes ^= np.where(segments >> bit & 1, singles[bit], 0)
    flips = np.concatenate([[0], 1 << np.arange(23, dtype=np.int64)])
    near = np.concatenate([[0], singles])
    flipped = segments[:, None] ^ flips
    numbers = (flipped ^ errors[syndromes[:, None] ^ near]) >> 11
    numbers.sort(axis=1)
    numbers[:, 1:][numbers[:, 1:] == numbers[:, :-1]] = -1
    return numbers


def _segments(prints: np.ndarray) -> list[np.ndarray]:
    values, parts, low = prints.view(np.uint64), [], 0
    for width in SEGMENTS:
        parts.append(((values >> np.uint64(low)) & np.uint64((1 << width) - 1)).astype(np.int64))
        low += width
    return parts


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fingerprint) to (key, fingerprint): one exact segment, one codeword of the next."""
    for batch in records(batches, 4096):
        prints = batch.column(0).to_numpy(zero_copy_only=False)
        parts = _segments(prints)
        for i in range(3):
            numbers = codewords(parts[(i + 1) % 3])
            keys = (numbers << 22 | parts[i][:, None]) << 2 | i
            rows, _ = np.nonzero(numbers >= 0)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[numbers >= 0]), pa.array(prints[rows])], ["key", "fp"]
            )


def _rekeyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a crowded key once for each codeword of the third segment."""
    for batch in records(batches, 4096):
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        prints = batch.column(1).to_numpy(zero_copy_only=False)
        parts = np.stack(_segments(prints))
        numbers = codewords(parts[((keys & 3) + 2) % 3, np.arange(len(keys))])
        rows, _ = np.nonzero(numbers >= 0)
        wide = (keys[:, None] << 12 | numbers)[numbers >= 0]  # 12 + 22 + 2 + 12 bits
        yield pa.RecordBatch.from_arrays(
            [pa.array(wide), pa.array(prints[rows])], ["key", "fp"]
        )


def linked_fingerprints(prints: DataFrame) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of the distinct fingerprints ``fp`` that differ in 1 or 2 bits.

    Most keys hold one fingerprint. Those of a key that many share are keyed once more by the third
    segment, so that a crowd of different fingerprints is not paired with itself.
    """
    keyed = stage(prints.mapInArrow(_keyed, "key long, fp long"), "keys")
    sizes = keyed.groupBy("key").count().where("count > 1")
    shared = keyed.join(sizes, "key")
    rare = shared.where(F.col("count") <= CROWDED).select("key", "fp")
    crowded = shared.where(F.col("count") > CROWDED).select("key", "fp")
    pairs = [_pairs(rare), _pairs(crowded.mapInArrow(_rekeyed, "key long, fp long"))]
    return pairs[0].union(pairs[1]).distinct()


def _pairs(keyed: DataFrame) -> DataFrame:
    left = keyed.select("key", F.col("fp").alias("a"))
    right = keyed.select("key", F.col("fp").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MAX_DISTANCE
    return left.join(right, "key").where((F.col("a") < F.col("b")) & near).select("a", "b")


def near_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows ``(key, fp, component)``, one for each row of ``docs``.

    ``fp`` is the fingerprint; fingerprints link at two or fewer differing bits, and ``component`` is
    the smallest key reachable. Documents with equal fingerprints count once from here on, however
    many they are. A null or empty text has fingerprint 0. Repeated rows give repeated rows; a null
    key takes its component from the others (null if there are none). Other columns are not read.
    """
    prepare(docs.sparkSession)
    marked = stage(
        docs.select(F.col(key).alias("id"), fingerprint_of(F.col(text)).alias("fp")), "prints"
    )
    distinct = marked.groupBy("fp").agg(F.min("id").alias("first"))
    roots = connected_components(linked_fingerprints(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    firsts = rooted.groupBy("root").agg(F.min("first").alias("component"))
    of_print = stage(rooted.join(firsts, "root").select("fp", "component"), "components")
    return marked.join(of_print, "fp").select(F.col("id").alias(key), "fp", "component")


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs``, all columns, that are the first (by key) of their group of near-copies.

    If that key is repeated, one of its rows stays. Rows with a null key stay only if no other
    document of the group has one.
    """
    copies = near_copies(docs, key, text)
    kept = copies.where(F.col(key).eqNullSafe(F.col("component"))).select(F.col(key).alias("id"), "fp")
    counted = stage(kept.groupBy("id", "fp").count(), "kept")
    whole = docs.select(
        F.struct(*docs.columns).alias("whole"),
        F.col(key).alias("own"),
        fingerprint_of(F.col(text)).alias("own_fp"),
    )
    same = F.col("own").eqNullSafe(F.col("id")) & (F.col("own_fp") == F.col("fp"))
    one = whole.join(counted.drop("count"), same)
    repeated = counted.groupBy("id").agg(F.sum("count").alias("n")).where("n > 1")
    if repeated.limit(1).count():
        one = one.dropDuplicates(["own"])
    return one.select("whole.*")
