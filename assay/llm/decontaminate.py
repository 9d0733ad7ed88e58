"""Benchmark decontamination: prefix-filtered containment join of item windows with documents.

A window is a run of consecutive item words that counts as found only if all of it occurs, so its
required overlap is its length and its prefix is one token: the word of it that is rarest in the
documents. A document word is looked up among these prefixes; where it meets one, the place of the
word in the window fixes where the window would begin, the document's ends bound that place, and the
words are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from assay.llm.common import prepare, records, texts
from assay.session import stage

WINDOW_WORDS = 10
# Items are broadcast in blocks of about this many bytes of text; a larger benchmark takes more
# passes over the documents, one for each block.
BLOCK_BYTES = 32 << 20
PAIRS = 1 << 20  # places compared at once

# Bytes of words: 0-9, a-z and all of a multi-byte character; A-Z become a-z, the rest parts words.
WORD_BYTES = bytes(
    c + 32
    if 65 <= c <= 90
    else c
    if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122
    else 32
    for c in range(256)
)


def words(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


@dataclass(frozen=True)
class Windows:
    """The distinct windows of a block of items, by number of their prefix word.

    ``words[k, j]``: word j of window k, -2 behind its end; ``place[k]``: place of the prefix in it;
    windows ``first[w]`` to ``first[w + 1]`` have word w as prefix; ``items[k]``: ids of its items.
    """

    vocabulary: dict[bytes, int]
    words: np.ndarray
    lengths: np.ndarray
    place: np.ndarray
    first: np.ndarray
    items: list[tuple[str, ...]]


def _vocabulary(items: list[tuple[str | None, list[bytes]]]) -> dict[bytes, int]:
    return {w: k for k, w in enumerate(sorted({w for _, words_ in items for w in words_}))}


def _windows(
    items: list[tuple[str | None, list[bytes]]], counts: np.ndarray, vocabulary: dict[bytes, int]
) -> Windows:
    found: dict[tuple[int, ...], set[str]] = {}
    for item, words_ in items:
        ids = [vocabulary[w] for w in words_]
        for start in range(max(1, len(ids) - WINDOW_WORDS + 1)):
            window = tuple(ids[start : start + WINDOW_WORDS])
            if window:
                found.setdefault(window, set()).update([] if item is None else [item])
    rarest = {w: min(range(len(w)), key=lambda j, w=w: (counts[w[j]], w[j])) for w in found}
    ordered = sorted(found, key=lambda w: (w[rarest[w]], w))
    table = np.full((len(ordered), WINDOW_WORDS), -2, np.int64)
    for k, window in enumerate(ordered):
        table[k, : len(window)] = window
    prefixes = np.array([w[rarest[w]] for w in ordered], np.int64)
    return Windows(
        vocabulary,
        table,
        np.array([len(w) for w in ordered], np.int64),
        np.array([rarest[w] for w in ordered], np.int64),
        np.searchsorted(prefixes, np.arange(len(vocabulary) + 1)),
        [tuple(sorted(found[w])) for w in ordered],
    )


def _ids(text: bytes, vocabulary: dict[bytes, int]) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(vocabulary.get, found, repeat(-1)), np.int64, len(found))


def matches(ids: np.ndarray, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Where windows occur in a document of word numbers: (starts, windows)."""
    known = np.flatnonzero(ids >= 0)
    per_word = np.diff(windows.first)
    known = known[per_word[ids[known]] > 0]
    starts, numbers = [], []
    ends = np.cumsum(per_word[ids[known]])
    begin = 0
    while begin < len(known):  # at least one place, and about PAIRS comparisons
        stop = np.searchsorted(ends, (ends[begin - 1] if begin else 0) + PAIRS, side="right")
        part = known[begin : max(stop, begin + 1)]
        begin += len(part)
        sizes = per_word[ids[part]]
        within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        number = np.repeat(windows.first[ids[part]], sizes) + within
        start = np.repeat(part, sizes) - windows.place[number]
        ok = (start >= 0) & (start + windows.lengths[number] <= len(ids))
        start, number = start[ok], number[ok]
        for j in range(WINDOW_WORDS):
            expected = windows.words[number, j]
            inside = expected >= 0
            ok = ~inside | (ids[np.minimum(start + j, len(ids) - 1)] == expected)
            start, number = start[ok], number[ok]
        starts.append(start)
        numbers.append(number)
    none = np.zeros(0, np.int64)
    return np.concatenate(starts or [none]), np.concatenate(numbers or [none])


FOUND = StructType(
    [
        StructField("n_words", LongType()),
        StructField("hits", ArrayType(LongType())),
        StructField("items", ArrayType(StringType())),
    ]
)


def _found(docs: DataFrame, text: str, windows: Windows, earlier: Column) -> Column:
    """Struct (n_words, hits, items): hits are the places of hit words, added to earlier blocks'."""
    shared = docs.sparkSession.sparkContext.broadcast(windows)

    @F.arrow_udf(FOUND)
    def find(column: pa.Array, before: pa.Array) -> pa.Array:
        rows = []
        for value, old in zip(texts(column), before.to_pylist(), strict=True):
            ids = _ids(value, shared.value.vocabulary)
            starts, numbers = matches(ids, shared.value)
            edges = np.zeros(len(ids) + 1, np.int64)
            np.add.at(edges, starts, 1)
            np.add.at(edges, starts + shared.value.lengths[numbers], -1)
            hit = np.cumsum(edges[:-1]) > 0
            hit[(old or {}).get("hits", [])] = True
            items = {x for k in np.unique(numbers) for x in shared.value.items[k]}
            items.update((old or {}).get("items", []))
            rows.append((len(ids), np.flatnonzero(hit), sorted(items)))
        return pa.array(
            [{"n_words": n, "hits": h, "items": i} for n, h, i in rows],
            pa.struct(
                [
                    ("n_words", pa.int64()),
                    ("hits", pa.list_(pa.int64())),
                    ("items", pa.list_(pa.string())),
                ]
            ),
        )

    return find(F.col(text), earlier)


def _corpus_counts(docs: DataFrame, text: str, vocabulary: dict[bytes, int]) -> np.ndarray:
    """How often each benchmark word occurs in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(shared.value), np.int64)
        for batch in records(batches):
            for value in texts(batch.column(0)):
                ids = _ids(value, shared.value)
                total += np.bincount(ids[ids >= 0], minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["word", "n"])

    rows = docs.select(text).mapInArrow(count, "word long, n long").groupBy("word").sum("n")
    counts = np.zeros(len(vocabulary), np.int64)
    for word, n in rows.collect():  # one number for each word of the block
        counts[word] = n
    return counts


def mark(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` with one more column ``_found``: struct (n_words, hits, items).

    Words: lower-cased A-Z, then runs of 0-9, a-z and non-ASCII characters. ``hits``: places of the
    words inside any occurrence of a window; ``items``: ids, as sorted strings, of the items with an
    occurring window. Null and empty texts have no words; an item without words has no window; a null
    item id marks words but is not listed; rows with one id are one item. An empty benchmark marks
    nothing. A column ``_found`` of ``docs`` is replaced.
    """
    prepare(docs.sparkSession)
    source = benchmark.select(
        F.col(item).cast("string").alias("item"), F.coalesce(item_text, F.lit("")).alias("text")
    )
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    marked = docs.withColumn("_found", F.lit(None).cast(FOUND))
    for number in range(blocks):
        rows = source.where(block == number).collect()
        items = [(row.item, words((row.text or "").encode())) for row in rows]
        vocabulary = _vocabulary(items)
        windows = _windows(items, _corpus_counts(docs, text, vocabulary), vocabulary)
        marked = marked.withColumn("_found", _found(marked, text, windows, F.col("_found")))
        if number + 1 < blocks:
            marked = stage(marked, "found")
    return marked


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document: (doc_id, n_words, n_hit, n_items, items_sha256, contaminated)."""
    found = F.col("_found")
    return mark(docs.select("doc_id", "text"), benchmark).select(
        "doc_id",
        found.n_words.alias("n_words"),
        F.size(found.hits).cast("long").alias("n_hit"),
        F.size(found["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(found["items"], ",").cast("binary"), 256).alias("items_sha256"),
        (F.size(found.hits) > 0).alias("contaminated"),
    )


def uncontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no window of the benchmark occurs."""
    whole = docs.select(F.struct(*docs.columns).alias("whole"), "text")
    return mark(whole, benchmark).where(F.size("_found.hits") == 0).select("whole.*")
