"""Language-model scores: a log-frequency Bloom filter of quantised n-gram counts.

Counts fall into levels. An n-gram of level q enters a Bloom filter q + 1 times, together with each
number from 0 to q; its count is found by probing 0, 1, 2, ... until one is missing. The filter holds
words, word pairs that occur at least ``CUTOFF`` times, and for each word the (discounted) mass of its
kept pairs. A token is scored by absolute discounting,

    p(w | h) = max(c(h w) - D, 0) / c(h) + (1 - mass(h) / c(h)) (c(w) + 1) / (N + V + 1).

A false membership is an n-gram at a level by chance, in about one of fifty probes. A pair needs
two of them in a row, and is dropped if it would be more frequent than either of its words.

The filter is cut into segments by hash; each is built in one task of bounded size. Segments are
broadcast in rounds of bounded size, so that the filter may grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm.common import ASCII_LOWER, id_class, prepare, records
from assay.session import stage

SPLIT, HELD_OUT = 7, 2
CUTOFF = 2
DISCOUNT = 0.75
HASHES, BITS_PER_ENTRY = 5, 8
SEGMENT_ENTRIES = 1 << 20  # entries of a segment, about
ROUND_BYTES = 96 << 20  # filter bytes broadcast at once
# Words counted exactly in memory for the unigram score; rarer ones are joined.
HEAD_WORDS = 1 << 17
CACHED_WORDS = 300_000
RUN_TOKENS = 1 << 20  # tokens looked up at once, so that words and pairs met again are probed once
END = b""  # no word is empty

START_HASH = np.uint64(0x5BD1E995)
_WORD, _PAIR, _MASS = (np.uint64(x) for x in (0x9AE16A3B2F90404F, 0xC949D7C7509E6557, 0xFF51AFD7ED558CCD))


def tokens(text: bytes) -> list[bytes]:
    """The words of a text in lower case (A-Z), and the end."""
    return [*text.translate(ASCII_LOWER).split(), END]


class Hashes(dict):
    """32-bit hashes of words, kept while they are few."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh32_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def token_lists(column: pa.Array) -> pa.ListArray:
    """``tokens`` of each text of a column; null is empty."""
    bare = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(column, "")))
    # the empty text after the last blank is the end
    ended = pc.if_else(pc.equal(bare, ""), bare, pc.binary_join_element_wise(bare, " ", ""))
    return pc.ascii_split_whitespace(ended)


def coded(lists: list[pa.ListArray]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words of some texts, the number of each token's word, and where the texts start."""
    flat = pa.chunked_array([x.flatten().cast(pa.binary()) for x in lists]).combine_chunks()
    flat = flat.dictionary_encode()
    sizes = np.concatenate([pc.list_value_length(x).to_numpy(zero_copy_only=False) for x in lists])
    return flat.dictionary, flat.indices.to_numpy().astype(np.int64), np.cumsum(sizes, dtype=np.int64) - sizes


def word_hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh32_intdigest, words.to_numpy(zero_copy_only=False)), np.uint64, len(words))


def histories(hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The hash before each token; ``starts`` has where the texts begin."""
    past = np.empty_like(hashes)
    past[1:] = hashes[:-1]
    past[starts] = START_HASH
    return past


def _thresholds() -> np.ndarray:
    """The least count of each level: every count to 8, then steps of about a seventh."""
    steps = [1]
    while steps[-1] < 1 << 50:
        steps.append(max(steps[-1] + 1, int(steps[-1] * 1.15)))
    return np.array(steps, np.int64)


LEVELS = _thresholds()
# What a level stands for: the geometric mean of its counts; index 0 is "not there".
VALUES = np.concatenate([[0.0], np.sqrt(LEVELS[:-1] * (LEVELS[1:] - 1.0))])


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def word_keys(hashes: np.ndarray) -> np.ndarray:
    return _mixed(hashes * _WORD + np.uint64(1))


def pair_keys(pairs: np.ndarray) -> np.ndarray:
    """``pairs``: history << 32 | word."""
    return _mixed(pairs ^ _PAIR)


def mass_keys(hashes: np.ndarray) -> np.ndarray:
    return _mixed(hashes * _MASS + np.uint64(2))


def _places(mixed: np.ndarray, k: int, bits: np.ndarray | np.uint64) -> np.ndarray:
    """The bit of hash function k in a segment, for mixed (key, level)."""
    low = (mixed + np.uint64(k) * ((mixed >> np.uint64(32)) | np.uint64(1))) & np.uint64(0xFFFFFFFF)
    return (low * bits) >> np.uint64(32)


def _at_level(keys: np.ndarray, level: np.ndarray | int) -> np.ndarray:
    return _mixed(keys + np.uint64(0x9E3779B97F4A7C15) * np.asarray(level, np.uint64))


def build_segment(keys: np.ndarray, levels: np.ndarray) -> bytes:
    """The filter of keys with their levels, as packed bits."""
    times = levels + 1
    bits = max(64, int(times.sum()) * BITS_PER_ENTRY)
    every = np.repeat(keys, times)
    level = np.arange(len(every)) - np.repeat(np.cumsum(times) - times, times)
    on = np.zeros(-(-bits // 8) * 8, bool)
    mixed = _at_level(every, level)
    for k in range(HASHES):
        on[_places(mixed, k, np.uint64(len(on)))] = True
    return np.packbits(on, bitorder="little").tobytes()


@dataclass(frozen=True)
class Segments:
    """Some segments of the filter, end to end; ``first[s]`` is -1 for those that are not here."""

    packed: np.ndarray
    first: np.ndarray
    bits: np.ndarray

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """1 + the level of each key, 0 for a key that is missing here."""
        found = np.zeros(len(keys), np.int16)
        segment = (keys % np.uint64(len(self.first))).astype(np.int64)
        alive = np.flatnonzero(self.first[segment] >= 0)
        level = 0
        while len(alive):
            mixed = _at_level(keys[alive], level)
            bits, first = self.bits[segment[alive]], self.first[segment[alive]]
            for k in range(HASHES):  # those that miss a bit are not probed on
                at = _places(mixed, k, bits).astype(np.int64)
                ok = (self.packed[first + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1 == 1
                alive, mixed, bits, first = alive[ok], mixed[ok], bits[ok], first[ok]
            found[alive] += 1
            level += 1
        return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) to (word, pair, n): counts of words, and of pairs of hashes, of a run of texts."""
    held: list[pa.ListArray] = []

    def flush() -> Iterator[pa.RecordBatch]:
        names, own, starts = coded(held)
        hashes = word_hashes(names)[own]
        pairs = histories(hashes, starts) << np.uint64(32) | hashes
        keys, counts = np.unique(pairs, return_counts=True)
        for words, key, count in (
            (names, np.zeros(len(names), np.int64), np.bincount(own)),
            (pa.nulls(len(keys), pa.binary()), keys.view(np.int64), counts),
        ):
            yield pa.RecordBatch.from_arrays(
                [words, pa.array(key), pa.array(count, pa.int64())], ["word", "pair", "n"]
            )
        held.clear()

    size = 0
    for batch in records(batches):
        held.append(token_lists(batch.column(0)))
        size += len(held[-1].flatten())
        if size >= 1 << 21:
            yield from flush()
            size = 0
    if held:
        yield from flush()


@dataclass(frozen=True)
class Model:
    """Exact counts as a table (word, c); N and V; filter segments as a table (segment, packed)."""

    counts: DataFrame
    total: int
    distinct: int
    segments: DataFrame
    number: int


def train(docs: DataFrame, text: str = "text") -> Model:
    """Count all tokens and word pairs of all rows of ``docs``; null texts are empty."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(text)).mapInArrow(_counted, "word binary, pair long, n long")
    rows = stage(rows.groupBy("word", "pair").agg(F.sum("n").alias("n")).where(f"word is not null or n >= {CUTOFF}"), "ngrams")
    counts = rows.where("word is not null").select("word", F.col("n").alias("c"))
    pairs = rows.where("word is null")
    sums = counts.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    starts = counts.where(F.length("word") == 0).agg(F.sum("c")).first()[0] or 0  # one end per text

    history = F.shiftrightunsigned("pair", 32)
    kept = F.floor(F.sum(F.col("n") - F.lit(DISCOUNT)))
    masses = pairs.groupBy(history.alias("pair")).agg(kept.alias("n"))
    entries = (
        counts.select(F.lit(0).alias("kind"), F.col("word"), F.lit(0).cast("long").alias("pair"), F.col("c").alias("n"))
        .union(pairs.select(F.lit(1), F.lit(None).cast("binary"), "pair", "n"))
        .union(masses.select(F.lit(2), F.lit(None).cast("binary"), "pair", "n").where("n > 0"))
        .mapInArrow(_keyed, "key long, level int")
    )
    start = docs.sparkSession.range(1 if starts else 0).select(
        F.lit(int(word_keys(np.array([START_HASH]))[0].astype(np.int64))).alias("key"),
        F.lit(int(np.searchsorted(LEVELS, starts, "right") - 1)).alias("level"),
    )
    entries = stage(entries.union(start), "entries")
    events = entries.agg(F.sum(F.col("level").cast("long") + 1)).first()[0] or 0
    number = max(1, -(-events // SEGMENT_ENTRIES))
    segment = _unsigned_mod(F.col("key"), number)
    segments = stage(
        entries.withColumn("segment", segment)
        .groupBy("segment")
        .applyInArrow(_built, "segment long, packed binary"),
        "segments",
    )
    return Model(counts, sums.n or 0, sums.v or 0, segments, number)


def _unsigned_mod(key, number: int):
    """key mod number, with key as unsigned 64 bits."""
    high, low = F.shiftrightunsigned(key, 32), key.bitwiseAND(F.lit(0xFFFFFFFF))
    return ((high % number) * ((1 << 32) % number) + low % number) % number


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, word, pair, n) to (key, level)."""
    for batch in records(batches, 1 << 16):
        kind = batch.column(0).to_numpy(zero_copy_only=False)
        pair = batch.column(2).to_numpy(zero_copy_only=False).view(np.uint64)
        n = batch.column(3).to_numpy(zero_copy_only=False)
        keys = np.where(kind == 1, pair_keys(pair), mass_keys(pair))
        word = np.flatnonzero(kind == 0)
        keys[word] = word_keys(word_hashes(batch.column(1).take(pa.array(word))))
        level = (np.searchsorted(LEVELS, n, "right") - 1).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.view(np.int64)), pa.array(level)], ["key", "level"]
        )


def _built(group: pa.Table) -> pa.Table:
    # two words of one hash count as the more frequent
    best = group.group_by("key").aggregate([("level", "max")])
    packed = build_segment(
        best["key"].to_numpy().view(np.uint64), best["level_max"].to_numpy().astype(np.int64)
    )
    return pa.table({"segment": group["segment"][:1], "packed": pa.array([packed], pa.binary())})


def _rounds(model: Model, round_bytes: int) -> list[tuple[int, int, int]]:
    """Runs of segments (first, last, bytes) of at most about ``round_bytes`` each."""
    size = F.length("packed").alias("size")
    runs: list[tuple[int, int, int]] = []
    for segment, more in sorted(tuple(r) for r in model.segments.select("segment", size).collect()):
        if runs and runs[-1][2] + more <= round_bytes:
            runs[-1] = (runs[-1][0], segment, runs[-1][2] + more)
        else:
            runs.append((segment, segment, more))
    return runs or [(0, -1, 0)]


def _loaded(model: Model, run: tuple[int, int, int]) -> Segments:
    """The segments of a run; their size is known and bounded."""
    low, high, size = run
    packed, at = np.zeros(max(1, size), np.uint8), 0
    first, bits = np.full(model.number, -1), np.ones(model.number, np.uint64)
    for row in model.segments.where(F.col("segment").between(low, high)).toLocalIterator():
        part = np.frombuffer(row.packed, np.uint8)
        first[row.segment], bits[row.segment] = at, len(part) * 8
        packed[at : at + len(part)] = part
        at += len(part)
    return Segments(packed, first, bits)


def log_probabilities(levels: np.ndarray, total: int, distinct: int) -> np.ndarray:
    """log10 p of each token from its four levels."""
    word, past, pair, mass = VALUES[levels]
    # a pair is kept from CUTOFF on and is no more frequent than its words: else the filter errs
    pair = np.where(pair >= CUTOFF, np.minimum(pair, np.minimum(word, past)), 0)
    pair[pair < CUTOFF] = 0
    share = np.divide(np.maximum(pair - DISCOUNT, 0), past, out=np.zeros_like(past), where=past > 0)
    rest = np.divide(mass, past, out=np.zeros_like(past), where=past > 0)
    # counts are quantised: some of the mass always stays with the words alone
    rest = 1 - np.minimum(rest, 0.98)
    return np.log10(np.minimum(share, 0.98) + rest * (word + 1) / (total + distinct + 1))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", round_bytes: int = ROUND_BYTES) -> DataFrame:
    """Rows ``(key, n_tokens, n_known, train_tokens, base_score, score)``, one per row of ``docs``.

    ``n_known`` and ``base_score`` are exact: frequent words from a table of bounded size in memory,
    the others by a join. Null and empty texts are one end token. Repeated rows give repeated rows,
    other columns are not read.
    """
    spark = docs.sparkSession
    prepare(spark)
    head = model.counts.orderBy(F.desc("c"), "word").limit(HEAD_WORDS).toArrow()
    complete = head.num_rows < HEAD_WORDS  # then all words are here, and others are unknown
    shared_head = spark.sparkContext.broadcast(
        (head["word"].combine_chunks(), np.append(head["c"].to_numpy(), 0))  # the last is of other words
    )
    del head
    total, distinct = model.total, model.distinct
    floor = np.log10(1 / (total + distinct + 1))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(key).alias("key"),
        F.coalesce(text, F.lit("")).alias("text"),
        F.lit(None).cast("binary").alias("state"),
    )
    runs = _rounds(model, round_bytes)
    for round_ in runs[:-1]:
        shared = spark.sparkContext.broadcast(_loaded(model, round_))
        rows = stage(rows.mapInArrow(_gather(shared), "row long, key long, text string, state binary"), "levels")
    shared = spark.sparkContext.broadcast(_loaded(model, runs[-1]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, counts = shared_head.value
        for held, lists in _token_runs(batches):
            names, own, starts = coded(lists)
            levels = _state(shared.value, names, own, starts, [x for b in held for x in b.column(3).to_pylist()])
            ends = np.append(starts[1:], len(own))
            logs = log_probabilities(levels, total, distinct)
            place = pc.index_in(names, value_set=frequent).fill_null(len(frequent)).to_numpy()
            count = counts[place]
            known = (count > 0)[own]
            bases = np.log10(count + 1.0)[own]
            at = np.flatnonzero(~known)[: 0 if complete else None]
            of = np.searchsorted(starts, at, side="right") - 1
            rare, times = np.unique(of * len(names) + own[at], return_counts=True)
            offsets = np.searchsorted(rare, np.arange(len(starts) + 1) * len(names))
            each = pa.StructArray.from_arrays(
                [names.take(pa.array(rare % len(names))), pa.array(times, pa.int64())], ["word", "n"]
            )
            yield pa.RecordBatch.from_arrays(
                [
                    pa.concat_arrays([b.column(0) for b in held]),
                    pa.concat_arrays([b.column(1) for b in held]),
                    pa.array(ends - starts),
                    pa.array(np.add.reduceat(known, starts, dtype=np.int64)),
                    pa.array([x.sum() + floor * len(x) for x in np.split(bases, starts[1:])], pa.float64()),
                    pa.array(np.add.reduceat(logs, starts)),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), each),
                ],
                ["row", "key", "n_tokens", "n_known", "base_score", "score", "rare"],
            )

    scored = stage(
        rows.mapInArrow(
            run,
            "row long, key long, n_tokens long, n_known long, base_score double, score double, "
            "rare array<struct<word: binary, n: long>>",
        ),
        "scores",
    )
    rare = scored.select("row", F.inline("rare")).join(model.counts, "word")
    more = rare.groupBy("row").agg(
        F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more_base")
    )
    return scored.drop("rare").join(more, "row", "left").select(
        F.col("key").alias(key),
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def _token_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], list[pa.ListArray]]]:
    """Runs of rows of about ``RUN_TOKENS`` tokens, and the tokens of each row; column 2 is the text."""
    held: list[pa.RecordBatch] = []
    lists: list[pa.ListArray] = []
    size = 0
    for batch in records(batches):
        held.append(batch)
        lists.append(token_lists(batch.column(2)))
        size += len(lists[-1].flatten())
        if size >= RUN_TOKENS:
            yield held, lists
            held, lists, size = [], [], 0
    if held:
        yield held, lists


def _state(
    segments: Segments, names: pa.Array, own: np.ndarray, starts: np.ndarray, before: list[bytes | None]
) -> np.ndarray:
    """Levels of all tokens of some texts, together with those of earlier rounds."""
    hashes = np.append(word_hashes(names), START_HASH)
    past = np.empty_like(own)
    past[1:] = own[:-1]
    past[starts] = len(names)
    word, mass = np.split(segments.levels(np.concatenate([word_keys(hashes), mass_keys(hashes)])), 2)
    pair = np.zeros(len(own), np.int16)
    # a pair counts for no more than its words: with the whole filter here, those of rarer words say nothing
    often = VALUES[word] >= CUTOFF if (segments.first >= 0).all() else np.ones(len(hashes), bool)
    asked = np.flatnonzero(often[own] & often[past])
    pairs, place = np.unique(hashes[past[asked]] << np.uint64(32) | hashes[own[asked]], return_inverse=True)
    pair[asked] = segments.levels(pair_keys(pairs))[place]
    levels = np.stack([word[own], word[past], pair, mass[past]])
    if before[0] is not None:
        old = np.concatenate([np.frombuffer(x, np.int16).reshape(4, -1) for x in before], axis=1)
        levels = np.maximum(levels, old)
    return levels


def _gather(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held, lists in _token_runs(batches):
            names, own, starts = coded(lists)
            before = [x for b in held for x in b.column(3).to_pylist()]
            levels = _state(shared.value, names, own, starts, before)
            state = [x.astype(np.int16).tobytes() for x in np.split(levels, starts[1:], axis=1)]
            columns = [pa.concat_arrays([b.column(k) for b in held]) for k in range(3)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(state, pa.binary())], ["row", "key", "text", "state"]
            )

    return run


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Scores of all rows, learned from those whose id class is not 2; a null id is in class 0."""
    held_out = id_class(F.col("doc_id"), SPLIT) == HELD_OUT
    model = train(docs.where(~held_out))
    return score(docs, model).withColumn("held_out", id_class(F.col("doc_id"), SPLIT) == HELD_OUT)
