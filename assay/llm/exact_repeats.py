"""Removing byte strings that occur in an earlier document, by suffix arrays.

Texts are treated as UTF-8 bytes, and a window is ``LENGTH`` of them. A byte goes if a window that covers it
also occurs in a document with a smaller id.

1. Each window belongs to its anchor, the leftmost of its 16-byte strings with the least hash, so the
   same window has the same anchor wherever it occurs. The windows of one anchor are adjacent; the
   text they cover is the anchor's context. Per document and distinct context one row is
   dealt by the anchor's hash.
2. In documents that come later than the first one with a context, all its windows go. In that first
   document, a window goes if it occurs in another context of the same anchor from an earlier
   document. Only such contexts matter that agree with another one on the 16 bytes before or behind
   the anchor, since a window holds one of these.
3. Their texts, trimmed to what each shares with any other, are sorted as suffix arrays, built by
   linear grouping, in batches of whole anchors; runs of suffixes that share ``LENGTH`` bytes are equal
   windows, and the least document of a run is known. An anchor with too many contexts for memory is
   cut, and its runs are settled across batches by their hash.
4. Documents with findings look the contexts up again and drop the bytes covered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm.common import prepare, records, texts
from assay.llm.grouping import suffix_array
from assay.session import stage

LENGTH = 50
GRAM = 16
BATCH_BYTES = 1 << 16
PARTS = 16  # an anchor's trimmed contexts may take so many batches, and untrimmed ones as many times more
BLOCK_BYTES = 1 << 22  # of texts hashed together
SIDE_BITS = 6

# Any odd numbers with mixed bits do.
MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

# A text, and the contexts it stands in: (context, document, its first window's place there).
Entry = tuple[bytes, list[tuple[int, int, int]]]

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"


class Anchors:
    """The anchors of texts laid end to end, and the windows that belong to each."""

    def __init__(self, parts: list[bytes], length: int = LENGTH):
        self.length, self.text = length, b"".join(parts)
        sizes = np.array([len(p) for p in parts], np.int64)
        self.begin = np.cumsum(sizes) - sizes
        data = np.frombuffer(self.text, np.uint8)
        grams = _gram_hashes(data)
        least, offset = _leftmost_least(grams, length - GRAM + 1)
        inside = _ranges(self.begin, sizes - length + 1)
        owner = inside + offset[inside]
        document = np.repeat(np.arange(len(parts)), np.maximum(sizes - length + 1, 0))
        new = np.ones(len(inside), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (document[1:] != document[:-1])
        first = np.flatnonzero(new)
        self.document = document[first]
        self.start = inside[first]  # of the first window
        self.windows = np.diff(np.append(first, len(inside)))
        self.anchor = owner[first]
        self.hash = least[self.start]
        self.end = self.start + self.windows + length - 1  # of the last window
        self.context = self._context_hashes(grams)
        self.side = self._sides(grams)

    def _context_hashes(self, grams: np.ndarray) -> np.ndarray:
        """A hash of each context: of grams that together cover it, and of its length."""
        mixed = self.windows.astype(np.uint64) * MIX[2]
        covered = (self.length + self.length - GRAM) // GRAM // 2 + 1  # from each end
        for k in range(covered):
            for at in (self.start + k * GRAM, self.end - (k + 1) * GRAM):
                at = np.clip(at, self.start, self.end - GRAM)
                mixed = (mixed ^ grams[at]) * MIX[0]
                mixed ^= mixed >> np.uint64(29)
                mixed = mixed * MIX[1] + MIX[2]
        return mixed ^ (mixed >> np.uint64(32))

    def _sides(self, grams: np.ndarray) -> np.ndarray:
        """Some bits of the gram before and of the gram behind each anchor, 0 where no window has it."""
        most = np.uint64((1 << SIDE_BITS) - 1)
        out = np.zeros(len(self.start), np.int64)
        for side, at in enumerate((self.anchor - GRAM, self.anchor + GRAM)):
            known = (at >= self.start) & (at + GRAM <= self.end)
            bits = (grams[np.where(known, at, 0)] % most).astype(np.int64) + 1
            out |= np.where(known, bits, 0) << (side * 8)
        return out


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the ``GRAM`` bytes from each place on; what runs over the end is of no use."""
    hashes = (data.astype(np.uint64) + np.uint64(1)) * MIX[0]
    hashes ^= hashes >> np.uint64(29)
    width = 1
    while width < GRAM:
        longer = hashes * MIX[1]
        longer[: len(hashes) - width] += hashes[width:]
        longer *= MIX[0]
        hashes = longer ^ (longer >> np.uint64(31))
        width *= 2
    return hashes


def _leftmost_least(values: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of the ``width`` values from each place on, and how far on its first one is."""
    least, offset, done = values, np.zeros(len(values), np.uint8), 1
    while done < width:
        step = min(done, width - done)
        n = max(len(values) - step, 0)
        right, moved = least[step:], offset[step:] + np.uint8(step)
        smaller = right < least[:n]
        least, offset = least.copy(), offset.copy()
        np.copyto(least[:n], right, where=smaller)
        np.copyto(offset[:n], moved, where=smaller)
        done += step
    return least, offset


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of the ranges that begin at ``starts``; none where a size is not positive."""
    sizes = np.maximum(sizes, 0)
    skipped = np.cumsum(sizes) - sizes
    return np.repeat(starts - skipped, sizes) + np.arange(sizes.sum())


def _blocks(sizes: list[int]) -> Iterator[slice]:
    """Slices of at most about ``BLOCK_BYTES``, or one longer text."""
    first = total = 0
    for k, size in enumerate(sizes):
        if total and total + size > BLOCK_BYTES:
            yield slice(first, k)
            first = k
            total = 0
        total += size
    if sizes:
        yield slice(first, len(sizes))


def repeats(
    documents: DataFrame, length: int = LENGTH, texts_too: bool = True, batch: int = BATCH_BYTES
) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` of each document.

    Bytes go that a string of ``length`` bytes covers which also starts in a document with a smaller
    id; strings are those of the input, overlaps count, and none crosses documents. ``kept`` is what
    remains of the text, null unless ``texts_too``. A null text is empty. A null id is neither smaller nor larger than another:
    such a document loses nothing and no other loses by it. Repeated rows get a result each, judged
    by the other ids alone. Further columns are passed over. An empty table gives no row. ``batch`` is
    the number of bytes that one suffix array takes; it bounds memory, not results.
    """
    if not 3 * GRAM - 1 <= length <= 4 * GRAM:  # a gram beside the anchor, and a bit for each window
        raise ValueError(f"length must be from {3 * GRAM - 1} to {4 * GRAM}")
    prepare(documents.sparkSession)
    rows = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text"),
    )
    findings = stage(_findings(rows, length, batch), "findings")
    per_document = findings.groupBy("doc_id").agg(
        F.collect_list("context").alias("contexts"), F.collect_list("windows").alias("windows")
    )
    joined = _packed(rows).join(per_document, "doc_id", "left")
    return joined.select("doc_id", "packed", "contexts", "windows").mapInArrow(
        partial(_kept, length=length, texts_too=texts_too), RESULT
    )


def _packed(rows: DataFrame) -> DataFrame:
    """Texts compressed, since they are to be shuffled."""
    return rows.mapInArrow(_compressed, "doc_id long, packed binary")


def _findings(rows: DataFrame, length: int, batch: int) -> DataFrame:
    """``(doc_id, context, windows)``: which windows of a context go from a document (bits; -1: all)."""
    known = rows.where(F.col("doc_id").isNotNull() & (F.length("text") >= length))
    found = known.mapInArrow(
        partial(_contexts, length=length), "hash long, context long, doc_id long, side short"
    )
    by_anchor, by_context = Window.partitionBy("hash"), Window.partitionBy("hash", "context")
    shared = (
        found.withColumns(
            {
                "least": F.min("doc_id").over(by_anchor),
                "most": F.max("doc_id").over(by_anchor),
                "several": F.min("context").over(by_anchor) < F.max("context").over(by_anchor),
            }
        )
        .where("least < most")
        .withColumns(
            {
                "first": F.min("doc_id").over(by_context),
                "rank": F.row_number().over(by_context.orderBy("doc_id")),
            }
        )
        .where("doc_id > first OR (several AND rank = 1)")
        .select(
            "doc_id",
            "context",
            F.when(F.col("doc_id") == F.col("first"), F.col("hash")).alias("hash"),
            "side",
        )
    )
    shared = stage(shared, "shared")
    later = shared.where("hash IS NULL").select("doc_id", "context", F.lit(-1).cast("long").alias("windows"))
    return later.unionByName(_within(rows, shared.where("hash IS NOT NULL"), length, batch))


def _within(rows: DataFrame, first: DataFrame, length: int, batch: int) -> DataFrame:
    """Windows of first contexts that occur in another context of their anchor, from an earlier document."""
    before = F.col("side").bitwiseAND(255)
    behind = F.shiftright("side", 8)
    sides = first.withColumns({"before": before, "behind": behind}).repartition("hash")
    alike = {
        f"{c}_alike": (F.col(c) > 0) & (F.count(F.lit(1)).over(Window.partitionBy("hash", c)) > 1)
        for c in ("before", "behind")
    }
    wanted = (
        sides.withColumns(alike)
        .where("before_alike OR behind_alike")
        .select(
            "doc_id",
            F.struct(
                "hash", "context", F.col("before_alike").alias("before"), F.col("behind_alike").alias("behind")
            ).alias("w"),
        )
        .groupBy("doc_id")
        .agg(F.collect_set("w").alias("wanted"))
        .select("doc_id", *(F.col(f"wanted.{c}").alias(c) for c in ("hash", "context", "before", "behind")))
    )
    contexts = (
        _packed(rows)
        .join(wanted, "doc_id")
        .select("doc_id", "packed", "context", "before", "behind")
        .mapInArrow(
            partial(_cut_out, length=length),
            "hash long, context long, doc_id long, shift long, anchor long, text binary",
        )
        .repartition("hash")
        .sortWithinPartitions("hash", "context")
    )
    sorted_ = stage(
        contexts.mapInArrow(
            partial(_equal_windows, length=length, most=batch),
            "doc_id long, context long, windows long, least long, wa long, wb long",
        ),
        "windows",
    )
    settled = sorted_.where("wa IS NULL").select("doc_id", "context", "windows")
    cut = sorted_.where("wa IS NOT NULL")
    least = cut.groupBy("wa", "wb").agg(F.min("least").alias("earliest"))
    across = (
        cut.join(least, ["wa", "wb"])
        .where("earliest < doc_id")
        .groupBy("doc_id", "context")
        .agg(F.bit_or("windows").alias("windows"))
    )
    return settled.unionByName(across)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    packer = zstandard.ZstdCompressor(level=3)
    for part in records(batches):
        packed = [packer.compress(t) for t in texts(part.column(1))]
        yield pa.record_batch([part.column(0), pa.array(packed, pa.binary())], ["doc_id", "packed"])


def _unpacked(array: pa.Array) -> list[bytes]:
    unpacker = zstandard.ZstdDecompressor()
    return [unpacker.decompress(p) for p in array.to_pylist()]


def _contexts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """One row per document and distinct context."""
    names = ["hash", "context", "doc_id", "side"]
    for part in records(batches):
        ids = part.column(0).to_numpy(zero_copy_only=False)
        whole = texts(part.column(1))
        for block in _blocks([len(t) for t in whole]):
            found = Anchors(whole[block], length)
            order = np.lexsort((found.context, found.document))
            context, document = found.context[order], found.document[order]
            new = np.ones(len(order), bool)
            new[1:] = (context[1:] != context[:-1]) | (document[1:] != document[:-1])
            chosen = order[new]
            columns = [
                found.hash[chosen].view(np.int64),
                found.context[chosen].view(np.int64),
                ids[block][found.document[chosen]],
                found.side[chosen].astype(np.int16),
            ]
            yield pa.record_batch([pa.array(c) for c in columns], names)


def _cut_out(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """The texts of the contexts wanted, cut to the windows with the side on which they have a like."""
    names = ["hash", "context", "doc_id", "shift", "anchor", "text"]
    for part in records(batches):
        whole = _unpacked(part.column(1))
        ids = part.column(0).to_pylist()
        wanted = [part.column(k).to_pylist() for k in (2, 3, 4)]
        for block in _blocks([len(t) for t in whole]):
            found = Anchors(whole[block], length)
            made = []
            bounds = np.searchsorted(found.document, np.arange(block.stop - block.start + 1))
            for k, row in enumerate(range(block.start, block.stop)):
                here = slice(bounds[k], bounds[k + 1])
                place = {c: i for i, c in enumerate(found.context[here].view(np.int64).tolist(), bounds[k])}
                for context, before, behind in zip(*(w[row] for w in wanted)):
                    i = place.get(context)
                    if i is None:
                        continue  # another row of the same id has it
                    start, end, anchor = int(found.start[i]), int(found.end[i]), int(found.anchor[i])
                    cut = start
                    if not before:  # only windows that reach behind the anchor
                        cut = max(start, anchor + 2 * GRAM - length)
                    if not behind:  # only windows that reach before it
                        end = min(end, anchor - GRAM + length)
                    if end - cut >= length:
                        key = int(found.hash[i].view(np.int64))
                        text = found.text[cut:end]
                        made.append((key, context, ids[row], cut - start, anchor - cut, text))
            if made:
                yield pa.record_batch(
                    [pa.array(c, pa.binary() if n == "text" else pa.int64()) for c, n in zip(zip(*made), names)],
                    names,
                )


def _equal_windows(
    batches: Iterator[pa.RecordBatch], length: int, most: int
) -> Iterator[pa.RecordBatch]:
    """Batches of whole anchors, or parts of one too large, and the windows their contexts share."""
    held: list[Entry] = []
    group: list[tuple] = []  # the contexts of the present anchor
    size = group_size = 0
    cut = False
    present = last = None

    def whole() -> Iterator[pa.RecordBatch]:
        nonlocal held, size
        if held:
            yield from _shared_windows(held, length, False)
        held, size = [], 0

    def finished() -> Iterator[pa.RecordBatch]:
        """The present anchor is complete."""
        nonlocal size
        entries = _untrimmed(group) if cut else _trimmed(group, length) if len(group) > 1 else []
        total = sum(len(text) for text, _ in entries)
        if cut or total > PARTS * most:
            yield from parts(entries)
        else:
            held.extend(entries)
            size += total
            if size > most:
                yield from whole()

    def parts(entries: list[Entry]) -> Iterator[pa.RecordBatch]:
        part, total = [], 0
        for entry in entries:
            part.append(entry)
            total += len(entry[0])
            if total > most:
                yield from _shared_windows(part, length, True)
                part, total = [], 0
        if part:
            yield from _shared_windows(part, length, True)

    for batch in records(batches):
        for hash_, context, *rest in zip(*(batch.column(k).to_pylist() for k in range(6))):
            if (hash_, context) == last:
                continue  # from a repeated row
            last = (hash_, context)
            if hash_ != present:
                yield from finished()
                present, group, group_size, cut = hash_, [], 0, False
            elif group_size > PARTS**2 * most:
                cut = True
                yield from parts(_untrimmed(group))
                group, group_size = [], 0
            group.append((context, *rest))
            group_size += len(rest[-1])
    yield from finished()
    yield from whole()


def _untrimmed(contexts: list[tuple]) -> list[Entry]:
    return [(text, [(context, doc_id, shift)]) for context, doc_id, shift, _, text in contexts]


def _trimmed(contexts: list[tuple], length: int) -> list[Entry]:
    """Contexts of one anchor, cut to what each has in common with another on either side of it.

    Sorted by what stands behind the anchor, a context's nearest neighbour shares most of that; sorted by
    what stands before it, backwards, likewise. What becomes equal is one text.
    """
    ats = [at for _, _, _, at, _ in contexts]
    texts_ = [text for *_, text in contexts]
    before = _longest_common([t[:at][::-1] for at, t in zip(ats, texts_)], length)
    behind = _longest_common([t[at + GRAM :] for at, t in zip(ats, texts_)], length)
    entries: dict[bytes, list] = {}
    for (context, doc_id, shift, at, text), left, right in zip(contexts, before, behind):
        if left + GRAM + right >= length:
            cut = text[at - left : at + GRAM + right]
            entries.setdefault(cut, []).append((context, doc_id, shift + at - left))
    return list(entries.items())


def _longest_common(strings: list[bytes], length: int) -> list[int]:
    """For each string the length of its longest common prefix with another one."""
    numbers = [int.from_bytes(s.ljust(length, b"\0"), "big") for s in strings]
    order = sorted(range(len(strings)), key=numbers.__getitem__)
    longest = [0] * len(strings)
    for i, j in zip(order, order[1:]):
        equal = length - ((numbers[i] ^ numbers[j]).bit_length() + 7) // 8
        equal = min(equal, len(strings[i]), len(strings[j]))
        longest[i] = max(longest[i], equal)
        longest[j] = equal
    return longest


def _shared_windows(entries: list[Entry], length: int, cut: bool) -> Iterator[pa.RecordBatch]:
    """The suffix array of some texts, and its runs of suffixes that share ``length`` bytes.

    Where a part of an anchor is ``cut`` off from others, the first document of a run is not known to
    be the first of all, so the run's hash goes along with it.
    """
    parts = [text for text, _ in entries]
    sizes = np.array([len(p) for p in parts])
    # symbols: 0 ends the whole, 1 ends a text, and a byte is two more than its value
    begin = np.cumsum(sizes + 1) - sizes - 1
    data = np.frombuffer(b"\0".join(parts) + b"\0", np.uint8)
    symbols = data.astype(np.int64) + 2
    symbols[begin + sizes] = 1
    order = np.array(suffix_array([*symbols.tolist(), 0]))[1:]
    owner = np.repeat(np.arange(len(parts)), sizes + 1)
    order = order[order - begin[owner[order]] + length <= sizes[owner[order]]]
    words = np.lib.stride_tricks.sliding_window_view(np.append(data, np.zeros(8, np.uint8)), 8)
    words = np.ascontiguousarray(words).view("<u8")[:, 0]
    steps = [*range(0, length - 8, 8), length - 8]
    equal = np.ones(len(order) - 1, bool)
    for step in steps:
        here = words[order + step]
        equal &= here[1:] == here[:-1]
    new = np.append(True, ~equal)
    first = np.array([min(doc_id for _, doc_id, _ in members) for _, members in entries])
    least = np.minimum.reduceat(first[owner[order]], np.flatnonzero(new))[np.cumsum(new) - 1]
    earliest = np.zeros(len(data), np.int64)  # of each window, by where it begins
    earliest[order] = least
    found, open_ = [], []
    for k, (text, members) in enumerate(entries):
        windows = earliest[begin[k] : begin[k] + len(text) - length + 1].tolist()
        low, high, all_ = min(windows), max(windows), (1 << len(windows)) - 1
        for context, doc_id, shift in members:
            if doc_id > high:
                found.append((doc_id, context, all_ << shift))
            elif doc_id > low:
                bits = sum(1 << j for j, w in enumerate(windows) if w < doc_id)
                found.append((doc_id, context, bits << shift))
            if cut and doc_id <= high:
                at = int(begin[k])
                open_ += [
                    (doc_id, context, 1 << (j + shift), w, at + j) for j, w in enumerate(windows) if w == doc_id
                ]
    names = ["doc_id", "context", "windows", "least", "wa", "wb"]
    if found:
        columns = [pa.array(c, pa.int64()) for c in zip(*found)]
        yield pa.record_batch([*columns, *[pa.nulls(len(found), pa.int64())] * 3], names)
    if open_:
        *columns, at = zip(*open_)
        at, keys = np.array(at), []
        for seed in (1, 2):
            key = np.full(len(at), seed, np.uint64)
            for step in steps:
                key = (key ^ words[at + step]) * MIX[seed]
                key ^= key >> np.uint64(29)
            keys.append(pa.array((key * MIX[0]).view(np.int64)))
        yield pa.record_batch([*(pa.array(c, pa.int64()) for c in columns), *keys], names)


def _kept(
    batches: Iterator[pa.RecordBatch], length: int, texts_too: bool
) -> Iterator[pa.RecordBatch]:
    """What remains of each document once the windows found are dropped."""
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
         ("kept_sha256", pa.string()), ("kept", pa.binary())]
    )
    for part in records(batches, 128):
        ids, contexts, windows = (part.column(k).to_pylist() for k in (0, 2, 3))
        whole = _unpacked(part.column(1))
        results = [(text, 0, 0) for text in whole]
        concerned = [k for k, c in enumerate(contexts) if c]
        for block in _blocks([len(whole[k]) for k in concerned]):
            some = concerned[block]
            lost = [_added(contexts[k], windows[k]) for k in some]
            for k, result in zip(some, _without([whole[k] for k in some], lost, length)):
                results[k] = result
        out = [
            (i, len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept if texts_too else None)
            for i, text, (kept, removed, spans) in zip(ids, whole, results)
        ]
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema)


def _added(contexts: list[int], windows: list[int]) -> dict[int, int]:
    bits: dict[int, int] = {}
    for context, window in zip(contexts, windows):
        bits[context] = bits.get(context, 0) | window
    return bits


def _without(
    parts: list[bytes], lost: list[dict[int, int]], length: int
) -> list[tuple[bytes, int, int]]:
    """(what is kept, bytes removed, runs removed) of texts, given the windows lost of each context."""
    found = Anchors(parts, length)
    contexts = found.context.view(np.int64).tolist()
    documents = found.document.tolist()
    going = np.array([lost[d].get(c, 0) for d, c in zip(documents, contexts)], np.int64)
    turn = np.arange(found.windows.sum()) - np.repeat(np.cumsum(found.windows) - found.windows, found.windows)
    hit = (np.repeat(going, found.windows) >> turn) & 1 == 1
    starts = _ranges(found.start, found.windows)[hit]
    change = np.zeros(len(found.text) + 1, np.int8)
    change[starts] += 1
    change[starts + length] -= 1
    gone = np.cumsum(change[:-1], dtype=np.int32) > 0
    data = np.frombuffer(found.text, np.uint8)
    out = []
    for begin, part in zip(found.begin.tolist(), parts):
        here = gone[begin : begin + len(part)]
        spans = int(np.count_nonzero(here[1:] & ~here[:-1])) + int(len(here) > 0 and here[0])
        kept = data[begin : begin + len(part)][~here].tobytes()
        out.append((kept, int(np.count_nonzero(here)), spans))
    return out
