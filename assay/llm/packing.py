"""Packing documents into training sequences by order-preserving dynamic programming.

The token ids of the documents form one stream per task, in the order of the rows. Windows of at most
``window`` ids are cut from it so that padding plus penalties for cuts is least: nothing for a cut
between documents, a little behind a sentence, more elsewhere. With f(j) the least cost up to cut j,

    f(j) = penalty(j) + min over cuts i within one window of  f(i) + window - (pos_j - pos_i),

a sliding minimum of f(i) + pos_i kept in a monotone queue. A window whose length is a power of two is
not padded, which adds a few transitions looked up by position.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from assay.llm.common import kept, prepare, records

WINDOW = 4096
END_ID = 2
SENTENCE_CUT, OTHER_CUT, PER_SEQUENCE = 4, 12, 16
# Without a sentence end for so long, other places may be cut.
LONGEST_GAP = 48
UNPADDED = (2048, 1024, 512)  # lengths of windows looked up as powers of two
BUFFER = 1 << 19  # ids planned at once
CACHED_WORDS = 600_000
TOGETHER = 64  # words encoded as one text
# Of the sentence ends within so many ids, one is a place to cut.
GRAIN = 8

SCHEMA = (
    "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, "
    "offset long"
)


def default_tokenizer() -> str:
    return str(public_tokenizers.path("word_bpe_49k.json"))


def _latin(keep: Callable[[str], bool]) -> bytes:
    return bytes(c for c in range(256) if keep(chr(c)))


# Lower case and one kind of separator within Latin-1, where both change characters one by one.
_LATIN_LOWER = bytes(
    32 if c == 10 else ord(low) if ord(low := chr(c).lower()) < 256 else c for c in range(256)
)
_WORD = _latin(lambda c: c.isalpha() or c.isdigit())
_PLAIN = _WORD + b" .,"
_DOUBLED = (b"..", b".,", b",.", b",,")
_JOINED = re.compile(rb"[^ " + re.escape(_WORD) + rb"][.,](?: |$)")
# Letters and signs behind them; an apostrophe may belong to either.
_SIGNED = re.compile(rb"([" + _latin(str.isalpha) + rb"]+)([!-&(-/:-@\[-`{-~]+)")


class Encoder:
    """Token ids of texts. The tokenizer splits at white space, so ids are cached by word.

    Words are what lies between spaces and line ends; other white space stays inside a word and is
    left to the tokenizer. It also lower-cases, and parts letters and digits from other signs: a word
    of a Latin-1 text is looked up in lower case, and without the comma or full stop behind it unless
    that belongs to a run of signs.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.cache: dict[bytes | str, bytes] = {"": b"", b"": b""}
        self.older: dict[bytes | str, bytes] = {}
        ends = (".", "!", "?", "\u3002", "\uff01", "\uff1f")
        size = self.tokenizer.get_vocab_size()
        names = [self.tokenizer.id_to_token(k) or "" for k in range(size)]
        self.word_end = np.fromiter((x.endswith("</w>") for x in names), bool, size)
        self.sentence_end = np.fromiter(
            (x.removesuffix("</w>").endswith(ends) for x in names), bool, size
        )

    @staticmethod
    def words(text: str) -> list[bytes] | list[str]:
        if "<|" in text:  # may hold a special token, which is matched as it stands
            return text.replace("\n", " ").split(" ")
        try:
            raw = text.encode("latin-1").translate(_LATIN_LOWER)
        except UnicodeEncodeError:
            return text.replace("\n", " ").split(" ")
        signs = raw.translate(None, _PLAIN) or any(x in raw for x in _DOUBLED)
        if not signs or not _JOINED.search(raw):
            raw = (raw + b" ").replace(b", ", b" , ").replace(b". ", b" . ")
        return raw.split(b" ")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        split = list(map(self.words, texts))
        get, encoded, holes = self.cache.get, [], []
        for ws in split:  # one look at each word; only where one is new a second
            found = list(map(get, ws))
            try:
                encoded.append(b"".join(found))
            except TypeError:
                holes.append((len(encoded), ws, found))
                encoded.append(b"")
        if holes:
            self._add({w for _, ws, found in holes for w, ids in zip(ws, found) if ids is None})
            cache = self.cache
            for k, ws, found in holes:
                ids = [cache[w] if old is None else old for w, old in zip(ws, found)]
                encoded[k] = b"".join(ids)
        return [np.frombuffer(ids, "<u4") for ids in encoded]

    def _add(self, new: set[bytes | str]) -> None:
        """Put words into the cache, from the one before it if they are there."""
        if len(self.cache) + len(new) > CACHED_WORDS // 2:
            self.older, self.cache = self.cache, {"": b"", b"": b""}
        older = self.older
        self.cache.update({w: older[w] for w in new if w in older})  # still in use
        new = new.difference(self.cache)  # which looks words up; ``-`` would walk the cache
        letters = [w for w in new if isinstance(w, bytes) and w.decode("latin-1").isalpha()]
        self._learn(letters, TOGETHER)
        # the tokenizer parts letters and signs, whatever stands on the other side
        parted = {w: m for w in new if isinstance(w, bytes) and (m := _SIGNED.fullmatch(w))}
        self._learn([*{m[1] for m in parted.values()}.difference(self.cache)], TOGETHER)
        self._learn([*{m[2] for m in parted.values()}.difference(self.cache)], 1)
        for word, m in parted.items():
            if m[1] in self.cache:
                self.cache[word] = self.cache[m[1]] + self.cache[m[2]]
        self._learn([w for w in new if w not in self.cache], 1)

    def _learn(self, new: list[bytes | str], together: int) -> None:
        """Cache the ids of words, ``together`` of them encoded as one text. Words of letters alone
        end in their one token that ends a word; where that does not hold they are left out."""
        plain = [w if isinstance(w, str) else w.decode("latin-1") for w in new]
        joined = [" ".join(plain[k : k + together]) for k in range(0, len(plain), together)]
        encoded = self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)
        if together == 1:
            for word, found in zip(new, encoded, strict=True):
                self.cache[word] = np.array(found.ids, "<u4").tobytes()
            return
        ids = np.fromiter((k for found in encoded for k in found.ids), "<u4")
        ends = np.flatnonzero(self.word_end[ids]) + 1
        if len(ends) == len(new):
            raw, bounds = ids.tobytes(), [0, *(ends * 4).tolist()]
            for k, word in enumerate(new):
                self.cache[word] = raw[bounds[k] : bounds[k + 1]]


def encoder_of(path: str) -> Encoder:
    """The worker's encoder: its words serve the worker's later tasks too."""
    return kept(f"encoder {path}", lambda: Encoder(path))


def plan(
    ends: np.ndarray, sentence_ends: np.ndarray, total: int, final: bool, window: int = WINDOW
) -> list[int]:
    """Where to cut a stream of ``total`` ids: increasing positions, each at most a window on.

    ``ends`` are the ends of documents, ``sentence_ends`` of sentences. The last cut is ``total`` if
    ``final``, and otherwise the best one within the last window.
    """
    last = np.flatnonzero(np.diff(sentence_ends // GRAIN, append=-1))
    sentence_ends = sentence_ends[last]
    kind = np.zeros(total + 1, np.uint8)  # of each position: 1 a cut, 2 of a sentence, 3 of a document
    kind[[0, total]] = 1
    kind[sentence_ends] = 2
    kind[ends] = 3
    cuts = np.flatnonzero(kind)
    gaps = np.diff(cuts)
    for k in np.flatnonzero(gaps > LONGEST_GAP):
        kind[cuts[k] + LONGEST_GAP : cuts[k + 1] : LONGEST_GAP] = 1
    cuts = np.flatnonzero(kind)
    penalty = np.array([OTHER_CUT, OTHER_CUT, SENTENCE_CUT, 0], np.int64)[kind[cuts]]
    penalty[-1] = 0 if final else penalty[-1]
    exact: dict[int, list[int]] = {}
    for length in UNPADDED:
        at = np.searchsorted(cuts, cuts - length)
        for j in np.flatnonzero((cuts >= length) & (cuts[at] == cuts - length)):
            exact.setdefault(int(j), []).append(int(at[j]))

    pos, pen = cuts.tolist(), (penalty + PER_SEQUENCE).tolist()
    cost, back = [0], [0]
    # the monotone queue from ``head`` on: f(i) + pos_i, increasing, with pos_i and i
    values, places, indices, head = [0], [0], [0], 0
    for j in range(1, len(pos)):
        here = pos[j]
        far = here - window
        while places[head] < far:
            head += 1
        best, i = values[head] - far, indices[head]
        if j in exact:
            for k in exact[j]:
                if cost[k] < best:
                    best, i = cost[k], k
        best += pen[j]
        cost.append(best)
        back.append(i)
        best += here
        while len(values) > head and values[-1] >= best:
            values.pop()
            places.pop()
            indices.pop()
        values.append(best)
        places.append(here)
        indices.append(j)
    first = np.searchsorted(cuts, total - window)
    tail: list[int] = []
    if final:
        j, best = len(pos) - 1, cost[-1]
        for i in range(first, len(pos) - 1):  # the last window in powers of two, without padding
            split = cost[i] + OTHER_CUT * (int(total - pos[i]).bit_count() - 1) + PER_SEQUENCE
            if split < best:
                best, j = split, i
        if j < len(pos) - 1:
            rest, at = total - pos[j], pos[j]
            for bit in reversed(range(rest.bit_length())):
                if rest >> bit & 1:
                    at += 1 << bit
                    tail.append(at)
    else:
        first = max(first, 1)
        j = first + int(np.argmin(cost[first:]))
    path = []
    while j:
        path.append(pos[j])
        j = back[j]
    return path[::-1] + tail


def pack(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    tokenizer: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """One row for each piece of a document in a sequence; no shuffle, one stream per task.

    ``ids`` holds the piece's ids as little-endian unsigned 32-bit numbers; ``start`` counts ids of
    the document before it, ``offset`` ids of the sequence before it. Each document ends with
    ``end_id``; a null or empty text is that id alone. Repeated rows and keys are packed like any
    other, null keys stay null, other columns are not read, an empty table gives no rows. A task's
    sequences depend only on its own rows, so a task that is repeated replaces its own sequences.
    """
    prepare(docs.sparkSession)
    path = tokenizer or default_tokenizer()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, sequence = encoder_of(path), TaskContext.get().partitionId() << 40
        held: list[tuple[int | None, int, np.ndarray]] = []  # key, ids before, ids from there on
        size = 0
        for batch in records(batches, 128, f"encoder {path}"):
            values = [x or "" for x in batch.column(1).to_pylist()]
            for name, ids in zip(batch.column(0).to_pylist(), encoder.encode(values), strict=True):
                held.append((name, 0, np.append(ids, np.uint32(end_id)).astype("<u4")))
                size += len(ids) + 1
            if size >= BUFFER:
                pieces, held, sequence = _cut(held, encoder.sentence_end, sequence, False)
                size = sum(len(ids) for _, _, ids in held)
                yield pieces
        if held:
            yield _cut(held, encoder.sentence_end, sequence, True)[0]

    return docs.select(F.col(key).cast("long"), text).mapInArrow(run, SCHEMA)


def _cut(
    held: list[tuple[int | None, int, np.ndarray]], sentence_end: np.ndarray, sequence: int, final: bool
) -> tuple[pa.RecordBatch, list[tuple[int | None, int, np.ndarray]], int]:
    """Pieces of the held documents, what is left of them, and the next sequence's number."""
    stream = np.concatenate([ids for _, _, ids in held])
    ends = np.cumsum([len(ids) for _, _, ids in held])
    sentences = np.flatnonzero(sentence_end[np.minimum(stream, len(sentence_end) - 1)]) + 1
    cuts = plan(ends, sentences, len(stream), final)
    bounds = np.union1d(np.concatenate([[0], ends, cuts]), [])
    bounds = bounds[bounds <= cuts[-1]].astype(np.int64)
    doc = np.searchsorted(ends, bounds[:-1], side="right")
    number = np.searchsorted(cuts, bounds[:-1], side="right")
    begins = np.concatenate([[0], cuts])
    rows = []
    for d, k, low, high in zip(doc.tolist(), number.tolist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        name, before, ids = held[d]
        at = low - (ends[d] - len(ids))
        piece = ids[at : at + high - low].tobytes()
        rows.append((name, before + at, high - low, piece, before + len(ids), sequence + k, low - begins[k]))
    columns = list(zip(*rows, strict=True))
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], names
    )
    left = []
    for d in range(int(np.searchsorted(ends, cuts[-1], side="right")), len(held)):
        name, before, ids = held[d]
        at = max(0, cuts[-1] - int(ends[d] - len(ids)))
        left.append((name, before + at, ids[at:]))
    return batch, left, sequence + len(cuts)
