"""Bounded-space online packing of token ids into windows.

Each partition keeps a fixed number of open windows.  A document is cut into
full windows as long as it fills them; its rest goes into the open window with
the least room that still holds it (best fit), into a new one while there are
fewer than the fixed number, or else the fullest open window is emitted and a
new one takes its place.  The windows still open at the end of a partition are
merged: those of FAN_IN partitions are packed again in the same way, and so on;
at the top the remaining ids are laid end to end, full windows first, the last
few ids as sequences whose lengths are powers of two, which need no padding.

Memory: a batch of texts, the open windows and a bounded cache of word ids.
The text is read once and not shuffled; what moves is the open windows.

Edge cases.  NULL and empty texts are the end id alone.  A very long text fills
window after window, and its words are encoded some MB at a time.  Of open
windows with equal room the one opened first is taken.  Repeated rows are packed
each.  An empty table gives an empty result.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Scratch
from .streams import arrow_groups

WINDOW = 4096
END_ID = 2
OPEN_WINDOWS = 64
FAN_IN = 32
CACHE_WORDS = 900_000
BATCH_BYTES = 2 << 20

ASCII_PUNCTUATION = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
JOINED_WORDS = 200


def _slices(values: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """values[start:start + size] of every pair, end to end."""
    end = np.cumsum(size)
    return values[np.repeat(start - end + size, size) + np.arange(end[-1] if len(end) else 0)]


class WordEncoder:
    """Ids of texts by a word-level BPE file, remembered word by word.

    The tokenizer drops white space and never joins across it, so the ids of a
    text are those of its words; Arrow cuts the texts and numbers the words of
    a batch, and only words not met before are tokenized.  ASCII letters are
    lower-cased first, as the tokenizer does.  Punctuation after an ASCII
    letter, up to the word's end, is always a token of its own.  Words of
    letters are one unit to the tokenizer, so many are given to it in one text
    and told apart by the end-of-word mark.  Texts that may hold a special
    token's string are given to the tokenizer whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.place: dict[str, int] = {"": 0}
        self.ids = np.empty(1 << 16, np.uint32)
        self.start = np.zeros(1 << 14, np.int64)
        self.used, self.known = 0, 1

    def _tokens(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words and punctuation runs, end to end, and how many each has."""
        plain = np.fromiter((u.isalpha() for u in units), bool, len(units))
        letters = [u for u, p in zip(units, plain) if p]
        groups = [letters[k:k + JOINED_WORDS] for k in range(0, len(letters), JOINED_WORDS)]
        flat, size = [], []
        for group in groups:  # one at a time: what the tokenizer returns is many times the ids
            ids = np.array(self.tokenizer.encode(" ".join(group), add_special_tokens=False).ids, np.uint32)
            last = np.flatnonzero(self.ends_word[ids])
            if len(last) != len(group):  # normalising has made more than letters of some word
                own = [e.ids for e in self.tokenizer.encode_batch(group, add_special_tokens=False)]
                ids, last = np.array([i for x in own for i in x], np.uint32), np.cumsum([len(x) for x in own]) - 1
            flat.append(ids)
            size.append(np.diff(last, prepend=-1))
        others = [e.ids for e in self.tokenizer.encode_batch([u for u, p in zip(units, plain) if not p], add_special_tokens=False)]
        flat.append(np.array([i for x in others for i in x], np.uint32))
        size.append(np.array([len(x) for x in others], np.int64))
        # back into the order of the units
        ids, size = np.concatenate(flat), np.concatenate(size)
        order = np.argsort(np.concatenate((np.flatnonzero(plain), np.flatnonzero(~plain))))
        start = np.cumsum(size) - size
        return _slices(ids, start[order], size[order]), size[order]

    def _learn(self, words: list[str]) -> None:
        """A word is its letters' ids and those of the punctuation after them."""
        number: dict[str, int] = {"": 0}
        parts = np.empty((len(words), 2), np.int64)
        for k, word in enumerate(words):
            stem = word.rstrip(ASCII_PUNCTUATION)
            if stem == word or not (stem[-1:].isascii() and stem[-1:].isalpha()):
                parts[k] = number.setdefault(word, len(number)), 0
            else:
                parts[k] = number.setdefault(stem, len(number)), number.setdefault(word[len(stem):], len(number))
        ids, length = self._tokens(list(number)[1:])
        length = np.concatenate(([0], length))
        pieces = parts.ravel()
        flat = _slices(ids, (np.cumsum(length) - length)[pieces], length[pieces])
        while self.used + len(flat) > len(self.ids):
            self.ids = np.concatenate((self.ids, np.empty_like(self.ids)))
        while self.known + len(words) + 1 > len(self.start):
            self.start = np.concatenate((self.start, np.zeros_like(self.start)))
        self.ids[self.used:self.used + len(flat)] = flat
        self.start[self.known + 1:self.known + 1 + len(words)] = self.used + np.cumsum(length[parts].sum(axis=1))
        self.place.update(zip(words, range(self.known, self.known + len(words))))
        self.known += len(words)
        self.used += len(flat)

    def encode(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        if self.known > CACHE_WORDS:
            self._clear()
        texts = pc.fill_null(texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string()), "")
        marked = pc.match_substring(texts, "<|")
        special = {n: np.array(self.tokenizer.encode(texts[n].as_py(), add_special_tokens=False).ids, np.uint32)
                   for n in np.flatnonzero(marked.to_numpy(zero_copy_only=False)).tolist()}
        plain = pc.if_else(marked, "", texts) if special else texts
        cut = pc.ascii_split_whitespace(pc.ascii_lower(plain))
        words = cut.flatten().dictionary_encode()
        own = words.dictionary.to_pylist()
        place = np.fromiter((self.place.get(w, -1) for w in own), np.int64, len(own))
        missing = np.flatnonzero(place < 0)
        if len(missing):
            self._learn([own[k] for k in missing])
            place[missing] = [self.place[own[k]] for k in missing]
        at = place[words.indices.to_numpy()]
        low = self.start[at]
        size = self.start[at + 1] - low
        end = np.cumsum(size)
        flat = _slices(self.ids, low, size)
        cuts = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(pc.list_value_length(cut).to_numpy())))]
        return [special.get(n, flat[a:b]) for n, (a, b) in enumerate(zip(cuts[:-1], cuts[1:]))]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


SCHEMA = [("sequence_id", pa.int64()), ("offset", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
          ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()), ("open", pa.bool_()), ("bin", pa.int64()), ("ids", pa.binary())]


class Packer:
    """The windows of one task.  A piece is (doc, start, ids, doc_tokens)."""

    def __init__(self, first_id: int, window: int, most_open: int, with_ids: bool, bin_no: int):
        self.next_id, self.window, self.most, self.with_ids, self.bin = first_id, window, most_open, with_ids, bin_no
        self.held: list[list[tuple]] = []
        self.room = np.full(most_open, np.iinfo(np.int64).max)
        self.rows: list[tuple] = []

    def emit(self, pieces: list[tuple], is_open: bool = False) -> None:
        offset = 0
        for doc, start, ids, total in pieces:
            data = np.ascontiguousarray(ids, "<u4").tobytes()
            self.rows.append((doc, self.next_id, offset, start, len(ids), zlib.crc32(data), total, is_open, self.bin,
                              data if is_open or self.with_ids else None))
            offset += len(ids)
        self.next_id += 1

    def add(self, doc, start: int, ids: np.ndarray, total: int) -> None:
        while len(ids) >= self.window:
            self.emit([(doc, start, ids[:self.window], total)])
            start, ids = start + self.window, ids[self.window:]
        if not len(ids):
            return
        piece, n = (doc, start, ids, total), len(ids)
        room = self.room[:len(self.held)]
        fits = np.flatnonzero(room >= n)
        if len(fits):
            k = int(fits[room[fits].argmin()])
            self.held[k].append(piece)
            self.room[k] -= n
            if not self.room[k]:
                self.emit(self.held[k])
                last = len(self.held) - 1
                self.held[k], self.room[k] = self.held[last], self.room[last]
                self.held.pop()
            return
        if len(self.held) < self.most:
            self.held.append([piece])
            self.room[len(self.held) - 1] = self.window - n
            return
        k = int(room.argmin())
        self.emit(self.held[k])
        self.held[k], self.room[k] = [piece], self.window - n

    def leave_open(self) -> None:
        for pieces in self.held:
            self.emit(pieces, True)
        self.held = []

    def lay_out(self) -> None:
        """Everything held, end to end: full windows, then powers of two."""
        queue = [p for pieces in self.held for p in pieces]
        self.held = []
        left = sum(len(p[2]) for p in queue)
        queue.reverse()
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left -= size
            own = []
            while size:
                doc, start, ids, total = queue.pop()
                if len(ids) > size:
                    queue.append((doc, start + size, ids[size:], total))
                    ids = ids[:size]
                own.append((doc, start, ids, total))
                size -= len(ids)
            self.emit(own)

    def batch(self, doc_type: pa.DataType) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [()] * (len(SCHEMA) + 1)
        self.rows = []
        arrays = [pa.array(columns[0], doc_type)] + [pa.array(c, t) for c, (_, t) in zip(columns[1:], SCHEMA)]
        return pa.RecordBatch.from_arrays(arrays, ["doc_id", *(n for n, _ in SCHEMA)])


def _first_pass(path: str, window: int, end_id: int, most_open: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        packer = Packer(task << 32, window, most_open, with_ids, task)
        encode, kind = encoder(path).encode, pa.int64()
        for batch in batches:
            kind = batch.column("doc_id").type
            size = np.cumsum(pc.fill_null(pc.binary_length(batch.column("_t")), 0).to_numpy())
            low = 0
            while low < batch.num_rows:  # texts of BATCH_BYTES together, or one longer text
                done = size[low - 1] if low else 0
                high = max(low + 1, int(np.searchsorted(size, done + BATCH_BYTES, "right")))
                part = batch.slice(low, high - low)
                for doc, ids in zip(part.column("doc_id").to_pylist(), encode(part.column("_t"))):
                    ids = np.append(ids, np.uint32(end_id))
                    packer.add(doc, 0, ids, len(ids))
                low = high
                if packer.rows:
                    yield packer.batch(kind)
            pa.default_memory_pool().release_unused()
        packer.leave_open()
        if packer.rows:
            yield packer.batch(kind)
    return run


def _merge_pass(level: int, last: bool, window: int, most_open: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in arrow_groups(batches, "bin"):
            kind, bin_no = group.column("doc_id").type, group.column("bin")[0].as_py()
            packer = Packer((level << 56) | (bin_no << 32), window, most_open, with_ids, bin_no)
            pieces = [(doc, start, np.frombuffer(ids, "<u4"), total) for doc, start, ids, total in zip(
                *(group.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")))]
            if last:
                packer.held = [[p] for p in pieces]
                packer.lay_out()
            else:
                for piece in sorted(pieces, key=lambda p: -len(p[2])):
                    packer.add(*piece)
                packer.leave_open()
            if packer.rows:
                yield packer.batch(kind)
    return run


def pack_documents(docs: DataFrame, scratch: Scratch, path: str, id_col: str = "doc_id", text_col: str = "text",
                   window: int = WINDOW, end_id: int = END_ID, open_windows: int = OPEN_WINDOWS,
                   with_ids: bool = True) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset, and ids (little-endian unsigned 32 bits) if asked for.

    A document is its text's ids and end_id; NULL and empty texts are end_id
    alone.  Each id lies in one piece.  Rows are packed one by one, repeated
    ones too; doc_id may be NULL.  An empty table gives no pieces.  Sequences
    hold at most `window` ids; the window is a power of two.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("_t"))
    kinds = {pa.int64(): T.LongType(), pa.bool_(): T.BooleanType(), pa.binary(): T.BinaryType()}
    schema = T.StructType([T.StructField("doc_id", source.schema["doc_id"].dataType),
                           *(T.StructField(n, kinds[t]) for n, t in SCHEMA)])
    step = scratch.table(source.mapInArrow(_first_pass(path, window, end_id, open_windows, with_ids), schema), "packed")
    done, level = [], 0
    while True:
        done.append(step.where("not open"))
        most = step.where("open").agg(F.max("bin")).first()[0]
        if most is None:
            break
        level += 1
        bins = most // FAN_IN + 1
        left = step.where("open").withColumn("bin", F.floor(F.col("bin") / FAN_IN))
        left = left.repartition(F.col("bin")).sortWithinPartitions("bin", "sequence_id", "offset")
        step = scratch.table(left.mapInArrow(_merge_pass(level, bins == 1, window, open_windows, with_ids), schema), f"merge{level}")
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", *["ids"] * with_ids)
