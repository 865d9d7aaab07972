"""Packing token ids into sequences: bounded-space online best fit, leftovers merged in a second step."""

from __future__ import annotations

import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import stored, text_of

LENGTH, OPEN_WINDOWS, END_ID = 2048, 64, 1
#: Units whose ids a worker keeps: some 650 bytes each with their words.
KEPT_UNITS = 400_000
#: Leftover windows of so many partitions are merged by one task.
MERGED_PARTITIONS = 64
_SPACE = r"\t\n\x0b\x0c\r \x85\xa0  -     　"
_UNITS = re.compile(f"[^{_SPACE}]+")
_MARK = "\x01"
_STOPS = ".,;:!?"
_CONTROLS = "\x1c\x1d\x1e\x1f"
_LETTERS = "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
_LATIN = re.compile(f"[A-Za-z{_LETTERS}]+")


def _byte_name(byte: int) -> str:
    """The character that stands for a byte from 128 on in byte-level vocabularies."""
    return chr(byte + 162) if byte <= 160 else "\u0143" if byte == 173 else chr(byte)


class UnitEncoder:
    """Ids of whole texts from a tokenizers file that never joins characters over white space.

    Ids of white-space separated units are kept by unit, at most `limit` of them, and those of the words in
    them, at most twice as many. New words are encoded many at a time with a mark between them; units that
    hold the mark or a special token are encoded alone.
    """

    def __init__(self, path: str, limit: int):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.limit = limit
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = self.tokenizer.encode(_MARK, add_special_tokens=False).ids
        self.stops = {stop: self._encode(stop).tobytes() for stop in _STOPS}
        # Latin-1 letters as the model sees them: lower case and one character per byte. A file that does otherwise has none.
        self.as_bytes = {ord(c): "".join(map(_byte_name, c.encode())) for c in _LETTERS}
        self.latin = _LATIN.fullmatch
        for word in (*_LETTERS, _LETTERS, _LETTERS[::-1]):
            direct = [t.id for t in self.model.tokenize(word.lower().translate(self.as_bytes))]
            if direct != self._encode(word).tolist():
                self.latin = lambda word: None

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4")

    def learn(self, units: list[str]) -> None:
        """Keep the ids of new units; a word with a stop after it is made of the word's and the stop's."""
        known, words, stops, tokenize = self.known, self.words, self.stops, self.model.tokenize
        latin, as_bytes = self.latin, self.as_bytes
        if len(words) + len(units) > 2 * self.limit:
            words.clear()
        whole = " ".join(units)
        odd = [s for s in (_MARK, *self.special) if s in whole]
        late = []
        for unit in units:
            if odd and any(s in unit for s in odd):
                known[unit] = self._encode(unit).tobytes()
                continue
            # The file lower-cases; for ASCII that is the same here.
            plain = unit.isascii()
            word, stop = unit.lower() if plain else unit, ""
            # In lower case this letter ends in a mark of its own, which joins a stop behind it.
            if word[-1] in stops and (head := word[:-1]).isalpha() and head[-1] != "İ":
                word, stop = head, word[-1]
                letters = plain
            else:
                letters = plain and word.isalpha()
            if not plain and latin(word):
                word, letters = word.lower(), True
            ids = words.get(word)
            if ids is None:
                if not letters:
                    late.append((unit, word, stop))
                    continue
                # A word of letters is one unit of the file's model, which needs no other step for it.
                ids = words[word] = array("I", [t.id for t in tokenize(word if plain else word.translate(as_bytes))]).tobytes()
            known[unit] = ids + stops[stop] if stop else ids
        self._learn_words(sorted({word for _, word, _ in late}))
        for unit, word, stop in late:
            known[unit] = words[word] + stops[stop] if stop else words[word]

    def _learn_words(self, plain: list[str]) -> None:
        for at in range(0, len(plain), 4096):
            part = plain[at : at + 4096]
            ids = self._encode(f" {_MARK} ".join(part))
            cuts = np.flatnonzero(ids == self.mark[0])
            if len(self.mark) != 1 or len(cuts) != len(part) - 1:
                for unit in part:
                    self.words[unit] = self._encode(unit).tobytes()
                continue
            raw = ids.tobytes()
            starts, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            for unit, a, b in zip(part, starts, ends):
                self.words[unit] = raw[4 * a : 4 * b]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text."""
        # str.split() also splits at the four separator controls, which are no white space to the file.
        split = [_UNITS.findall(text) if any(c in text for c in _CONTROLS) else text.split() for text in texts]
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            new, last = set(), at
            while last < len(texts) and (last == at or len(new) < self.limit // 2):
                new |= set(split[last]).difference(self.known)
                last += 1
            if len(self.known) + len(new) > self.limit:
                self.known = {}
                new = set().union(*split[at:last])
            self.learn(list(new))
            known = self.known.__getitem__
            out += [b"".join(map(known, units)) for units in split[at:last]]
            at = last
        return out


_ENCODERS: dict[tuple[str, int], UnitEncoder] = {}


def encoder_for(path: str, limit: int) -> UnitEncoder:
    """One encoder a worker, file and limit."""
    if (path, limit) not in _ENCODERS:
        _ENCODERS[path, limit] = UnitEncoder(path, limit)
    return _ENCODERS[path, limit]


class Windows:
    """A fixed number of open windows; pieces go to the tightest room, else the fullest window is filled and emitted."""

    def __init__(self, length: int, limit: int, first: int):
        self.length, self.limit, self.next = length, limit, first
        self.rooms: list[tuple[int, int]] = []  # (room, window), sorted
        self.open: dict[int, list[tuple]] = {}

    def _new(self) -> int:
        self.next += 1
        return self.next - 1

    def whole(self) -> int:
        """The number of a window that is full at once."""
        return self._new()

    def add(self, size: int, cut: bool = True) -> list[tuple[int, int, int, list | None]]:
        """Places for a piece: (size, window, offset, nothing or the rows of a window that closes)."""
        out = []
        at = bisect_left(self.rooms, (size, -1))
        if at == len(self.rooms) and len(self.rooms) >= self.limit:
            room, window = self.rooms.pop(0)
            if cut and room:
                out.append((room, window, self.length - room, True))
                return out + self.add(size - room)
            out.append((0, window, 0, True))
            at = len(self.rooms)
        if at == len(self.rooms):
            room, window = self.length, self._new()
        else:
            room, window = self.rooms.pop(at)
        out.append((size, window, self.length - room, room == size))
        if room > size:
            insort(self.rooms, (room - size, window))
        return out


COLUMNS = "doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset"
_PIECES = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]
    + [("open", pa.bool_()), ("part", pa.int64()), ("ids", pa.binary())]
)


def pack_documents(docs: DataFrame, tokenizer: str, length: int = LENGTH, windows: int = OPEN_WINDOWS, with_ids: bool = False, kept: int = KEPT_UNITS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids if asked for.

    A document is its ids and the end id; a null or empty text is the end id alone, repeated rows are
    documents of their own, a null doc_id stays null, other columns are passed over. Full sequences are cut
    off a long document first. What remains goes to the open window of its partition with the tightest
    room; when none fits and `windows` are open, the head of the piece fills the fullest window, which is
    emitted, and its tail is placed again. The pieces of the windows left open at the end are packed again
    by best fit, first the largest, for 64 partitions at a time, so that no task gets more than a fixed
    number of windows. Sequence numbers name partition and window; offsets run from 0 without gaps. A worker keeps the ids
    of ``kept`` units beyond its task: fewer take less memory and more time, and change nothing else.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(tokenizer, kept)
        part = TaskContext.get().partitionId()
        state = Windows(length, windows, part << 32)
        waiting: dict[int, list[tuple]] = {}

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _PIECES)], schema=_PIECES)

        for batch in batches:
            ready = []
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for doc, raw in zip(doc_ids, encoder.encode(texts)):
                raw += END_ID.to_bytes(4, "little")
                n = len(raw) // 4

                def row(start: int, size: int, window: int, offset: int) -> tuple:
                    ids = raw[4 * start : 4 * (start + size)]
                    return (doc, start, size, zlib.crc32(ids), n, window, offset, False, part, ids if with_ids else None)

                at = 0
                while n - at >= length:
                    ready.append(row(at, length, state.whole(), 0))
                    at += length
                if at == n:
                    continue
                for size, window, offset, closed in state.add(n - at):
                    if size:
                        waiting.setdefault(window, []).append(row(at, size, window, offset))
                        at += size
                    if closed:
                        ready += waiting.pop(window)
            if ready:
                yield batch_of(ready)
        rest = [r[:7] + (True,) + r[8:] for rows in waiting.values() for r in rows]
        for i in range(0, len(rest), 10_000):
            yield batch_of(rest[i : i + 10_000])

    kinds = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"
    schema = f"{kinds}, open boolean, part bigint, ids binary"
    pieces = stored(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text")).mapInArrow(run, schema))
    names = [c.strip() for c in COLUMNS.split(",")] + (["ids"] if with_ids else [])

    def merge(table: pa.Table) -> pa.Table:
        sizes = table.column("length").to_numpy()
        group = table.column("part")[0].as_py() // MERGED_PARTITIONS
        tie = [table.column(c).to_numpy() for c in ("offset", "sequence_id")]
        state = Windows(length, len(sizes) + 1, (1 << 62) + (group << 32))
        window, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        for i in np.lexsort((*tie, -sizes)):
            _, window[i], offset[i], _ = state.add(int(sizes[i]), cut=False)[-1]
        for name, made in (("sequence_id", window), ("offset", offset)):
            table = table.set_column(table.column_names.index(name), name, pa.array(made))
        return table

    left = pieces.where("open").groupBy(F.floor(F.col("part") / MERGED_PARTITIONS)).applyInArrow(merge, schema)
    return pieces.where("not open").unionByName(left).select(*names)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def query(documents: DataFrame) -> DataFrame:
    return pack_documents(documents, default_tokenizer())
