"""BPE encoding as a streaming transducer of bounded lookahead, and decoding as a byte-to-text state machine."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, text_of

#: Bytes of a piece fed at a time, and characters of a text split at a time.
STEP, SPLIT = 4096, 1 << 16
#: Pieces of at most this many characters are kept, and so many of them.
SHORT, KEPT = 48, 400_000
#: Up to so many bytes the next merge is found by looking at all pairs, beyond by a queue.
FEW = 64
#: The pattern of byte-level files that do not carry one of their own.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: No piece of PIECES reaches over the place before white space that follows other characters.
_CUT = regex.compile(r"\S(?=\s)")


def byte_letters() -> dict[str, int]:
    """The byte each letter of a byte-level vocabulary stands for: visible Latin-1 itself, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(others)}


class MergeList:
    """The merges and ids of a byte-level BPE file, and how far ahead a token depends on what follows.

    `lookahead`: adding bytes behind a text changes nothing that ends at least so many bytes before its old end.
    Merges apply in order of rank. The texts with and without the added bytes agree up to some boundary, at first
    the old end. Only a merge (u, v) across that boundary moves it, by the length of u, and leaves u, or a token
    that grew from u, right of it. A later merge (s, t) that crosses the new boundary has the higher rank, and u
    on the left spine of t. So the bound is the heaviest chain of merges of rising rank linked in that way,
    each weighing the length of its left part.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, letters = spec["model"], byte_letters()
        if model.get("type") != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" or spec.get("normalizer"):
            raise ValueError("the file is no plain byte-level BPE")
        if not spec["pre_tokenizer"].get("use_regex", True) or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("only files that split by pattern and add no space are read")
        vocab = model["vocab"]
        added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        raw = lambda token: bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.bytes_of = {i: raw(token) for token, i in [*vocab.items(), *added.items()]}
        self.added = added
        self.of_byte = [vocab[letter] for letter, _ in sorted(letters.items(), key=lambda x: x[1])]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for left, right in merges:
            self.rank[vocab[left], vocab[right]] = len(self.made)
            self.made.append(vocab[left + right])
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        singles = set(self.of_byte)
        lefts: dict[int, set[int]] = {}
        heaviest: dict[int, int] = {}
        most = 0
        for (u, v), rank in self.rank.items():
            if not all(t in singles or t in lefts for t in (u, v)):
                raise ValueError("a merge comes before its parts: no bounded lookahead is known for such a list")
            spine, late = {v}, [v]
            while late:
                for t in lefts.get(late.pop(), ()):
                    if t not in spine:
                        spine.add(t)
                        late.append(t)
            weight = len(self.bytes_of[u]) + max(heaviest.get(t, 0) for t in spine)
            heaviest[u] = max(heaviest.get(u, 0), weight)
            lefts.setdefault(self.made[rank], set()).add(u)
            most = max(most, weight)
        return most

    def merge(self, data: bytes) -> list[int]:
        """Ids of the bytes: merges by rank, equal ranks from the left."""
        ids = [self.of_byte[b] for b in data]
        return self._merge_few(ids) if len(ids) <= FEW else self._merge_many(ids)

    def _merge_few(self, ids: list[int]) -> list[int]:
        rank, made = self.rank.get, self.made
        none = len(made)
        ranks = [rank(pair, none) for pair in zip(ids, ids[1:])]
        while ranks and (r := min(ranks)) < none:
            i = ranks.index(r)
            ids[i : i + 2] = (made[r],)
            del ranks[i]
            if i:
                ranks[i - 1] = rank((ids[i - 1], ids[i]), none)
            if i < len(ranks):
                ranks[i] = rank((ids[i], ids[i + 1]), none)
        return ids

    def _merge_many(self, ids: list) -> list[int]:
        n = len(ids)
        rank = self.rank.get
        heap = [(r, i) for i in range(n - 1) if (r := rank((ids[i], ids[i + 1]))) is not None]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        made = self.made
        while heap:
            r, i = heappop(heap)
            j = after[i]
            # A place that has changed since it was queued no longer holds this merge.
            if ids[i] is None or j >= n or rank((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = made[r], None
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if (s := rank((ids[i], ids[k]))) is not None:
                    heappush(heap, (s, i))
            h = before[i]
            if h >= 0 and (s := rank((ids[h], ids[i]))) is not None:
                heappush(heap, (s, h))
        return [t for t in ids if t is not None]

    def stream(self, data: Iterable[bytes]) -> Iterator[list[int]]:
        """Ids of one piece that arrives in parts of any size; a token leaves as soon as no later byte can change it.

        What is held is the lookahead, one token and one part.
        """
        held, sizes = b"", self.bytes_of
        for part in data:
            held += part
            stable = len(held) - self.lookahead
            if stable <= 0:
                continue
            ids = self.merge(held)
            count = size = 0
            while (end := size + len(sizes[ids[count]])) <= stable:
                size, count = end, count + 1
            if count:
                yield ids[:count]
                held = held[size:]
        if held:
            yield self.merge(held)


def parts_of(piece: str) -> Iterator[bytes]:
    for at in range(0, len(piece), STEP):
        yield piece[at : at + STEP].encode()


#: Lead byte: how many bytes follow, and the bounds of the first of them. Others stand for themselves or are no lead.
_LEADS = (
    {b: (1, 0x80, 0xBF) for b in range(0xC2, 0xE0)}
    | {b: (2, 0x80, 0xBF) for b in range(0xE1, 0xF0)}
    | {b: (3, 0x80, 0xBF) for b in range(0xF1, 0xF4)}
    | {0xE0: (2, 0xA0, 0xBF), 0xED: (2, 0x80, 0x9F), 0xF0: (3, 0x90, 0xBF), 0xF4: (3, 0x80, 0x8F)}
)
_REPLACED = "�"


def read_bytes(pending: bytes, data: bytes) -> tuple[str, bytes]:
    """Text that the bytes complete, and the started character they leave; a broken one becomes U+FFFD once."""
    out = []
    for byte in data:
        if pending:
            size, low, high = _LEADS[pending[0]]
            if len(pending) > 1:
                low, high = 0x80, 0xBF
            if low <= byte <= high:
                pending += bytes((byte,))
                if len(pending) == size + 1:
                    out.append(pending.decode())
                    pending = b""
                continue
            out.append(_REPLACED)
            pending = b""
        if byte < 0x80:
            out.append(chr(byte))
        elif byte in _LEADS:
            pending = bytes((byte,))
        else:
            out.append(_REPLACED)
    return "".join(out), pending


class TextMachine:
    """Text of ids that arrive one after another. Its state is the started character, three bytes at most.

    Steps already taken, from a state by an id, are kept, STEPS at most.
    """

    STEPS = 1 << 16

    def __init__(self, merges: MergeList):
        self.bytes_of, self.pending = merges.bytes_of, b""
        self.steps: dict[tuple[bytes, int], tuple[str, bytes]] = {}

    def feed(self, ids: Iterable[int]) -> str:
        """Unknown ids are passed over."""
        out, steps, pending = [], self.steps, self.pending
        for i in ids:
            step = steps.get((pending, i))
            if step is None:
                if len(steps) >= self.STEPS:
                    steps.clear()
                step = steps[pending, i] = read_bytes(pending, self.bytes_of.get(i, b""))
            text, pending = step
            out.append(text)
        self.pending = pending
        return "".join(out)

    def finish(self) -> str:
        rest, self.pending = self.pending, b""
        return _REPLACED if rest else ""


class Codec:
    """Whole texts to ids and back with one file. Results of short pieces are kept, KEPT at most."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.merges = MergeList(path)
        self.machine = TextMachine(self.merges)
        self.pattern = regex.compile(PIECES)
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        contents = sorted(self.merges.added, key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, contents))) if contents else None
        self.seen: set[str] = set()
        self.odd: dict[int, str] = {}
        self.ids: dict[str, list[int]] = {}
        self.written: dict[str, str] = {}
        self.read: dict[str, str] = {}

    def segments(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text around added tokens, and these (True)."""
        at = 0
        for found in self.special.finditer(text) if self.special else ():
            if found.start() > at:
                yield text[at : found.start()], False
            yield found.group(), True
            at = found.end()
        if at < len(text):
            yield text[at:] if at else text, False

    def _classed(self, segment: str) -> str:
        """The segment with a plain letter, digit or sign for characters whose class differs between Unicode versions."""
        new = set(segment).difference(self.seen)
        for char in new:
            one_piece = lambda before: len(self.split(before + char)) == 1
            kind = "a" if one_piece("a") else "1" if one_piece("1") else "!" if one_piece("!") else " "
            if [m.group() for m in self.pattern.finditer(f"{kind}{char}")] != [kind + char]:
                self.odd[ord(char)] = kind
        self.seen |= new
        return segment.translate(self.odd) if self.odd and not self.odd.keys().isdisjoint(map(ord, set(segment))) else segment

    def pieces(self, segment: str) -> Iterator[list[str]]:
        """The pieces of a segment, some ten thousand at a time."""
        at, n = 0, len(segment)
        while at < n:
            cut = _CUT.search(segment, at + SPLIT) if at + SPLIT < n else None
            end = cut.end() if cut else n
            part = segment[at:end] if end - at < n else segment
            classed = self._classed(part)
            if classed is not part:
                found = (part[m.start() : m.end()] for m in self.pattern.finditer(classed))
            elif len(part) > 4 * SPLIT:
                found = (m.group() for m in self.pattern.finditer(part))
            else:
                found = iter(self.pattern.findall(part))
            while block := list(islice(found, SPLIT)):
                yield block
            at = end

    def _encode_short(self, piece: str) -> list[int]:
        return [i for block in self.merges.stream((piece.encode(),)) for i in block]

    def encode(self, text: str) -> Iterator[list[int]]:
        """The ids of a text, block by block."""
        for segment, special in self.segments(text):
            if special:
                yield [self.merges.added[segment]]
                continue
            for block in self.pieces(segment):
                out: list[int] = []
                for piece in block:
                    if len(piece) > SHORT:
                        yield out
                        yield from self.merges.stream(parts_of(piece))
                        out = []
                        continue
                    ids = self.ids.get(piece)
                    if ids is None:
                        if len(self.ids) >= KEPT:
                            self.ids.clear()
                        ids = self.ids[piece] = self._encode_short(piece)
                    out += ids
                yield out

    def decode(self, ids: Iterable[int]) -> str:
        return self.machine.feed(ids) + self.machine.finish()

    def _learn(self, pieces: list[str]) -> None:
        """Keep the ids, written out, of new short pieces, and the text read back from them."""
        new = set(pieces).difference(self.written)
        if len(self.written) + len(new) > KEPT:
            self.written, self.read = {}, {}
            new = set(pieces)
        for piece in new:
            if len(piece) <= SHORT:
                ids = self._encode_short(piece)
                back = self.decode(ids)
                self.written[piece], self.read[piece] = ",".join(map(str, ids)), piece if back == piece else back

    def digests(self, text: str) -> tuple[int, str, str]:
        """Number of ids, SHA-256 of the ids written out, and of the text read back; neither is held as a whole."""
        count, written, read = 0, hashlib.sha256(), hashlib.sha256()

        def add(ids: str, back: str) -> None:
            nonlocal count
            written.update(f",{ids}".encode() if count else ids.encode())
            read.update(back.encode())
            count += ids.count(",") + 1

        def stream(blocks: Iterable[list[int]]) -> None:
            for ids in blocks:
                add(",".join(map(str, ids)), self.machine.feed(ids))

        for segment, special in self.segments(text):
            if special:
                stream([[self.merges.added[segment]]])
                continue
            for block in self.pieces(segment):
                self._learn(block)
                at = 0
                # A piece is whole characters, so the machine is at rest before and after each.
                for long in [i for i, piece in enumerate(block) if len(piece) > SHORT] + [len(block)]:
                    if long > at:
                        run = block[at:long]
                        add(",".join(map(self.written.__getitem__, run)), "".join(map(self.read.__getitem__, run)))
                    if long < len(block):
                        stream(self.merges.stream(parts_of(block[long])))
                    at = long + 1
        read.update(self.machine.finish().encode())
        return count, written.hexdigest(), read.hexdigest()


_CODECS: dict[str, Codec] = {}


def codec_for(path: str) -> Codec:
    """One codec a file and worker."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_documents(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every row, whole texts, added tokens' strings as their ids.

    Null and empty texts have no id; repeated rows and null keys stay as they are; other columns are passed
    over. One pass without a shuffle.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_for(path)
        ids = pa.array([[i for block in codec.encode(t.as_py()) for i in block] for t in batch.column(1)], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([batch.column(0), ids], names=["key", "ids"])

    rows = docs.select(F.col(f"`{key}`").alias("key"), text_of(f"`{text}`").alias("text"))
    return map_batches(rows, run, f"key {rows.schema['key'].dataType.simpleString()}, ids array<int>").withColumnRenamed("key", key)


def decode_documents(encoded: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of rows of ids. Null or no ids give an empty text, null and unknown ids nothing, broken characters U+FFFD."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_for(path)
        texts = pa.array([codec.decode(row.as_py() or ()) for row in batch.column(1)], pa.string())
        return pa.RecordBatch.from_arrays([batch.column(0), texts], names=["key", "text"])

    rows = encoded.select(F.col(f"`{key}`").alias("key"), F.col(f"`{ids}`").cast("array<int>").alias("ids"))
    return map_batches(rows, run, f"key {rows.schema['key'].dataType.simpleString()}, text string").withColumnRenamed("key", key)


def round_trips(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every row: encoded and decoded as a stream, digests only kept.

    Cases are those of encode_documents. No text or id list is held twice: a worker keeps one block of pieces, the
    lookahead of the merge list, and at most KEPT short pieces.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codec = codec_for(path)
        found = [codec.digests(t.as_py()) for t in batch.column(1)]
        columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.string(), pa.string()))]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_of().alias("text"))
    return map_batches(rows, run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(documents: DataFrame) -> DataFrame:
    return round_trips(documents, default_tokenizer())
