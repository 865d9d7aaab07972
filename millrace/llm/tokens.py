"""Count-only Viterbi over a unigram vocabulary."""

from __future__ import annotations

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import map_batches, text_of

SPACE = "▁"
UNKNOWN_PENALTY = 10.0


@dataclass
class Vocabulary:
    """Pieces with scores; characters no piece covers count one token per byte, or one per run without bytes."""

    scores: dict[str, float]
    bytes_known: bool


def read_vocabulary(path: str) -> Vocabulary:
    """Pieces and scores of a sentencepiece file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    scores = {
        model.id_to_piece(i): model.get_score(i)
        for i in ids
        if not (model.is_control(i) or model.is_byte(i) or model.is_unknown(i) or model.is_unused(i))
    }
    return Vocabulary(scores, any(model.is_byte(i) for i in ids))


class Counter:
    """Tokens of texts: Aho-Corasick finds every piece, dynamic programming keeps best score and piece count.

    Scores are added in double precision. Of equal scores the path over the longer last piece wins, as for a
    decoder that goes through start positions in order and replaces a path by a strictly better one only. A
    character without a piece of its own may be passed as unknown at the lowest score less 10. Where no piece
    has a space mark after another character, a text is cut before such marks: no best path crosses them.
    """

    def __init__(self, vocabulary: Vocabulary, limit: int = 1_000_000):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        for piece, score in vocabulary.scores.items():
            self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.single = {p for p in vocabulary.scores if len(p) == 1}
        self.unknown = min(vocabulary.scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.bytes_known = vocabulary.bytes_known
        apart = not any(SPACE in p.lstrip(SPACE) for p in vocabulary.scores)
        self.units = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+" if apart else "(?s).+")
        self.known: dict[str, int] = {}
        self.limit = limit

    def viterbi(self, text: str) -> int:
        n = len(text)
        best: list = [None] * (n + 1)
        best[0] = (0.0, 0, False)
        matches: list[list] = [[] for _ in range(n + 1)]
        for end, (size, score) in self.automaton.iter(text):
            matches[end + 1].append((size, score))
        for end in range(1, n + 1):
            char = text[end - 1]
            top = None
            # Longest first: the earliest start is the first to reach this end.
            for size, score in sorted(matches[end], reverse=True):
                before = best[end - size]
                total = before[0] + score
                if top is None or total > top[0]:
                    top = (total, before[1] + 1, False)
            if char not in self.single:
                before = best[end - 1]
                total = before[0] + self.unknown
                if top is None or total > top[0]:
                    cost = len(char.encode("utf-8", "surrogatepass")) if self.bytes_known else int(not before[2])
                    top = (total, before[1] + cost, True)
            best[end] = top
        return best[n][1]

    def count(self, text: str) -> int:
        if not text:
            return 0
        total, known = 0, self.known
        for unit in self.units.findall(SPACE + text.replace(" ", SPACE)):
            n = known.get(unit)
            if n is None:
                n = self.viterbi(unit)
                if len(unit) <= 64:
                    if len(known) >= self.limit:
                        known.clear()
                    known[unit] = n
            total += n
        return total


_COUNTERS: dict[str, Counter] = {}


def counter_for(path: str) -> Counter:
    if path not in _COUNTERS:
        _COUNTERS[path] = Counter(read_vocabulary(path))
    return _COUNTERS[path]


def count_tokens(docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, n_chars) of every row, whole texts.

    Null and empty texts have no token; repeated rows and null keys stay as they are; other columns are
    passed over. One pass without a shuffle; a worker keeps counts of at most a million short units.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counter = counter_for(vocabulary)
        texts = batch.column(1).to_pylist()
        counts = pa.array([counter.count(t) for t in texts], pa.int64())
        chars = pa.array([len(t) for t in texts], pa.int64())
        return pa.RecordBatch.from_arrays([batch.column(0), counts, chars], names=[key, "n_tokens", "n_chars"])

    rows = docs.select(F.col(key).cast("bigint").alias(key), text_of(text).alias("text"))
    return map_batches(rows, run, f"{key} bigint, n_tokens bigint, n_chars bigint")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def query(documents: DataFrame) -> DataFrame:
    return count_tokens(documents, default_vocabulary())
