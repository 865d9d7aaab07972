"""Text expressions: tokens, letter marks, case."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The marked letters handled by default, their plain forms and their mark class.
PLAIN = "acdeeinorstuuyz"
MARKED = "áčďéěíňóřšťúůýž"
ACUTE = "áéíóúý"
ACUTE_PLAIN = "aeiouy"
CARON = "čěňřšžďť"
CARON_PLAIN = "cenrszdt"
RING = "ů"
RING_PLAIN = "u"
NOISE = ".,\n-:"
# Code points a context position may hold, with case folded.
FOLDED_CODES = [
    32, 33, 34, 39, 40, 41, 48, 49, 50, 52, 54, 56, 57, 59, 63, 97, 98, 99, 100, 101, 102, 103, 104, 105, 106,
    107, 108, 109, 110, 111, 112, 113, 114, 115, 116, 117, 118, 119, 120, 121, 122,
]


@dataclass(frozen=True)
class MarkTable:
    """Which letters carry which mark class; class 0 means no mark."""

    pairs: tuple[tuple[str, str], ...] = tuple(zip(PLAIN, MARKED))
    classes: dict[int, tuple[str, str]] = field(
        default_factory=lambda: {1: (ACUTE_PLAIN, ACUTE), 2: (CARON_PLAIN, CARON), 3: (RING_PLAIN, RING)}
    )

    def plain_letters(self) -> str:
        """Letters that may carry a mark, both cases, each once."""
        lower = "".join(dict.fromkeys(plain for plain, _ in self.pairs))
        return lower + lower.upper()

    def translation(self) -> tuple[str, str]:
        marked = "".join(marked for _, marked in self.pairs)
        plain = "".join(plain for plain, _ in self.pairs)
        return marked + marked.upper(), plain + plain.upper()

    def class_letters(self, number: int) -> tuple[str, str]:
        plain, marked = self.classes[number]
        return plain + plain.upper(), marked + marked.upper()


# Western European marks found in the supplied documents.
WESTERN = MarkTable(
    pairs=tuple(zip("aeiouaeouaeioucnaou", "áéíóúàèòùâêîôûçñäöü")),
    classes={
        1: ("aeiou", "áéíóú"),
        2: ("aeou", "àèòù"),
        3: ("aeiou", "âêîôû"),
        4: ("c", "ç"),
        5: ("n", "ñ"),
        6: ("aou", "äöü"),
    },
)


def strip_marks(text: Column, marks: MarkTable = MarkTable()) -> Column:
    source, target = marks.translation()
    return F.translate(text, source, target)


def word_tokens(text: Column) -> Column:
    """Runs of letters, digits and underscore, case kept."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]+"), F.lit(0))


def long_word_tokens(text: Column) -> Column:
    """As word_tokens, runs of at least two characters."""
    return F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_]{2,}"), F.lit(0))


def space_tokens(text: Column) -> Column:
    """Lower case, split at white space."""
    return F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")


def letter_runs(text: Column) -> Column:
    """Letter runs and single other characters, in order; joined they give the text back."""
    return F.regexp_extract_all(text, F.lit(r"\p{L}+|[^\p{L}]"), F.lit(0))


def alphabetic_runs(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"\p{L}+"), F.lit(0))


def is_member(letter: Column, letters: str) -> Column:
    return F.instr(F.lit(letters), letter) > 0


def mark_class(letter: Column, marks: MarkTable = MarkTable()) -> Column:
    result = None
    for number in sorted(marks.classes):
        _, marked = marks.class_letters(number)
        hit = F.instr(F.lit(marked), letter) > 0
        result = F.when(hit, number) if result is None else result.when(hit, number)
    return result.otherwise(0)


def add_mark(letter: Column, number: Column, marks: MarkTable = MarkTable()) -> Column:
    """The letter with the mark of that class; unchanged where the pair does not exist."""
    result = None
    for key in sorted(marks.classes):
        plain, marked = marks.class_letters(key)
        value = F.translate(letter, plain, marked)
        result = F.when(number == key, value) if result is None else result.when(number == key, value)
    return result.otherwise(letter)


def starts_upper(word: Column) -> Column:
    return F.substr(word, F.lit(1), F.lit(1)).rlike(r"^\p{Lu}")


def capitalized(word: Column) -> Column:
    """First letter upper, the rest lower."""
    return F.concat(F.upper(F.substr(word, F.lit(1), F.lit(1))), F.lower(F.substr(word, F.lit(2))))


def noise_to_space(text: Column) -> Column:
    return F.translate(F.lower(text), NOISE, " " * len(NOISE))


def code_point(letter: Column) -> Column:
    return F.ascii(letter)


def without_bom(text: Column) -> Column:
    return F.regexp_replace(text, "^\\uFEFF", "")
