"""Text predicates, pre-tokenisation and byte-level views of a string column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Pre-token pattern (apostrophe suffixes, letters, digits, other, spaces).
PRETOKEN_PATTERN = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
# Fixed value: word-level pattern of the whitespace pre-tokeniser.
WORD_PATTERN = r"\w+|[^\w\s]+"
# Letter words with their leading blank: the part of the pattern every SQL engine has.
LETTER_PATTERN = r" ?\p{L}+"
NONBLANK_PATTERN = r"(?U)[^\s\x1c-\x1f]"


def is_nonblank(text: Column) -> Column:
    """True when the text holds something besides white space."""
    return text.rlike(NONBLANK_PATTERN)


def pretokens(text: Column) -> Column:
    """Pre-tokens of a text, in order, as ARRAY<STRING>."""
    return F.regexp_extract_all(text, F.lit("(?U)" + PRETOKEN_PATTERN), F.lit(0))


def letter_words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(LETTER_PATTERN), F.lit(0))


def plain_words(text: Column) -> Column:
    """Words and punctuation runs, without white space."""
    return F.regexp_extract_all(text, F.lit("(?U)" + WORD_PATTERN), F.lit(0))


def utf8_bytes(text: Column) -> Column:
    """The UTF-8 bytes of a string, one BINARY of length 1 each."""
    raw = F.encode(text, "UTF-8")
    some = F.transform(
        F.sequence(F.lit(1), F.greatest(F.octet_length(text), F.lit(1))),
        lambda i: F.substring(raw, i, F.lit(1)),
    )
    return F.when(F.octet_length(text) > 0, some).otherwise(F.slice(some, 1, 0))


def byte_string(text: Column) -> Column:
    """One character per UTF-8 byte (code point = byte value): the base symbols."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def text_of_byte_string(symbols: Column) -> Column:
    return F.decode(F.encode(symbols, "ISO-8859-1"), "UTF-8")


def printable_code_points() -> list[int]:
    """Byte value -> code point of its printable stand-in.

    Fixed values: 33-126, 161-172 and 174-255 stand for themselves; the others take
    256, 257, ... in byte order.
    """
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    moved = iter(range(256, 512))
    return [b if b in kept else next(moved) for b in range(256)]


def printable_bytes(text: Column) -> Column:
    """UTF-8 bytes of a text written with the printable stand-ins."""
    table = "".join(map(chr, printable_code_points()))
    return F.translate(byte_string(text), "".join(map(chr, range(256))), table)


def text_of_printable(shown: Column) -> Column:
    table = "".join(map(chr, printable_code_points()))
    return text_of_byte_string(F.translate(shown, table, "".join(map(chr, range(256)))))


def path_slug(name: Column) -> Column:
    """Dataset name usable as one path component."""
    return F.translate(name, "/\\", "__")


def step_of_file(path: Column) -> Column:
    """Step number in a name such as `checkpoint_step_1200.pt`; NULL where there is none."""
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    return F.element_at(F.split(stem, "_"), -1).try_cast("int")


def version_of_file(path: Column) -> Column:
    """Version number in a name such as `best_model_v12.pt`; NULL where there is none."""
    name = F.element_at(F.split(path, "/"), -1)
    return F.regexp_extract(name, r"^best_model_v(\d+)\.pt", 1).try_cast("int")
