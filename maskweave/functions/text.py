"""Text normalisation and pre-tokenisation as Spark column expressions.

All of these run JVM-side inside whole-stage codegen except C2, which needs
Unicode NFKC (no Spark built-in) and so is one pass in an Arrow UDF.  It
takes as long as the JVM's regular expressions for its removals alone, so
nothing of it is left to them.
"""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Patterns and markers whose exact text defines the results,
# spelled with explicit classes so that Java and Python read them alike.
# Unicode white space (the White_Space property).
SPACE = r"\t-\r \x85\xA0\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# Unicode word characters: letters and other alphabetics, marks, decimal
# digits, connectors, joiners.
WORD = (r"\p{L}\p{Nl}\p{M}\p{Nd}\p{Pc}\x{200C}\x{200D}\x{24B6}-\x{24E9}"
        r"\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}\x{1F170}-\x{1F189}")
# Words for WordPiece: runs of word characters, or of anything else that is
# not white space.
WORD_PATTERN = f"[{WORD}]+|[^{WORD}{SPACE}]+"
SPACE_RUN = f"[{SPACE}]+"
# Digit splitting inside a word: each digit alone, other runs kept.
DIGIT_SPLIT = r"\p{N}|[^\p{N}]+"
# The same over a whole marked text: runs also stop at the word space.
DIGIT_SPLIT_TEXT = r"\p{N}|[^\p{N} ]+"
# Byte-level words, lossless: contractions, letters, digits or other signs
# with one space before them, and runs of white space (all but the last of a
# run that a word follows).
BYTE_WORD_PATTERN = ("'s|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+"
                     f"| ?[^{SPACE}\\p{{L}}\\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
# Characters that normalisation removes, and those it reads as a space.
DROPPED = r"[\x00-\x08\x0B\x0E-\x1F\x7F\x8F\x9F]"
SPACED = (r"[\t\n\f\r\x{1680}\x{200B}-\x{200F}\x{2028}\x{2029}\x{2581}\x{FEFF}\x{FFFD}]")
# SentencePiece word-boundary marker (U+2581).
SP_MARK = "\u2581"
# WordPiece continuation prefix.
CONT = "##"
# Symbol delimiters for merge strings.  Words hold no white space (byte-level
# symbols are hex), so tab and line feed never meet text.
SYM_OPEN = "\t"
SYM_CLOSE = "\n"


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flatten_newlines(c: str | Column) -> Column:
    """Newline -> space."""
    return F.replace(col_of(c), F.lit("\n"), F.lit(" "))


def collapse_whitespace(c: str | Column) -> Column:
    """Collapse Unicode white space to one space and trim."""
    return F.trim(F.regexp_replace(col_of(c), SPACE_RUN, " "))


@F.arrow_udf(T.StringType())
def _normalized(s: pa.Array) -> pa.Array:
    return pa.array([None if t is None else python_normalize(t) for t in s.to_pylist()], pa.string())


@F.arrow_udf(T.StringType())
def _normalized_flat(s: pa.Array) -> pa.Array:
    # ``split`` knows the characters of SPACE (and some that C2 has removed)
    return pa.array([None if t is None else " ".join(python_normalize(t).split()) for t in s.to_pylist()], pa.string())


def _fold(t: str) -> str:
    if not unicodedata.is_normalized("NFKC", t):
        t = unicodedata.normalize("NFKC", t)
    t = t.casefold()
    return t if unicodedata.is_normalized("NFKC", t) else unicodedata.normalize("NFKC", t)


def nfkc_casefold(c: str | Column) -> Column:
    """Control characters go, odd and zero-width spaces become spaces,
    then NFKC and full case folding."""
    return _normalized(col_of(c))


def sp_normalize(c: str | Column) -> Column:
    """SentencePiece-style normalisation: C2, then C3, in one pass."""
    return _normalized_flat(col_of(c))


def whitespace_words(c: str | Column) -> Column:
    """Array of words, case kept."""
    return F.regexp_extract_all(col_of(c), F.lit(WORD_PATTERN), 0)


def mark_words(normalized: str | Column) -> Column:
    """C4 on a normalised string: the marker before every word except the
    first (no dummy prefix).  Words are single-space separated after C3."""
    return F.replace(col_of(normalized), F.lit(" "), F.lit(" " + SP_MARK))


def marked_words(normalized: str | Column) -> Column:
    """C4 as an array of words; empty words dropped."""
    return F.filter(F.split(mark_words(normalized), " "), lambda w: F.length(w) > 0)


def split_digits(word: str | Column) -> Column:
    """Each digit its own piece; no piece crosses a digit."""
    return F.regexp_extract_all(col_of(word), F.lit(DIGIT_SPLIT), 0)


def byte_words(c: str | Column) -> Column:
    """Byte-level pre-tokenisation: words with their leading space."""
    return F.regexp_extract_all(col_of(c), F.lit(BYTE_WORD_PATTERN), 0)


# Python mirrors of the pre-tokenisers, used inside Arrow workers so the
# text (not millions of tiny word strings) crosses the JVM boundary.  The
# patterns are the same strings; tests pin the two sides to equal output.
def python_pretokenizer(kind: str):
    if kind == "byte":
        import regex

        byte = regex.compile(_python(BYTE_WORD_PATTERN))
        return lambda t: byte.findall(t) if t else []

    def split(t):
        words, _ = segments([t], kind)
        return [w for w in words.to_pylist() if not is_gap(w, kind)]

    return split


@cache
def _classes(kind: str) -> np.ndarray:
    """The class of every code point: 0 between words, 1 and 2 inside; for
    ``sp``, 2 is a word of its own (C5), else a run is (C6)."""
    import regex

    points = "".join(map(chr, range(0x110000)))
    out = np.ones(len(points), np.uint8)
    for of, pattern in ((0, " "), (2, r"\p{N}")) if kind == "sp" else ((0, f"[{SPACE}]"), (2, f"[^{WORD}{SPACE}]")):
        for m in regex.finditer(_python(f"{pattern}+"), points):
            out[m.start():m.end()] = of
    return out


def is_gap(segment: str, kind: str) -> bool:
    return kind != "byte" and _classes(kind)[ord(segment[0])] == 0


def word_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Which of the WordPiece segments that begin at ``first`` are words."""
    return _classes("wordpiece")[points[first]] > 0


def segments(texts: list, kind: str) -> tuple[pa.Array, np.ndarray]:
    """(segments, how many each text has): the words and, between them, the
    gaps of all texts, cut by the classes of their code points."""
    if kind == "byte":
        split = python_pretokenizer(kind)
        rows = [split(t) for t in texts]
        return (pa.array([w for r in rows for w in r], pa.string()),
                np.fromiter(map(len, rows), np.int64, len(rows)))
    if kind == "sp":  # ``split`` knows the characters of SPACE (and some that C2 has removed)
        texts = [" ".join(python_normalize(t).split()).replace(" ", " " + SP_MARK) if t else "" for t in texts]
    sizes = np.fromiter((len(t) if t else 0 for t in texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    whole = "".join(t for t in texts if t)
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    of = _classes(kind)[points]
    begins = np.ones(len(of), bool)
    begins[1:] = of[1:] != of[:-1]
    if kind == "sp":
        begins |= of == 2
    begins[(ends - sizes)[sizes > 0]] = True
    first = np.flatnonzero(begins)
    counts = np.diff(np.searchsorted(first, np.append(0, ends)))
    raw = whole.encode()
    if len(raw) > len(points):
        width = 1 + (points >= 0x80).astype(np.int8) + (points >= 0x800) + (points >= 0x10000)
        first = (np.cumsum(width, dtype=np.int64) - width)[first]
    at = np.append(first, len(raw)).astype(np.int32)
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(at), pa.py_buffer(raw)), counts


def _python(pattern: str) -> str:
    """Java's \\x{...} in Python's spelling."""
    return re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U" + m[1].zfill(8), pattern)


_DROPPED, _SPACED = re.compile(DROPPED), re.compile(_python(SPACED))


def python_normalize(t: str) -> str:
    """C2 inside a worker."""
    t = _SPACED.sub(" ", _DROPPED.sub("", t))
    return t.lower() if t.isascii() else _fold(t)
