"""Word-type counts, alphabets and symbol strings (D1, D3, C4-C6 tables)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from maskweave.functions import text as TX

CHAR = r"(?s)."


def chars(c: str | Column) -> Column:
    """Array of code points as strings (surrogate pairs stay whole)."""
    return F.regexp_extract_all(TX.col_of(c), F.lit(CHAR), 0)


def count_words(df: DataFrame, words: Column) -> DataFrame:
    """Distinct words with counts.  Partial aggregation on the map
    side absorbs frequent words before the shuffle."""
    return (df.select(F.explode(words).alias("word"))
              .groupBy("word").agg(F.count(F.lit(1)).alias("n")))


def wordpiece_words(df: DataFrame, text: str = "text") -> DataFrame:
    """D1 of WordPiece words.  No word crosses a space, so the stretches
    between spaces are counted first, and the classes of characters are looked
    at once for each distinct one.  A stream has one aggregation only."""
    if df.isStreaming:
        return count_words(df, TX.whitespace_words(text))
    between = count_words(df, F.split(TX.col_of(text), " "))
    return (between.select(F.explode(TX.whitespace_words("word")).alias("word"), "n")
                   .groupBy("word").agg(F.sum("n").alias("n")))


def sp_pieces(text: str | Column = "text") -> Column:
    """SentencePiece pre-tokenisation: normalise, mark words (C2-C4) and
    split digits (C5); returns an array of pieces per row."""
    marked = TX.mark_words(TX.sp_normalize(text))
    # one regex pass over the text: equal to splitting each marked word's
    # digits, because runs cannot cross the single spaces between words
    return F.regexp_extract_all(marked, F.lit(TX.DIGIT_SPLIT_TEXT), 0)


def sp_words(df: DataFrame, text: str = "text") -> DataFrame:
    return count_words(df, sp_pieces(text))


def byte_word_counts(df: DataFrame, text: str = "text") -> DataFrame:
    return count_words(df, TX.byte_words(text))


def symbol_string(word: Column, kind: str) -> Column:
    """Delimited symbols of a word: <c> per character (WordPiece: <##c>
    after the first; byte-level: one symbol per UTF-8 byte as hex)."""
    o, c = TX.SYM_OPEN, TX.SYM_CLOSE
    if kind == "wordpiece":
        s = F.regexp_replace(word, r"(?s)(.)", f"{o}{TX.CONT}$1{c}")
        return F.regexp_replace(s, f"^{o}{TX.CONT}", o)
    if kind == "bpe":
        return F.regexp_replace(word, r"(?s)(.)", f"{o}$1{c}")
    if kind == "byte":
        return F.regexp_replace(F.hex(F.encode(word, "UTF-8")), "(..)", f"{o}$1{c}")
    raise ValueError(kind)


def symbols(sy: Column) -> Column:
    o, c = TX.SYM_OPEN, TX.SYM_CLOSE
    return F.regexp_extract_all(sy, F.lit(f"{o}([^{c}]*){c}"), 1)


def adjacent_pairs(arr: Column) -> Column:
    """Array of (l, r) structs for neighbouring elements."""
    n = F.size(arr)
    return F.when(n > 1, F.arrays_zip(F.slice(arr, 1, n - 1).alias("l"),
                                      F.slice(arr, 2, n - 1).alias("r"))).otherwise(F.array())
