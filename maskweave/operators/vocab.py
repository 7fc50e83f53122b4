"""Vocabulary tables: special tokens, control ids, roles, pad guarantee
(D4, D5, D11, E7) and the SQL-expressible test vocabulary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Special tokens in id order (roles and strings).
SPECIAL_TOKENS = [
    ("unk", "[UNK]"),
    ("sep", "[SEP]"),
    ("pad", "[PAD]"),
    ("cls", "[CLS]"),
    ("mask", "[MASK]"),
]
# SentencePiece control ids.
CONTROL_IDS = [("unk", 0, "<unk>"), ("bos", 1, "<s>"), ("eos", 2, "</s>"), ("pad", 3, "<pad>")]

VOCAB_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("piece", T.StringType(), False),
    T.StructField("score", T.DoubleType(), True),
    T.StructField("role", T.StringType(), True),
])


def special_map() -> dict[str, str]:
    return {f"{role}_token": tok for role, tok in SPECIAL_TOKENS}


def reserved_pieces(kind: str = "wordpiece") -> list[tuple[str, str]]:
    """(piece, role) for the first ids: D4 specials, or D5 control ids."""
    if kind == "sentencepiece":
        return [(piece, role) for role, _, piece in CONTROL_IDS]
    return [(tok, role) for role, tok in SPECIAL_TOKENS]


def ensure_pad(vocab: DataFrame) -> tuple[DataFrame, bool]:
    """If no row has role 'pad', append [PAD] at max(id)+1; the flag
    says the embedding table must be resized."""
    has_pad = vocab.filter(F.col("role") == "pad").limit(1).count() > 0
    if has_pad:
        return vocab, False
    spark = vocab.sparkSession
    pad = spark.createDataFrame([("[PAD]", 0.0, "pad")], "piece string, score double, role string")
    nxt = vocab.agg(F.coalesce(F.max("id") + 1, F.lit(0)).alias("id"))
    return vocab.unionByName(pad.crossJoin(nxt).select("id", "piece", "score", "role")), True


def to_encoder_vocab(vocab: DataFrame) -> DataFrame:
    """Make a learned vocabulary usable by the encoder and collator:
    keep roles already set (SentencePiece control ids cover unk and pad)
    and append the missing special roles as new pieces at the end, in the
    special-token order.  Works for unigram and BPE alike (the reference
    converts only unigram)."""
    have = {r["role"] for r in vocab.filter(F.col("role").isNotNull()).select("role").collect()}
    missing = [(tok, role) for role, tok in SPECIAL_TOKENS if role not in have]
    if not missing:
        return vocab
    spark = vocab.sparkSession
    nxt = vocab.agg(F.max("id")).first()[0] + 1
    extra = spark.createDataFrame([(nxt + i, tok, 0.0, role) for i, (tok, role) in enumerate(missing)],
                                  VOCAB_SCHEMA)
    return vocab.unionByName(extra)
