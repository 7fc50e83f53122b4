"""Spark-native corpus, tokenizer and masking engine.

Every operator is a function DataFrame -> DataFrame built from Spark SQL
expressions; Python workers run only where Spark has no built-in
(NFKC normalisation, subword encoding, unigram EM, user scoring).
"""

from maskweave.session import checkpoint_root, get_spark, materialize

__all__ = ["checkpoint_root", "get_spark", "materialize"]
