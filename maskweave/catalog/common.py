"""Shared inputs for registered queries: tables, edge rows, fixture plan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from maskweave.sources.corpus import read_corpus


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return read_corpus(spark, sf, "documents")


def edge_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with empty and null ``text`` made by expression, plus the
    original text as ``content`` (FIXTURES edge_text)."""
    d = docs(spark, sf)
    return d.select(
        "doc_id",
        F.when(F.col("doc_id") % 7 == 0, F.lit(""))
         .when(F.col("doc_id") % 11 == 0, F.lit(None).cast("string"))
         .otherwise(F.col("text")).alias("text"),
        F.col("text").alias("content"))


EDGE_SQL = """(select doc_id,
       case when doc_id % 7 = 0 then '' when doc_id % 11 = 0 then null else text end as text,
       text as content
  from documents)"""
