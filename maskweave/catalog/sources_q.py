"""Step 1 queries: text choice, limits, positions, batches, text sink."""

from __future__ import annotations

from pyspark.sql import functions as F

from maskweave.catalog.common import EDGE_SQL, docs, edge_rows
from maskweave.operators import position as P
from maskweave.session import scratch_path
from maskweave.sources import corpus as C
from maskweave.sources import sinks as S

QUERIES = {}
ORACLES = {}


def q(name, sql=None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


@q("text_by_schema", f"select doc_id, text from {EDGE_SQL}")
def text_by_schema(spark, sf):
    e = edge_rows(spark, sf)
    return C.resolve_text(e, "schema")


@q("text_content_only", "select doc_id, text from documents")
def text_content_only(spark, sf):
    e = docs(spark, sf).select("doc_id", F.col("text").alias("content"))
    return C.resolve_text(e, "schema")


@q("text_by_key", f"select doc_id, text from {EDGE_SQL} where text is not null and text <> ''")
def text_by_key(spark, sf):
    return C.resolve_text(edge_rows(spark, sf), "key")


@q("text_truthy", f"select doc_id, coalesce(nullif(text, ''), nullif(content, '')) as text from {EDGE_SQL}")
def text_truthy(spark, sf):
    return C.resolve_text(edge_rows(spark, sf), "truthy")


_KEY_POS_SQL = f"""(select doc_id, row_number() over (order by doc_id) - 1 as pos
  from {EDGE_SQL} where text is not null and text <> '')"""


@q("global_position", f"select doc_id, pos from {_KEY_POS_SQL}")
def global_position(spark, sf):
    t = C.resolve_text(edge_rows(spark, sf), "key").select("doc_id")
    return P.with_position(t)


@q("conversation_position",
   "select conv_id, turn, row_number() over (order by conv_id, turn) - 1 as pos from conversations")
def conversation_position(spark, sf):
    c = C.read_table(spark, sf, "conversations").select("conv_id", "turn")
    return P.with_position(c, order=("conv_id", "turn"))


@q("nonempty_limit", f"select doc_id, pos from {_KEY_POS_SQL} where pos < 500")
def nonempty_limit(spark, sf):
    t = C.resolve_text(edge_rows(spark, sf), "key").select("doc_id")
    return P.limit_positions(P.with_position(t), 500)


@q("raw_limit", f"""select doc_id, coalesce(nullif(text, ''), nullif(content, '')) as text
  from (select *, row_number() over (order by doc_id) - 1 as pos from {EDGE_SQL}) where pos < 300""")
def raw_limit(spark, sf):
    return C.resolve_text(P.first_rows(edge_rows(spark, sf), 300), "truthy")


@q("batch_rounded_limit", f"""select doc_id, pos
  from (select doc_id, row_number() over (order by doc_id) - 1 as pos from {EDGE_SQL})
  where pos < (250 + 100 - 1) // 100 * 100""")
def batch_rounded_limit(spark, sf):
    raw = P.with_position(edge_rows(spark, sf).select("doc_id"))
    return P.limit_positions(raw, P.rounded_limit(250, 100))


@q("skip_take", f"select doc_id, pos from {_KEY_POS_SQL} where pos >= 100 and pos < 350")
def skip_take(spark, sf):
    t = C.resolve_text(edge_rows(spark, sf), "key").select("doc_id")
    return P.skip_take(P.with_position(t), 100, 250)


@q("select_between", f"select doc_id from {_KEY_POS_SQL} where pos >= 100 and pos < 350")
def select_between(spark, sf):
    """B6 by selection: two keys are found, no position is made."""
    return P.rows_between(C.resolve_text(edge_rows(spark, sf), "key"), 100, 250).select("doc_id")


@q("fixed_batches", f"""select pos // 64 as batch_id, count(*) as n_rows, min(doc_id) as first_doc,
       max(doc_id) as last_doc, cast(sum(length(text)) as bigint) as n_chars
  from (select doc_id, text, row_number() over (order by doc_id) - 1 as pos
          from {EDGE_SQL} where text is not null and text <> '')
 group by 1""")
def fixed_batches(spark, sf):
    t = C.resolve_text(edge_rows(spark, sf), "key")
    b = P.with_batch_id(P.with_position(t), 64)
    return b.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("doc_id").alias("first_doc"),
        F.max("doc_id").alias("last_doc"), F.sum(F.length("text")).cast("bigint").alias("n_chars"))


@q("batch_lists", f"""select pos // 64 as batch_id, count(*) as n_rows,
       string_agg(cast(doc_id as varchar), ' ' order by pos) as doc_ids
  from (select doc_id, row_number() over (order by doc_id) - 1 as pos
          from {EDGE_SQL} where text is not null and text <> '')
 group by 1""")
def batch_lists(spark, sf):
    t = C.resolve_text(edge_rows(spark, sf), "key").select("doc_id")
    lists = P.batch_lists(P.with_position(t), 64, value="doc_id")
    return lists.select("batch_id", F.size("doc_id").cast("bigint").alias("n_rows"),
                        F.array_join(F.col("doc_id").cast("array<string>"), " ").alias("doc_ids"))


@q("corpus_lines", "select replace(text, chr(10), ' ') as line from documents")
def corpus_lines(spark, sf):
    t = C.resolve_text(docs(spark, sf), "truthy")
    path = S.write_corpus_lines(t)
    return S.read_corpus_lines(spark, path)


@q("training_corpus_batches", f"""select pos // 64 as batch_id, count(*) as n_rows,
       cast(sum(length(text)) as bigint) as n_chars
  from (select doc_id, text, row_number() over (order by doc_id) - 1 as pos
          from {EDGE_SQL} where text is not null and text <> '')
 where pos < 500 group by 1""")
def training_corpus_batches(spark, sf):
    b = C.training_corpus(edge_rows(spark, sf), limit=500, batch_size=64)
    return b.select("batch_id", F.size("text").cast("bigint").alias("n_rows"),
                    F.aggregate("text", F.lit(0).cast("bigint"), lambda a, t: a + F.length(t)).alias("n_chars"))


@q("output_dir_rules", """select * from (values ('new', 'ok'), ('empty', 'ok'), ('not empty', 'FileExistsError'),
  ('overwrite', 'ok')) as t(folder, outcome), (select count(*) as n_lines from documents)""")
def output_dir_rules(spark, sf):
    """A9 before A6: what becomes of a folder that is there."""
    t, rows = C.resolve_text(docs(spark, sf), "schema"), []
    out = scratch_path(spark, "output")
    for folder, overwrite in (("new", False), ("empty", False), ("not empty", False), ("overwrite", True)):
        if folder == "empty":
            S.prepare_output_dir(spark, out, overwrite=True)
        try:
            S.prepare_output_dir(spark, out, overwrite=overwrite)
            outcome = "ok"
            S.write_corpus_lines(t, f"{out}/lines")
        except FileExistsError as exc:
            outcome = type(exc).__name__
        rows.append((folder, outcome, S.read_corpus_lines(spark, f"{out}/lines").count()))
    return spark.createDataFrame(rows, "folder string, outcome string, n_lines bigint")
