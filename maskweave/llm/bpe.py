"""Byte-level BPE encoding and decoding by DuckDB recursive queries.

Each task cuts its texts into words with the vocabulary's pattern, writes the
words it has not met before as token-position rows (one row per byte) and runs
one recursive query over them: in every round the rows of adjacent tokens join
the merge table, each word contracts its leftmost pair of least rank, and a
word leaves when no pair of it is in the table.  Decoding joins ids to their
byte strings and concatenates them by an ordered aggregate.  Nothing is
shuffled; a task holds a slice of its texts and a bounded set of known words.

``encode`` gives packed ids (little-endian unsigned 32-bit), ``decode`` the
bytes.  A null text counts as empty and has no ids.  Texts are never cut.
Rows are kept one for one, ties and repeated rows included, and an empty table
gives no rows; columns other than the key and the text are not carried.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.llm.common import slices, text_bytes, trimmed

#: Words that a task remembers; when full it starts afresh, with equal results.
KNOWN_WORDS = 500_000
#: New words in one recursive query, and ids in one decoding query.
QUERY_BYTES, QUERY_IDS = 1 << 19, 1 << 19

# A row is a token with the position and id of the token after it; ``done``
# rows belong to words that have no pair in the merge table any more.
MERGE_SQL = """
with recursive step(word, pos, tok, next_pos, next_tok, done) as (
  select word, pos, tok, next_pos, next_tok, false from bytes_in
  union all
  select s.word, s.pos,
         case when s.pos = b.pos then b.rank else s.tok end,
         case when s.pos = b.pos then b.next_pos else s.next_pos end,
         case when s.pos = b.pos then b.next_tok when s.next_pos = b.pos then b.rank else s.next_tok end,
         b.word is null
  from (select * from step where not done) s
  left join (
    select c.word, c.pos, c.rank, c.gone, r.next_pos, r.next_tok
    from (
      select word, (least >> 32)::int as rank, (least & 4294967295)::int as pos, gone
      from (
        select t.word, min((m.rank::bigint << 32) | t.pos) as least,
               arg_min(t.next_pos, (m.rank::bigint << 32) | t.pos) as gone
        from step t join merges m on m.a = t.tok and m.b = t.next_tok
        where not t.done group by t.word)) c
    join step r on r.word = c.word and r.pos = c.gone) b on b.word = s.word
  where b.word is null or s.pos != b.gone)
select word, tok from step where done order by word, pos
"""

DECODE_SQL = """
select i.doc, string_agg(v.piece, '' order by i.pos) as piece
from ids_in i join pieces v on v.tok = i.tok group by i.doc order by i.doc
"""


class Vocabulary:
    """Ranks of byte strings; built from the lines of a rank file (base64 of
    the bytes, then the rank)."""

    def __init__(self, lines: bytes):
        pairs = (line.split() for line in lines.splitlines() if line)
        self.ranks = {base64.b64decode(a): int(b) for a, b in pairs}
        missing = [b for b in range(256) if bytes([b]) not in self.ranks]
        if missing:
            raise ValueError(f"byte-level vocabulary lacks the bytes {missing[:5]}")

    @classmethod
    def load(cls, path: str) -> "Vocabulary":
        with open(path, "rb") as f:
            return cls(f.read())

    def merges(self) -> pa.Table:
        """(a, b, rank): every pair of tokens whose joined bytes are a token."""
        a, b, rank = [], [], []
        for piece, r in self.ranks.items():
            for i in range(1, len(piece)):
                x, y = self.ranks.get(piece[:i]), self.ranks.get(piece[i:])
                if x is not None and y is not None:
                    a.append(x), b.append(y), rank.append(r)
        return pa.table({"a": pa.array(a, pa.int32()), "b": pa.array(b, pa.int32()),
                         "rank": pa.array(rank, pa.int32())})

    def pieces(self) -> pa.Table:
        """(tok, piece): a character U+0000 to U+00FF stands for each byte."""
        return pa.table({"tok": pa.array(list(self.ranks.values()), pa.int32()),
                         "piece": pa.array([p.decode("latin-1") for p in self.ranks], pa.string())})


def _connect():
    import duckdb

    con = duckdb.connect()
    con.execute("set threads = 1")
    con.execute("set memory_limit = '400MB'")
    con.execute("set temp_directory = ''")
    return con


class Encoder:
    """Encodes words inside one task."""

    def __init__(self, vocabulary: Vocabulary):
        self.con = _connect()
        self.con.register("merges_in", vocabulary.merges())
        self.con.execute("create table merges as select * from merges_in")
        self.byte_rank = np.array([vocabulary.ranks[bytes([b])] for b in range(256)], np.int32)
        whole = ((p, r) for p, r in vocabulary.ranks.items())
        self.whole = {p: np.uint32(r).tobytes() for p, r in whole}
        self.known: dict[str, bytes] = {}

    def learn(self, words: set[str]) -> None:
        """Ids of words that are not known yet."""
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        todo, held = [], 0
        for w in words:
            raw = w.encode()
            ids = self.whole.get(raw)
            if ids is not None:
                self.known[w] = ids
                continue
            todo.append((w, raw))
            held += len(raw)
            if held > QUERY_BYTES:
                self._contract(todo)
                todo, held = [], 0
        if todo:
            self._contract(todo)

    def _contract(self, todo: list[tuple[str, bytes]]) -> None:
        n = np.array([len(raw) for _, raw in todo])
        first = np.cumsum(n) - n
        buf = np.frombuffer(b"".join(raw for _, raw in todo), np.uint8)
        pos = (np.arange(len(buf)) - np.repeat(first, n)).astype(np.int32)
        tok = self.byte_rank[buf]
        last = pos == np.repeat(n, n) - 1  # has no token after it
        rows = pa.table({
            "word": np.repeat(np.arange(len(todo), dtype=np.int32), n), "pos": pos, "tok": tok,
            "next_pos": np.where(last, -1, pos + 1).astype(np.int32),
            "next_tok": np.where(last, -1, np.append(tok[1:], -1)).astype(np.int32)})
        self.con.register("bytes_in", rows)
        out = self.con.execute(MERGE_SQL).fetchnumpy()
        ids = np.asarray(out["tok"]).astype("<u4").tobytes()
        end = np.cumsum(np.bincount(np.asarray(out["word"]), minlength=len(todo))) * 4
        a = 0
        for (w, _), z in zip(todo, end.tolist()):
            self.known[w] = ids[a:z]
            a = z


def _encode(lines, pattern: str):
    def run(batches):
        import regex

        coder, find = Encoder(Vocabulary(lines.value)), regex.compile(pattern).findall
        for b in batches:
            off, _ = text_bytes(b.column(1))
            for lo, hi in slices(off):
                texts = b.column(1).slice(lo, hi - lo).to_pylist()
                words = [find(t) if t else [] for t in texts]
                new = set()
                for w in words:
                    new.update(w)
                if len(coder.known) + len(new) > KNOWN_WORDS:
                    coder.known.clear()
                coder.learn(new.difference(coder.known))
                new.clear()
                ids = [b"".join(map(coder.known.__getitem__, w)) for w in words]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(ids, pa.binary())], ["key", "ids"])
        coder.con.close()
    return run


def _decode(lines):
    def run(batches):
        con = _connect()
        con.register("pieces_in", Vocabulary(lines.value).pieces())
        con.execute("create table pieces as select * from pieces_in")
        for b in batches:
            off, data = text_bytes(b.column(1).cast(pa.large_binary()).fill_null(b""))
            for lo, hi in slices(off, 4 * QUERY_IDS):
                ids = data[off[lo]:off[hi]].view("<u4")
                doc = np.repeat(np.arange(hi - lo), np.diff(off[lo:hi + 1]) // 4)
                out = [[] for _ in range(hi - lo)]
                for a in range(0, len(ids), QUERY_IDS):
                    part = pa.table({"doc": doc[a:a + QUERY_IDS], "pos": np.arange(a, min(a + QUERY_IDS, len(ids))),
                                     "tok": ids[a:a + QUERY_IDS].astype(np.int32)})
                    con.register("ids_in", part)
                    for d, piece in con.execute(DECODE_SQL).fetchall():
                        out[d].append(piece.encode("latin-1"))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                     pa.array([b"".join(x) for x in out], pa.binary())], ["key", "ids", "decoded"])
        con.close()
    return run


def _lines(df: DataFrame, path: str):
    with open(path, "rb") as f:
        lines = f.read()
    Vocabulary(lines)  # a faulty file fails here, not in a task
    return df.sparkSession.sparkContext.broadcast(lines)


def encode(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): packed ids of each whole text by the rank file ``path``,
    every match of ``pattern`` encoded by itself."""
    src = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return (src.mapInArrow(trimmed(_encode(_lines(df, path), pattern)), "key long, ids binary")
            .withColumnRenamed("key", key))


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, ids, decoded): the bytes of packed ids."""
    src = df.select(F.col(key).cast("long").alias("key"), F.col(ids).cast("binary").alias("ids"))
    return (src.mapInArrow(trimmed(_decode(_lines(df, path))), "key long, ids binary, decoded binary")
            .withColumnRenamed("key", key))


def round_trip(df: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids, decoded): ``decode(encode(df))`` with both steps in one
    Python worker of a task, so that ids cross to it and back once."""
    lines = _lines(df, path)
    src = df.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))

    def both(batches):
        yield from _decode(lines)(_encode(lines, pattern)(batches))

    return (src.mapInArrow(trimmed(both), "key long, ids binary, decoded binary")
            .withColumnRenamed("key", key))
