"""Encoding the corpus to token ids.

Pre-tokenisation is a Spark expression (regex, JVM side).  The subword
step runs in one Arrow-batched ``mapInPandas`` over the word arrays: no
shuffle, a broadcast vocabulary (bounded by the vocabulary size and
checked); the distinct words of a slice of texts are encoded once, WordPiece
words side by side in numpy, others through a bounded per-task cache.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskweave.functions import text as TX
from maskweave.operators.pieces import PieceTable, points_of, spans_of

MAX_BROADCAST_PIECES = 1_000_000   # pieces, and merges, beyond this are refused
WORDPIECE_MAX_CHARS = 100          # default of a model's max_word_chars
CACHE_WORDS = 200_000              # per-task word cache size
LONG_WORD = 64                     # symbols beyond which a word's pairs are kept in a heap
SLICE_CHARS = 1 << 19              # characters a task encodes at a time (WordPiece)
SLICE_IDS = 1 << 18                # ids a task looks up at a time
MAX_TABLE = 1 << 24                # steps between nodes that are kept as a table


@dataclass
class TokenModel:
    """Plain-data description of an encoder; shipped once per executor."""
    kind: str                                  # wordpiece | bpe | byte | unigram
    ids: dict = field(default_factory=dict)    # piece -> id
    unk_id: int = 0
    ranks: dict = field(default_factory=dict)  # (left, right) -> rank (bpe, byte)
    scores: dict = field(default_factory=dict)  # piece -> log prob (unigram)
    max_piece: int = 0
    max_word_chars: int | None = WORDPIECE_MAX_CHARS  # wordpiece: longer words are [UNK]; None: no limit
    unk_score: float | None = None             # unigram: of a character with no piece; both set with the first word
    places: tuple | None = None                # unigram: place of each piece, scores and ids by place; likewise
    lengths: tuple = ()                        # lengths of pieces by their first (unigram: last) character
    trie: Trie | None = None                   # wordpiece: set with the first words

    def encode_word(self, w: str) -> list[int]:
        if self.kind == "wordpiece":
            return _wordpiece(self, w)
        if self.kind in ("bpe", "byte"):
            return _bpe(self, w)
        return _viterbi(self, w)


def _wordpiece(m: TokenModel, w: str) -> list[int]:
    """Greedy longest match from the left, '##' on continuations; the
    whole word becomes [UNK] when no piece matches or it is too long."""
    if m.max_word_chars is not None and len(w) > m.max_word_chars:
        return [m.unk_id]
    if not m.lengths:
        k = len(TX.CONT)
        m.lengths = (_lengths((p[0], len(p)) for p in m.ids if p),
                     _lengths((p[k], len(p) - k) for p in m.ids if p.startswith(TX.CONT) and len(p) > k))
    ids, n = m.ids, len(w)
    out, start = [], 0
    while start < n:
        hit = None
        for size in m.lengths[start > 0].get(w[start], ()):  # those of pieces that begin so
            piece = w[start:start + size]
            hit = ids.get(TX.CONT + piece if start else piece) if len(piece) == size else None
            if hit is not None:
                break
        if hit is None:
            return [m.unk_id]
        out.append(hit)
        start += size
    return out


def _lengths(found) -> dict[str, list[int]]:
    """The distinct lengths of each character's pieces, longest first."""
    out: dict = {}
    for c, size in found:
        out.setdefault(c, set()).add(size)
    return {c: sorted(sizes, reverse=True) for c, sizes in out.items()}


_HEX = [f"{b:02X}" for b in range(256)]


def _symbols(m: TokenModel, w: str) -> list[str]:
    if m.kind == "byte":
        return [_HEX[b] for b in w.encode("utf-8")]
    return list(w)


def _bpe(m: TokenModel, w: str) -> list[int]:
    """Repeatedly merge the adjacent pair of lowest rank (all its
    occurrences, left to right) until no ranked pair remains."""
    syms = _symbols(m, w)
    if len(syms) > LONG_WORD:
        return [m.ids.get(s, m.unk_id) for s in _merge_long(syms, m.ranks)]
    while len(syms) > 1:
        found = [(r, i) for i, r in enumerate(map(m.ranks.get, zip(syms, syms[1:]))) if r is not None]
        if not found:
            break
        i = min(found)[1]
        best = (syms[i], syms[i + 1])
        merged, out = best[0] + best[1], syms[:i]
        while i < len(syms):
            if i + 1 < len(syms) and (syms[i], syms[i + 1]) == best:
                out.append(merged)
                i += 2
            else:
                out.append(syms[i])
                i += 1
        syms = out
    return [m.ids.get(s, m.unk_id) for s in syms]


def _merge_long(syms: list, ranks: dict) -> list:
    """The same merges in n log n steps: a linked list of symbols and a heap
    of pairs by (rank, place).  A pair that a merge of rank r makes waits for
    the occurrences of r, even if its own rank is lower: it goes into the
    heap when the last of them is merged."""
    n = len(syms)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(ranks[p], i) for i, p in enumerate(zip(syms, syms[1:])) if p in ranks]
    heapq.heapify(heap)
    made: list = []
    while heap or made:
        if made:
            for x in made:
                heapq.heappush(heap, x)
            made = []
        rank = heap[0][0]
        while heap and heap[0][0] == rank:
            _, i = heapq.heappop(heap)
            j = after[i] if syms[i] is not None else n
            if j >= n or ranks.get((syms[i], syms[j])) != rank:
                continue  # one of the two went into another merge
            syms[i], syms[j] = syms[i] + syms[j], None
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n:
                    r = ranks.get((syms[k], syms[after[k]]))
                    if r is not None:
                        made.append((r, k))
    return [s for s in syms if s is not None]


UNK_PENALTY = 10.0


def _viterbi(m: TokenModel, w: str) -> list[int]:
    """Best-scoring segmentation by sum of log probabilities; a
    character with no piece becomes [UNK] at the lowest score minus a
    penalty (SentencePiece convention)."""
    n = len(w)
    if n == 0:
        return []
    if not m.lengths:
        m.lengths = (_lengths((p[-1], len(p)) for p in m.scores if p),)
    get, lengths = m.scores.get, m.lengths[0]
    if m.unk_score is None:
        m.unk_score = (min(m.scores.values()) if m.scores else 0.0) - UNK_PENALTY
    unk_score = m.unk_score
    best = [-math.inf] * (n + 1)
    back = [None] * (n + 1)
    best[0] = 0.0
    for end in range(1, n + 1):
        for size in lengths.get(w[end - 1], ()):  # those of pieces that end so
            start = end - size
            if start < 0 or best[start] == -math.inf:
                continue
            s = get(w[start:end])
            if s is not None and best[start] + s > best[end]:
                best[end], back[end] = best[start] + s, start
        if w[end - 1] not in m.scores and best[end - 1] + unk_score > best[end]:
            best[end], back[end] = best[end - 1] + unk_score, end - 1
    out, end = [], n
    while end > 0:
        start = back[end]
        piece = w[start:end]
        out.append(m.ids[piece] if piece in m.scores else m.unk_id)
        end = start
    return out[::-1]


SHORT = 30      # words of up to so many characters are segmented together, those of one length
GROUP = 2048    # at a time


def encode_many(m: TokenModel, words: list[str]) -> list[bytes]:
    """Packed ids of distinct words."""
    from array import array

    out = [None] * len(words)
    if m.kind == "unigram":
        size = np.fromiter(map(len, words), np.int64, len(words))
        for d in np.unique(size[(size > 0) & (size <= SHORT)]).tolist():
            of = np.flatnonzero(size == d)
            for lo in range(0, len(of), GROUP):
                some = of[lo:lo + GROUP].tolist()
                for i, got in zip(some, _viterbi_of_length(m, [words[i] for i in some])):
                    out[i] = got
    return [array("q", m.encode_word(w)).tobytes() if got is None else got for w, got in zip(words, out)]


def _viterbi_of_length(m: TokenModel, words: list[str]) -> list[bytes]:
    """``_viterbi`` of words of one length, side by side."""
    if m.places is None:
        pieces = list(m.scores)
        m.places = (PieceTable(pieces), np.array([*m.scores.values(), -math.inf]),
                    np.array([*(m.ids[p] for p in pieces), m.unk_id], np.int64))
    place, scores, ids = m.places
    unk_score = (scores[:-1].min() if len(scores) > 1 else 0.0) - UNK_PENALTY
    size, n, none, longest = len(words[0]), len(words), len(scores) - 1, max(1, m.max_piece)
    spans = spans_of(size, longest)
    at = place.edges(points_of(words), longest)
    by_end = sorted(range(len(spans)), key=lambda k: (spans[k][1], spans[k][0]))
    best, back, piece = np.full((size + 1, n), -math.inf), np.zeros((size + 1, n), np.int64), np.full((size + 1, n), none)
    best[0] = 0.0
    for k in by_end:
        (s, e), x = spans[k], scores[at[k]]
        if e - s == 1:
            x[at[k] == none] = unk_score
        v = best[s] + x
        better = v > best[e]
        best[e][better], back[e][better], piece[e][better] = v[better], s, at[k][better]
    path, cell, end = np.full((size, n), -1, np.int64), np.arange(n), np.full(n, size)
    for step in range(size - 1, -1, -1):
        on = end > 0
        path[step][on] = ids[piece[end[on], cell[on]]]
        end[on] = back[end[on], cell[on]]
    lens = (path >= 0).sum(axis=0).tolist()
    return [row[size - k:].tobytes() for row, k in zip(np.ascontiguousarray(path.T), lens)]


class Trie:
    """All pieces of a WordPiece model by their characters, as arrays.  Node 0
    is none, 1 the empty piece; ``go`` gives the node that a character of some
    class leads to."""

    def __init__(self, ids: dict):
        codes = sorted({ord(c) for p in ids for c in p} | set(map(ord, TX.CONT)))
        self.classes = np.zeros(0x110000, np.int32)
        self.classes[codes] = np.arange(1, len(codes) + 1)
        self.width = len(codes) + 1
        number = {chr(c): k for k, c in enumerate(codes, 1)}
        to: dict = {}
        self.accepts = [-1, -1]
        for piece, i in [*ids.items(), (TX.CONT, None)]:
            node = 1
            for c in piece:
                key = node * self.width + number[c]
                node = to.setdefault(key, len(self.accepts))
                if node == len(self.accepts):
                    self.accepts.append(-1)
            if i is not None and piece:
                self.accepts[node] = i
            elif i is None:
                self.inner = node
        self.accepts = np.array(self.accepts, np.int64)
        self.keys = np.array(sorted(to), np.int64)
        self.nodes = np.array([to[k] for k in self.keys.tolist()], np.int32)
        self.table = None
        if len(self.accepts) * self.width <= MAX_TABLE:
            self.table = np.zeros(len(self.accepts) * self.width, np.int32)
            self.table[self.keys] = self.nodes

    def go(self, node: np.ndarray, of: np.ndarray) -> np.ndarray:
        key = node.astype(np.int64) * self.width + of
        if self.table is not None:
            return self.table[key]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.nodes[at], 0)


def wordpieces(m: TokenModel, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """``_wordpiece`` of distinct segments side by side, as (ids, how many
    each has); gaps have none.  Each step reads one more character of every
    word that is not done."""
    if m.trie is None:
        m.trie = Trie(m.ids)
    t, n = m.trie, len(words)
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    whole = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), words), "")[0].as_py() if n else ""
    points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
    begin = np.cumsum(size + 1) - size - 1  # a class that leads nowhere stands after each word
    of = np.zeros(len(points) + n, np.int32)
    of[np.arange(len(points)) + np.repeat(np.arange(n), size)] = t.classes[points]
    end = begin + size
    real = TX.word_starts(points, np.cumsum(size) - size)
    long = real & (size > (WORDPIECE_MAX_CHARS if m.max_word_chars is None else m.max_word_chars))
    alone = [] if m.max_word_chars is not None else np.flatnonzero(long).tolist()  # too many steps for the others to wait
    out = np.full(len(of), -1, np.int64)
    bad = long.copy()
    word = np.flatnonzero(real & ~long)
    start = begin[word]
    at, node = start.copy(), np.ones(len(word), np.int32)
    best, upto = np.full(len(word), -1, np.int64), start.copy()
    while len(word):
        node = t.go(node, of[at])
        on = node > 0
        at += on
        got = t.accepts[node]
        hit = got >= 0
        best[hit], upto[hit] = got[hit], at[hit]
        stop = np.flatnonzero(~on)
        if not len(stop):
            continue
        out[start[stop]] = best[stop]
        bad[word[stop[best[stop] < 0]]] = True
        start[stop], at[stop], node[stop] = upto[stop], upto[stop], t.inner
        over = stop[(best[stop] < 0) | (upto[stop] == end[word[stop]])]
        best[stop] = -1
        if len(over):
            keep = np.ones(len(word), bool)
            keep[over] = False
            word, start, at, node, best, upto = (x[keep] for x in (word, start, at, node, best, upto))
    out[np.repeat(bad, size + 1)] = -1
    out[begin[bad]] = m.unk_id
    there = out >= 0
    lens = np.diff(np.append(0, np.cumsum(there)[end])) if n else size
    ids = out[there]
    if alone:
        parts = np.split(ids, np.cumsum(lens)[:-1])
        for i in alone:
            parts[i] = np.array(_wordpiece(m, words[i].as_py()), np.int64)
        ids, lens = np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
    return ids, lens


def token_model(vocab: DataFrame, kind: str, merges: DataFrame | None = None,
                max_word_chars: int | None = WORDPIECE_MAX_CHARS) -> TokenModel:
    """Collect the vocabulary and merges (bounded by their sizes, checked here)."""
    n = vocab.count()
    if n > MAX_BROADCAST_PIECES:
        raise ValueError(f"vocabulary of {n} pieces is too large to broadcast")
    rows = vocab.select("id", "piece", "score", "role").collect()
    ids = {r["piece"]: int(r["id"]) for r in rows}
    unk = next((int(r["id"]) for r in rows if r["role"] == "unk"), 0)
    m = TokenModel(kind=kind, ids=ids, unk_id=unk, max_piece=max((len(p) for p in ids), default=1),
                   max_word_chars=max_word_chars)
    if kind in ("bpe", "byte"):
        if merges is None:
            raise ValueError("bpe encoding needs the merge table")
        if merges.count() > MAX_BROADCAST_PIECES:
            raise ValueError(f"more than {MAX_BROADCAST_PIECES} merges are too large to broadcast")
        m.ranks = {(r["left"], r["right"]): int(r["rank"])
                   for r in merges.select("rank", "left", "right").collect()}
    if kind == "unigram":
        m.scores = {r["piece"]: float(r["score"]) for r in rows
                    if r["role"] is None and r["score"] is not None}
    return m


def encode_words(df: DataFrame, text: str, model: TokenModel, keep: list[str],
                 out: str = "input_ids") -> DataFrame:
    """Map each row's text to one id array.

    Arrow batches in and out (``mapInArrow``).  The worker pre-tokenises
    with the same classes of characters as the Spark expressions, cuts whole
    slices of a batch at once, dictionary-encodes the words, encodes only
    distinct words (WordPiece: side by side; others through a bounded per-task
    cache of packed ids) and rebuilds the per-row id lists with numpy gathers."""
    spark = df.sparkSession
    bc = spark.sparkContext.broadcast(model)
    fields = [f for f in df.schema.fields if f.name in keep]
    schema = T.StructType(fields + [T.StructField(out, T.ArrayType(T.LongType()))])
    kind = model.kind

    def run(batches):
        from itertools import chain

        def parts(rb):
            """Pieces of a batch of at most about ``most`` characters of text."""
            size = pc.cumulative_sum(pc.fill_null(pc.utf8_length(rb.column(text)), 0).cast(pa.int64()))
            size, lo = size.to_numpy(), 0
            while lo < rb.num_rows:
                base = size[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(size, base + most, "right")))
                yield rb.slice(lo, hi - lo)
                lo = hi

        m = bc.value
        how = "sp" if kind in ("bpe", "unigram") else kind
        most = SLICE_CHARS if kind == "wordpiece" else 2 * SLICE_CHARS  # their cache gains by larger ones
        cache: dict = {}
        for rb in chain.from_iterable(map(parts, batches)):
            found, lens = TX.segments(rb.column(text).to_pylist(), how)
            enc = pc.dictionary_encode(found)
            if kind == "wordpiece":
                u_flat, u_lens = wordpieces(m, enc.dictionary)
            else:
                words = enc.dictionary.to_pylist()
                new = [w for w in words if w not in cache]
                real = [w for w in new if not TX.is_gap(w, how)]
                made = dict.fromkeys(new, b"") | dict(zip(real, encode_many(m, real)))
                per = [made[w] if w in made else cache[w] for w in words]
                if len(cache) + len(made) > CACHE_WORDS:
                    cache.clear()
                cache.update(made)
                u_lens = np.fromiter(map(len, per), dtype=np.int64, count=len(per)) // 8
                u_flat = np.frombuffer(b"".join(per), np.int64)
            u_off = np.concatenate([[0], np.cumsum(u_lens)]).astype(np.int64)
            idx = enc.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            w_lens = u_lens[idx]
            w_cum = np.concatenate([[0], np.cumsum(w_lens)]).astype(np.int64)
            gather = np.repeat(u_off[idx] - w_cum[:-1], w_lens) + np.arange(int(w_cum[-1]), dtype=np.int64)
            row_off = w_cum[np.concatenate([[0], np.cumsum(lens)]).astype(np.int64)]
            ids = pa.ListArray.from_arrays(pa.array(row_off, pa.int32()), pa.array(u_flat[gather], pa.int64()))
            yield pa.RecordBatch.from_arrays([rb.column(k) for k in keep] + [ids], names=list(keep) + [out])

    return df.select(*keep, text).mapInArrow(run, schema)


def encode(df: DataFrame, vocab: DataFrame, kind: str = "wordpiece", text: str = "text",
           keys: tuple[str, ...] = ("doc_id",), merges: DataFrame | None = None,
           frame: bool = False, max_length: int | None = None,
           max_word_chars: int | None = WORDPIECE_MAX_CHARS) -> DataFrame:
    """(keys, input_ids, attention_mask, special_tokens_mask).

    ``frame`` wraps each row in [CLS] ... [SEP] (the base tokenizer does;
    learned WordPiece/SentencePiece files set no post-processor, so the
    default is off).  ``max_length`` optionally truncates (default none).
    ``max_word_chars`` is WordPiece's limit beyond which a word is [UNK]."""
    model = token_model(vocab, kind, merges, max_word_chars)
    enc = encode_words(df.select(*keys, F.col(text).alias("_text")), "_text", model, list(keys))
    ids = F.col("input_ids")
    if max_length:
        ids = F.slice(ids, 1, max_length - (2 if frame else 0))
    if frame:
        roles = {r["role"]: int(r["id"]) for r in vocab.filter("role is not null").collect()}
        ids = F.concat(F.array(F.lit(roles["cls"]).cast("bigint")), ids,
                       F.array(F.lit(roles["sep"]).cast("bigint")))
    enc = enc.withColumn("input_ids", ids)
    return with_masks(enc, special_ids(vocab))


def special_ids(vocab: DataFrame) -> list[int]:
    return sorted(int(r["id"]) for r in vocab.filter(F.col("role").isNotNull()).select("id").collect())


def with_masks(enc: DataFrame, specials: list[int]) -> DataFrame:
    """Attention mask (1 per real token) and special-tokens mask."""
    sp = F.array(*[F.lit(i).cast("bigint") for i in specials]) if specials else F.array().cast("array<bigint>")
    return (enc.withColumn("attention_mask", F.array_repeat(F.lit(1).cast("bigint"), F.size("input_ids")))
               .withColumn("special_tokens_mask",
                           F.transform("input_ids", lambda x: F.when(F.array_contains(sp, x), 1)
                                       .otherwise(0).cast("bigint"))))


@F.arrow_udf(T.StringType())
def _spaced(lists: pa.Array) -> pa.Array:
    parts = []
    for x in id_slices([lists], lambda rows: rows):
        at, values = flat_ids(x)
        of = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(values).cast(pa.string()), mask=x.is_null())
        parts.append(pc.binary_join(of, " "))
    return pa.concat_arrays(parts) if parts else pa.array([], pa.string())


def ids_string(c: str | Column) -> Column:
    """Array of ids as a space-joined string (scalar output for oracles)."""
    return _spaced(TX.col_of(c))


def decode_bytes(enc: DataFrame, vocab: DataFrame, ids: str = "input_ids") -> DataFrame:
    """``enc`` with ``text``: the text of byte-level ids.  The vocabulary
    (bounded, checked) is one broadcast of all pieces' bytes and where each
    id's begin; ids without a piece give none."""
    if vocab.count() > MAX_BROADCAST_PIECES:
        raise ValueError(f"more than {MAX_BROADCAST_PIECES} pieces are too large to broadcast")
    of = {int(r["id"]): bytes.fromhex(r["piece"]) for r in vocab.where("role is null").select("id", "piece").collect()}
    known = np.array(sorted(of), np.int64)
    ends = np.append(0, np.cumsum([len(of[i]) for i in known.tolist()], dtype=np.int64))
    bc = enc.sparkSession.sparkContext.broadcast((known, ends, np.frombuffer(b"".join(of[i] for i in known.tolist()), np.uint8)))

    @F.arrow_udf("binary")
    def raw(lists: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, ends, pieces = bc.value
        for part in id_slices(lists, lambda rows: rows):
            at, values = flat_ids(part)
            k = np.searchsorted(known, values)
            there = known[np.minimum(k, len(known) - 1)] == values if len(known) else np.zeros(len(values), bool)
            k = k[there]
            size = np.zeros(len(values), np.int64)
            size[there] = ends[k + 1] - ends[k]
            upto = np.append(0, np.cumsum(size))
            got = pieces[np.repeat(ends[k] - upto[:-1][there], size[there]) + np.arange(upto[-1])]
            offsets = pa.py_buffer(upto[at].astype(np.int32))
            valid = pa.py_buffer(np.packbits(part.is_valid().to_numpy(zero_copy_only=False), bitorder="little"))
            yield pa.Array.from_buffers(pa.binary(), len(part), [valid, offsets, pa.py_buffer(got)])

    return enc.withColumn("text", F.decode(raw(ids), "UTF-8"))


def flat_ids(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets from 0, ids) of a column of id lists."""
    at = lists.offsets.to_numpy().astype(np.int64)
    return at - at[0], lists.values[int(at[0]):int(at[-1])].to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def id_slices(batches, lists):
    """Parts of Arrow batches with about SLICE_IDS ids at most; ``lists``
    gives the id lists of a batch, an array or a tuple of arrays."""
    for b in batches:
        at, lo = lists(b).offsets.to_numpy(), 0
        n = len(at) - 1
        while lo < n:
            hi = max(lo + 1, int(np.searchsorted(at, at[lo] + SLICE_IDS, "right")) - 1)
            yield tuple(x.slice(lo, hi - lo) for x in b) if isinstance(b, tuple) else b.slice(lo, hi - lo)
            lo = hi


def resize_embeddings(vocab: DataFrame, old: DataFrame, id_col: str = "vec_id",
                      emb_col: str = "embedding") -> DataFrame:
    """One embedding row per vocabulary id.  Existing rows are kept;
    new ids get the mean of the old rows (deterministic).  The old table
    is bounded by the old vocabulary size, the mean is a single vector."""
    dim_rows = old.select(F.posexplode(emb_col).alias("d", "x"))
    mean = (dim_rows.groupBy("d").agg(F.avg("x").cast("float").alias("x"))
                    .agg(F.sort_array(F.collect_list(F.struct("d", "x"))).alias("_m"))
                    .select(F.col("_m.x").alias("_mean")))
    o = old.select(F.col(id_col).alias("id"), F.col(emb_col).alias("_old"))
    return (vocab.select("id").join(o, "id", "left").crossJoin(F.broadcast(mean))
                 .select("id", F.coalesce("_old", "_mean").alias("embedding")))
