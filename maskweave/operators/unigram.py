"""Unigram language-model vocabulary (D8) by EM and pruning.

1. Seed: every substring of up to ``max_piece`` characters of each word
   type, frequency = sum of word counts, score = frequency x length; the
   best ``seed_size`` plus every single character.  Suffixes are sorted, one
   for each character of the word types; a substring is an interval of them.
2. E-step: forward-backward in the tasks, over a broadcast model, in numpy
   for many word types of one length at a time.  Which seeds stand where in
   the words is found once (``lattice``); a step looks up probabilities only.
   Each task emits partial expected counts per piece, which are summed into a
   table.
3. M-step: pieces under ``min_count`` dropped (characters kept); log
   probabilities renormalised by the sum, the only number that comes back.
4. Prune: the cost of removing a piece = its expected count times the
   log-probability it loses when its string is re-segmented without it,
   computed in tasks over the table of pieces.  Keep the best ``shrink`` share
   per round down to ``overshoot`` x target, then cut to the target by log
   probability.  Ranks come from a distributed sort.

Pieces, counts and costs are tables.  What passes the driver is the model on
its way to the broadcast, packed as two Arrow arrays (checked against
MAX_BROADCAST_PIECES), and scalars.

The native SentencePiece trainer cannot be reproduced bit for bit; this
is our contract.  Plain maximum likelihood (no digamma smoothing).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.operators import vocab as V
from maskweave.operators.encode import MAX_BROADCAST_PIECES
from maskweave.operators.pieces import PieceTable, points_of, spans_of
from maskweave.operators.position import nth_key, with_position
from maskweave.session import discard, materialize

NEG = -math.inf


def _lse(a: float, b: float) -> float:
    if a == NEG:
        return b
    if b == NEG:
        return a
    m = max(a, b)
    return m + math.log(math.exp(a - m) + math.exp(b - m))


#: Words of up to so many characters are summed as probabilities, not as logs.
SHORT = 30
#: Words of one length that are summed together.
GROUP = 2048
#: Words whose pieces are kept in one row.
BLOCK = 4096
#: Tasks of an E-step, if there are not more cores.
SUM_TASKS = 32


def _short_sums(w: str, lp: dict, max_piece: int):
    """``forward_backward`` of a word whose probabilities do not underflow."""
    n, get, edges = len(w), lp.get, []
    for s in range(n):
        for e in range(s + 1, min(n, s + max_piece) + 1):
            v = get(w[s:e])
            if v is not None:
                edges.append((s, e, math.exp(v)))
    alpha, beta = [1.0] + [0.0] * n, [0.0] * n + [1.0]
    for s, e, x in edges:  # by start: all edges into s came before
        alpha[e] += alpha[s] * x
    if not alpha[n]:
        return None
    for s, e, x in reversed(edges):
        beta[s] += x * beta[e]
    z, out = alpha[n], {}
    for s, e, x in edges:
        c = alpha[s] * x * beta[e] / z
        if c:
            p = w[s:e]
            out[p] = out.get(p, 0.0) + c
    return out, math.log(z)


def forward_backward(w: str, lp: dict, max_piece: int):
    """Expected piece counts of one word and its log-likelihood."""
    n = len(w)
    if n <= SHORT:
        got = _short_sums(w, lp, max_piece)
        if got is not None:
            return got
    alpha = [NEG] * (n + 1)
    alpha[0] = 0.0
    for e in range(1, n + 1):
        acc = NEG
        for s in range(max(0, e - max_piece), e):
            if alpha[s] == NEG:
                continue
            v = lp.get(w[s:e])
            if v is not None:
                acc = _lse(acc, alpha[s] + v)
        alpha[e] = acc
    z = alpha[n]
    if z == NEG:
        return {}, NEG
    beta = [NEG] * (n + 1)
    beta[n] = 0.0
    for s in range(n - 1, -1, -1):
        acc = NEG
        for e in range(s + 1, min(n, s + max_piece) + 1):
            if beta[e] == NEG:
                continue
            v = lp.get(w[s:e])
            if v is not None:
                acc = _lse(acc, v + beta[e])
        beta[s] = acc
    out: dict = {}
    for s in range(n):
        if alpha[s] == NEG:
            continue
        for e in range(s + 1, min(n, s + max_piece) + 1):
            v = lp.get(w[s:e])
            if v is None or beta[e] == NEG:
                continue
            c = math.exp(alpha[s] + v + beta[e] - z)
            if c > 0:
                out[w[s:e]] = out.get(w[s:e], 0.0) + c
    return out, z


def best_segmentation(w: str, lp: dict, max_piece: int, exclude: str | None = None) -> float:
    """Viterbi log probability of ``w`` without the piece ``exclude``."""
    n = len(w)
    best = [NEG] * (n + 1)
    best[0] = 0.0
    for e in range(1, n + 1):
        for s in range(max(0, e - max_piece), e):
            if best[s] == NEG:
                continue
            p = w[s:e]
            if p == exclude:
                continue
            v = lp.get(p)
            if v is not None and best[s] + v > best[e]:
                best[e] = best[s] + v
    return best[n]


def _substrings(max_piece: int):
    """(piece, freq, ends) of sorted suffixes: every substring with the sum
    over its interval.  ``ends`` marks intervals that reach the first or the
    last row of the batch and may go on in a neighbour."""
    def run(batches):
        for b in batches:
            texts, n = b.column(0).to_pylist(), b.column(1).to_numpy()
            if not texts:
                continue
            size = np.array([len(t) for t in texts])
            points = np.frombuffer("".join(t.ljust(max_piece, "\0") for t in texts).encode("utf-32-le"), np.uint32)
            points = points.reshape(len(texts), max_piece)
            same = (points[1:] == points[:-1]) & (np.arange(max_piece) < np.minimum(size[1:], size[:-1])[:, None])
            shared = np.append(-1, np.logical_and.accumulate(same, axis=1).sum(axis=1))
            for d in range(1, max_piece + 1):
                rows = np.flatnonzero(size >= d)
                if not len(rows):
                    break
                begins = np.flatnonzero(shared[rows] < d)
                freq = np.add.reduceat(n[rows], begins)
                first, last = rows[begins], rows[np.append(begins[1:], len(rows)) - 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([texts[i][:d] for i in first.tolist()], pa.string()), pa.array(freq),
                     pa.array((first == 0) | (last == len(texts) - 1))], ["piece", "freq", "ends"])
    return run


def seed_pieces(word_counts: DataFrame, max_piece: int = 16) -> DataFrame:
    """(piece, freq, score): frequencies of the substrings of up to
    ``max_piece`` characters of all words.  One suffix for each character is
    shuffled, not its substrings."""
    starts = word_counts.filter(F.length("word") > 0).select(
        "word", "n", F.explode(F.sequence(F.lit(0), F.length("word") - 1)).alias("st"))
    suffixes = (starts.select(F.substring("word", F.col("st") + 1, F.lit(max_piece)).alias("suffix"), "n")
                .groupBy("suffix").agg(F.sum("n").cast("bigint").alias("n")))
    found = (suffixes.repartitionByRange("suffix").sortWithinPartitions("suffix")
             .mapInArrow(_substrings(max_piece), "piece string, freq bigint, ends boolean"))
    found = materialize(found, "substrings")
    agg = found.where("not ends").select("piece", "freq").union(
        found.where("ends").groupBy("piece").agg(F.sum("freq").cast("bigint").alias("freq")))
    return agg.withColumn("score", (F.col("freq") * F.char_length("piece")).cast("bigint"))


@dataclass
class UnigramModel:
    vocab: DataFrame          # id, piece, score (log prob), role
    loglik: list              # objective after each EM step


_models: dict = {}  # of the broadcasts that a Python worker met last


def _once(bc, what: str, make):
    """``make`` of a broadcast's value, once per Python worker."""
    value = bc.value
    if _models.get(what, (None,))[0] is not value:
        _models[what] = value, make(value)
    return _models[what][1]


def _model_of(bc) -> dict:
    """Piece to ``lp`` of the broadcast arrays."""
    return _once(bc, "lp", lambda v: dict(zip(v[0].to_pylist(), v[1].to_pylist())))


def _places_of(known) -> dict:
    return _once(known, "places", lambda pieces: {p: k for k, p in enumerate(pieces.to_pylist())})


def _table_of(known) -> PieceTable:
    return _once(known, "table", lambda pieces: PieceTable(pieces.to_pylist()))


def _sums_of_equal_length(words: list, place: dict, probs: np.ndarray, max_piece: int):
    """(word, place, c, z) of words of one length: ``_sums_at`` of the places
    of their spans, without the counts of 0."""
    size, none = len(words[0]), len(probs) - 1
    at = np.array([place.get(w[s:e], none) for w in words for s, e in spans_of(size, max_piece)], np.int64)
    at = at.reshape(len(words), -1).T
    c, z = _sums_at(size, at, probs, max_piece)
    k, word = np.nonzero(c)  # a word's edges stay in their order
    return word, at[k, word], c[k, word], z


def _sums_at(size: int, at: np.ndarray, probs: np.ndarray, max_piece: int):
    """(c, z) of words of one length (SHORT at most): the expected counts of
    their edges, and each word's log likelihood, -inf where its sums underflow
    or it has no segmentation: its counts are 0.  ``at`` has the places of
    their spans, ``probs`` ends with the 0 of no piece."""
    spans, words = spans_of(size, max_piece), at.shape[1]
    x = probs[at]
    alpha, beta = np.zeros((size + 1, words)), np.zeros((size + 1, words))
    alpha[0] = beta[size] = 1.0
    for k, (s, e) in enumerate(spans):  # by start: all edges into s came before
        alpha[e] += alpha[s] * x[k]
    for k in range(len(spans) - 1, -1, -1):
        s, e = spans[k]
        beta[s] += x[k] * beta[e]
    z = alpha[size]
    good = z > 0
    starts, ends = np.array(spans).T
    c = np.divide(alpha[starts] * x * beta[ends], z, out=np.zeros(x.shape), where=good)
    return c, np.log(z, out=np.full(words, NEG), where=good)


def _repeats(at: np.ndarray, none: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges whose piece stands further left in the word as well, and the
    first edges with it, both in the flat order of ``at``."""
    flat = np.flatnonzero(at.ravel() < none)
    key = flat % at.shape[1] * (none + 1) + at.ravel()[flat]
    order = np.argsort(key, kind="stable")
    key, flat = key[order], flat[order]
    new = np.append(True, key[1:] != key[:-1])[:len(key)]
    first = flat[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))] if len(key) else flat
    again, first = flat[~new], first[~new]
    order = np.argsort(again, kind="stable")  # a piece's edges stay in their order
    return again[order], first[order]


def _groups(size: np.ndarray):
    """(length, words) of the words of a block that are summed together."""
    for d in np.unique(size[size <= SHORT]).tolist():
        of = np.flatnonzero(size == d)
        for lo in range(0, len(of), GROUP):
            yield d, of[lo:lo + GROUP]


_BLOCK = "words binary, size binary, n binary, there binary, places binary, sums binary, repeats binary, firsts binary"


@dataclass
class Lattice:
    """The pieces of a model in all words, found once for all E-steps of
    models that have no others: a row for each BLOCK words."""
    table: DataFrame
    pieces: pa.Array
    known: object             # broadcast of ``pieces``
    max_piece: int


def lattice(words: DataFrame, model: DataFrame, max_piece: int = 16) -> Lattice:
    pieces = _model_arrays(model)[0]
    known = model.sparkSession.sparkContext.broadcast(pieces)

    def run(batches):
        table, none = _table_of(known), len(known.value)
        for b in batches:
            for lo in range(0, b.num_rows, BLOCK):
                part = b.slice(lo, BLOCK)
                words, n = part.column(0).to_pylist(), part.column(1).to_numpy()
                size = np.fromiter(map(len, words), np.int64, len(words))
                found: list = [[], [], [], [], []]
                for _, some in _groups(size):
                    at = table.edges(points_of([words[i] for i in some.tolist()]), max_piece)
                    there = at < none
                    again, first = _repeats(at, none)
                    for out, x in zip(found, (np.packbits(there), at[there], np.array([there.sum(), len(again)]), again, first)):
                        out.append(x)
                kinds = (np.uint8, np.int32, np.int64, np.int32, np.int32)
                blobs = [np.concatenate([np.zeros(0, kind), *x]).astype(kind).tobytes() for kind, x in zip(kinds, found)]
                blobs = ["".join(words).encode(), size.tobytes(), n.astype(np.int64).tobytes(), *blobs]
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in blobs],
                                                 ["words", "size", "n", "there", "places", "sums", "repeats", "firsts"])

    return Lattice(words.select("word", "n").mapInArrow(run, _BLOCK), pieces, known, max_piece)


def _edges_of(block: list, none: int, max_piece: int):
    """(words, places of their spans, repeats, their firsts) of each group."""
    size, there, places, sums, repeats, firsts = block
    bit = hit = again = 0
    for k, (d, some) in enumerate(_groups(size)):
        shape = len(spans_of(d, max_piece)), len(some)
        room, (hits, twice) = shape[0] * shape[1], sums[2 * k:2 * k + 2].tolist()
        at = np.full(room, none, np.int32)
        bits = np.unpackbits(there[bit:bit + -(-room // 8)], count=room)
        at[bits.view(bool)] = places[hit:hit + hits]
        yield d, some, at.reshape(shape), repeats[again:again + twice], firsts[again:again + twice]
        bit, hit, again = bit + -(-room // 8), hit + hits, again + twice


def _model_arrays(model: DataFrame) -> tuple[pa.Array, pa.Array]:
    n = model.count()
    if n > MAX_BROADCAST_PIECES + 200_000:  # the seeds, and single characters
        raise ValueError(f"a model of {n} pieces is too large to broadcast")
    t = model.select("piece", "lp").toArrow()
    return t["piece"].combine_chunks(), t["lp"].combine_chunks()


def _broadcast(model: DataFrame):
    return model.sparkSession.sparkContext.broadcast(_model_arrays(model))


def expected_counts(words: DataFrame | Lattice, model: DataFrame, max_piece: int = 16) -> tuple[DataFrame, float]:
    """E-step: (piece, c) over ``words`` (word, n), or their lattice, under
    ``model`` (piece, lp), and the log likelihood.  A task sums over all its
    blocks; their number is bounded (SUM_TASKS, or the cores), as each gives a
    row for every piece."""
    lat = words if isinstance(words, Lattice) else lattice(words, model, max_piece)
    known, max_piece, spark = lat.known, lat.max_piece, model.sparkSession
    pieces, lp = _model_arrays(model)
    place = pc.index_in(pieces.cast(lat.pieces.type), lat.pieces)
    if place.null_count:
        raise ValueError("the model has pieces that its lattice lacks")
    probs = np.zeros(len(lat.pieces) + 1)
    probs[place.to_numpy()] = [*map(math.exp, lp.to_pylist())]  # the same digits as in forward_backward
    bc, now = spark.sparkContext.broadcast((pieces, lp)), spark.sparkContext.broadcast(probs)

    def run(batches):
        probs, none = now.value, len(known.value)
        acc, ll = np.zeros(none + 1), 0.0

        def alone(i, w):
            cnt, z = forward_backward(w, _model_of(bc), max_piece)
            if z == NEG:
                raise ValueError(f"no segmentation of a word of {len(w)} characters: {w[:50]!r}")
            place = _places_of(known)
            return np.full(len(cnt), i), np.array([place[p] for p in cnt], np.int64), np.array([*cnt.values()]), z

        for row in (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))):
            size, n, there, places, sums, repeats, firsts = (
                np.frombuffer(x, kind) for x, kind in zip(row[1:], (np.int64, np.int64, np.uint8, np.int32, np.int64, np.int32, np.int32)))
            rest, edges = np.flatnonzero(size > SHORT).tolist(), []
            for d, some, at, again, first in _edges_of((size, there, places, sums, repeats, firsts), none, max_piece):
                c, z = _sums_at(d, at, probs, max_piece)
                flat = c.ravel()
                np.add.at(flat, first, flat[again])  # a piece's counts in a word first
                flat[again] = 0.0
                k, word = np.nonzero(c)
                edges.append((some[word], at[k, word], c[k, word]))
                ll += float((n[some] * z)[z > NEG].sum())
                rest += some[z == NEG].tolist()
            if rest:
                whole, ends = row[0].decode(), np.cumsum(size)
                for i in rest:
                    *got, z = alone(i, whole[ends[i] - size[i]:ends[i]])
                    edges.append(got)
                    ll += float(n[i] * z)
            if edges:  # word after word, so that a piece's sum has the same digits however the words were grouped
                word, at, c = (np.concatenate([e[k] for e in edges]) for k in range(3))
                order = np.argsort(word.astype(np.uint16), kind="stable")
                word = word[order]
                np.add.at(acc, at[order], c[order] * n[word])
        there = np.flatnonzero(acc[:-1])
        yield pa.RecordBatch.from_arrays([pa.array([None], pa.string()), pa.array([ll], pa.float64())], ["piece", "c"])
        yield pa.RecordBatch.from_arrays([known.value.take(pa.array(there)).cast(pa.string()), pa.array(acc[there])], ["piece", "c"])

    table = lat.table.coalesce(max(SUM_TASKS, spark.sparkContext.defaultParallelism))
    got = materialize(table.mapInArrow(run, "piece string, c double")
                      .groupBy("piece").agg(F.sum("c").alias("c")), "unigram-counts")
    bc.unpersist()
    now.unpersist()
    ll = got.where("piece is null").agg(F.sum("c")).first()[0] or 0.0
    out = got.where("piece is not null")
    out._maskweave_path = got._maskweave_path
    return out, ll


def _log_share(counts: DataFrame, name: str) -> DataFrame:
    """(piece, c, lp): log of each count's share of their sum."""
    total = counts.agg(F.sum("c")).first()[0]
    return materialize(counts.select("piece", "c", F.log(F.col("c") / F.lit(total)).alias("lp")), name)


def _m_step(counts: DataFrame, chars: DataFrame, min_count: float) -> DataFrame:
    one = F.char_length("piece") == 1
    kept = counts.where(~one & (F.col("c") >= min_count)).select("piece", "c")
    single = chars.join(counts, "piece", "left").select("piece", F.coalesce("c", F.lit(float(min_count))).alias("c"))
    return _log_share(kept.union(single), "unigram-model")


def _first(rows: DataFrame, by: str, n: int) -> DataFrame:
    """The ``n`` rows with the greatest ``by``, ties by piece."""
    ranked = with_position(rows.withColumn("_down", -F.col(by)), ("_down", "piece"), name="unigram-rank")
    return ranked.where(F.col("pos") < n).drop("_down", "pos")


def _costs(model: DataFrame, max_piece: int) -> DataFrame:
    """(piece, cost) of all pieces but single characters."""
    bc = _broadcast(model)

    def run(batches):
        table = _model_of(bc)
        for b in batches:
            pieces, cost = b.column(0).to_pylist(), []
            for p, c in zip(pieces, b.column(1).to_pylist()):
                alt = best_segmentation(p, table, max_piece, exclude=p)
                cost.append(math.inf if alt == NEG else c * (table[p] - alt))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cost, pa.float64())], ["piece", "cost"])

    return model.where(F.char_length("piece") > 1).select("piece", "c").mapInArrow(run, "piece string, cost double")


def initial_model(words: DataFrame, seed_size: int = 1_000_000, max_piece: int = 16) -> DataFrame:
    """(piece, c, lp): the best seeds and all characters, by frequency."""
    seed = materialize(seed_pieces(words, max_piece), "unigram-seed")
    one = F.char_length("piece") == 1
    long = seed.where(~one).withColumn("_down", -F.col("score"))
    cut = nth_key(long, seed_size, "_down") if seed_size > 0 else None  # only the best and their ties are sorted
    best = long.where(F.col("_down") <= F.lit(cut)) if cut is not None else long
    best = _first(best.drop("_down"), "score", seed_size).union(seed.where(one))
    out = _log_share(best.select("piece", F.col("freq").cast("double").alias("c")), "unigram-model")
    discard(seed)
    return out


def to_vocab(model: DataFrame) -> DataFrame:
    """(id, piece, score, role): the control ids, then the pieces by log
    probability."""
    ranked = with_position(model.select("piece", "lp", (-F.col("lp")).alias("_down")), ("_down", "piece"),
                           name="unigram-vocab")
    control = model.sparkSession.createDataFrame(
        [(i, piece, 0.0, role) for role, i, piece in V.CONTROL_IDS], V.VOCAB_SCHEMA)
    first = len(V.CONTROL_IDS)
    return control.union(ranked.select((F.col("pos") + first).cast(control.schema["id"].dataType), "piece",
                                       F.col("lp").alias("score"), F.lit(None).cast("string").alias("role")))


def train_unigram(word_counts: DataFrame, vocab_size: int = 32768, seed_size: int = 1_000_000,
                  max_piece: int = 16, em_steps: int = 2, shrink: float = 0.75,
                  overshoot: float = 1.1, min_count: float = 0.5, max_rounds: int = 64) -> UnigramModel:
    """Learn a unigram vocabulary of ``vocab_size`` pieces including
    the four control ids."""
    words = word_counts.filter(F.length("word") > 0).select("word", "n").persist(StorageLevel.MEMORY_AND_DISK)
    model = initial_model(words, seed_size, max_piece)
    chars = materialize(model.where(F.char_length("piece") == 1).select("piece"), "unigram-chars")
    n_chars, size = chars.count(), model.count()
    target = vocab_size - len(V.CONTROL_IDS)
    history: list = []
    if size:  # blocks are cached row by row; Parquet's reader would hold thousands of them at once
        lat = lattice(words, model, max_piece)
        lat.table = lat.table.persist(StorageLevel.DISK_ONLY)

    def em(model):
        counts, ll = expected_counts(lat, model, max_piece)
        history.append(ll)
        out = _m_step(counts, chars, min_count)
        discard(counts, model)
        return out

    for _ in range(max_rounds if size else 0):
        for _ in range(em_steps):
            model = em(model)
        size = model.count()
        if size <= max(target, int(overshoot * target)):
            break
        goal = max(int(overshoot * target), int(size * shrink))
        kept = _first(_costs(model, max_piece), "cost", max(0, goal - n_chars)).select("piece").union(chars)
        old, model = model, materialize(model.join(kept, "piece", "left_semi"), "unigram-model")
        discard(old)
    else:
        if size:
            raise RuntimeError(f"unigram training: {size} pieces left after {max_rounds} rounds, {target} wanted")
    if size:
        model = em(model)
        if model.count() > target:
            long = _first(model.where(F.char_length("piece") > 1), "lp", max(0, target - n_chars))
            left = long.union(model.where(F.char_length("piece") == 1)).withColumn("c", F.exp("lp"))
            model = _log_share(left.select("piece", "c"), "unigram-model")
        lat.table.unpersist()
    words.unpersist()
    return UnigramModel(to_vocab(model), history)
