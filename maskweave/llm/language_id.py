"""Language identification by error-correcting output codes.

Every language has a codeword.  Each bit splits the languages in two sides and
has a binary classifier over hashed byte n-grams of the lower-cased text: the
log ratio of how often an n-gram occurs on either side.  A text's bit margins
are compared with all codewords by weighted logistic loss (a bit weighs as
much as it separates its sides); the nearest codeword is the prediction, and
``ambiguous`` is set when the second nearest is almost as near.

Counts for training come from rows with a language, at most about
``per_language`` rows of each, chosen by a hash of the row's key; they are
summed on the cluster and only languages x BUCKETS numbers reach the driver.
Prediction reads whole texts.  A text that is null or has no letter is
``und`` with score 0; so is every text when nothing was learned.  Repeated
rows are predicted alike, an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskweave.llm.common import slices, text_bytes, trimmed

BITS = 15
BUCKETS = 1 << BITS
SIZES = (1, 2, 3, 4)
#: Languages that one model may hold; beyond, fit fails instead of growing the driver.
MOST_LANGUAGES = 2000
#: Two codewords are told apart when their losses differ by this much.
CLEAR = 0.02

# white space, digits and ASCII signs all read as one space
_CLEAN = np.full(256, 0x20, np.uint8)
_CLEAN[0x61:0x7B] = np.arange(0x61, 0x7B)
_CLEAN[0x80:] = np.arange(0x80, 256)


def ngrams(data: np.ndarray, ends: np.ndarray):
    """For each n-gram length the bucket at every byte; BUCKETS where the
    n-gram would cross the end of its text."""
    data = _CLEAN[data]
    n = len(data)
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(n)
    gram = np.zeros(n, np.uint32)
    for k in range(max(SIZES)):
        gram[:n - k] = (gram[:n - k] << np.uint32(8)) | data[k:]
        if k + 1 in SIZES:
            bucket = ((gram ^ np.uint32(k + 1)) * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            yield np.where(left > k, bucket, BUCKETS).astype(np.int32)


def _lower(column):
    return pc.utf8_lower(pc.fill_null(column, ""))


def _count(batches):
    held: dict[str, np.ndarray] = {}
    for b in batches:
        langs = b.column(0).to_pylist()
        off, data = text_bytes(_lower(b.column(1)))
        for lo, hi in slices(off):
            part, ends = data[off[lo]:off[hi]], off[lo + 1:hi + 1] - off[lo]
            names = sorted(set(langs[lo:hi]))
            which = np.array([names.index(x) for x in langs[lo:hi]])
            at = np.repeat(which, np.diff(off[lo:hi + 1]))
            for bucket in ngrams(part, ends):
                n = np.bincount(at * (BUCKETS + 1) + bucket, minlength=len(names) * (BUCKETS + 1))
                for name, row in zip(names, n.reshape(len(names), -1)):
                    held.setdefault(name, np.zeros(BUCKETS, np.int64))
                    held[name] += row[:BUCKETS]
    for name, row in held.items():
        at = np.flatnonzero(row)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(row[at])],
            ["lang", "bucket", "n"])


def codewords(n: int) -> np.ndarray:
    """A +1/-1 row per language: all splits in two for up to 7 languages,
    beyond that the best of some drawn codes of 10 log2(n) bits."""
    if n <= 7:
        cols = [(1,) + c for c in itertools.product((1, -1), repeat=n - 1) if -1 in c]
        return np.array(cols, np.float64).reshape(-1, n).T
    bits, best, far = math.ceil(10 * math.log2(n)), None, -1
    for seed in range(50 if n <= 200 else 3):
        code = np.where(np.random.default_rng(seed).random((n, bits)) < 0.5, -1.0, 1.0)
        code = code[:, np.abs(code.sum(axis=0)) < n]
        same = code @ code.T
        apart = (code.shape[1] - (same - np.diag(np.full(n, np.inf))).max()) / 2
        if apart > far:
            best, far = code, apart
    return best


@dataclass
class Model:
    langs: list[str]
    code: np.ndarray      # languages x bits
    weights: np.ndarray   # bits x (BUCKETS + 1), the last column is 0
    share: np.ndarray     # weight of each bit

    def losses(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Weighted loss of each text (none is empty) and codeword."""
        starts = np.concatenate([[0], ends[:-1]])
        margin, grams = np.zeros((len(ends), len(self.weights))), np.zeros(len(ends))
        for bucket in ngrams(data, ends):
            grams += np.add.reduceat((bucket < BUCKETS).astype(np.int64), starts)
            for k, w in enumerate(self.weights):
                margin[:, k] += np.add.reduceat(w[bucket], starts)
        margin /= np.maximum(grams, 1)[:, None]
        return np.stack([(np.logaddexp(0, -4 * margin * c) * self.share).sum(axis=1) for c in self.code], axis=1)

    def decode(self, data: np.ndarray, ends: np.ndarray):
        """(index of the nearest codeword, score, ambiguous) of each text."""
        loss = self.losses(data, ends)
        order = np.sort(loss, axis=1)
        odds = np.exp(4 * (order[:, :1] - order))
        gap = order[:, 1] - order[:, 0] if loss.shape[1] > 1 else np.full(len(loss), np.inf)
        return loss.argmin(axis=1), 1 / odds.sum(axis=1), gap < CLEAR


def fit(rows: DataFrame, text: str = "text", lang: str = "lang", key: str = "doc_id",
        per_language: int = 20_000) -> Model:
    """Learns from the rows whose ``lang`` is not null."""
    rows = rows.where(F.col(lang).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).cast("string").alias("text"),
        F.pmod(F.xxhash64(F.lit("language id"), F.col(key).cast("string")), F.lit(1 << 30)).alias("draw"))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().limit(MOST_LANGUAGES + 1).collect()}
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    langs = sorted(sizes)
    if not langs:
        return Model([], np.zeros((0, 0)), np.zeros((0, BUCKETS + 1)), np.zeros(0))
    most = F.create_map(*[x for name in langs for x in
                          (F.lit(name), F.lit(math.ceil(min(1.0, per_language / sizes[name]) * (1 << 30))))])
    counts = (rows.where(F.col("draw") < most[F.col("lang")]).select("lang", "text")
              .mapInArrow(trimmed(_count), "lang string, bucket int, n long")
              .groupBy("lang", "bucket").agg(F.sum("n").alias("n")))
    freq = np.zeros((len(langs), BUCKETS))
    place = {name: i for i, name in enumerate(langs)}
    for batch in counts.toArrow().to_batches():
        at = [place[x] for x in batch.column(0).to_pylist()]
        freq[at, batch.column(1).to_numpy()] = batch.column(2).to_numpy()
    freq += 0.5
    freq /= freq.sum(axis=1, keepdims=True)
    code = codewords(len(langs))
    weights = np.zeros((code.shape[1], BUCKETS + 1), np.float32)
    share = np.zeros(code.shape[1])
    for k in range(code.shape[1]):
        p, q = freq[code[:, k] > 0].mean(axis=0), freq[code[:, k] < 0].mean(axis=0)
        ratio = np.log(p) - np.log(q)
        share[k] = ((p - q) * ratio).sum() / 2  # mean margin of a text of either side
        weights[k, :BUCKETS] = ratio / max(share[k], 1e-9)
    return Model(langs, code, weights, share / max(share.sum(), 1e-9))


def _predict(model, at: int):
    def run(batches):
        m = model.value
        for b in batches:
            column = b.column(at)
            n = len(column)
            letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            best, score, unsure = np.full(n, len(m.langs)), np.zeros(n), np.ones(n, bool)
            off, data = text_bytes(_lower(column))
            for lo, hi in slices(off) if m.langs else ():
                rows = lo + np.flatnonzero(letters[lo:hi])
                if len(rows):
                    sizes = off[rows + 1] - off[rows]
                    part = data[off[lo]:off[hi]][np.repeat(letters[lo:hi], np.diff(off[lo:hi + 1]))]
                    best[rows], score[rows], unsure[rows] = m.decode(part, np.cumsum(sizes))
            names = pa.array([*m.langs, "und"], pa.string())
            yield pa.RecordBatch.from_arrays(
                [*b.columns, names.take(pa.array(best)), pa.array(score), pa.array(unsure)],
                [*b.schema.names, "lang_pred", "score", "ambiguous"])
    return run


def predict(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with lang_pred, score (0 to 1) and ambiguous; columns of these
    names in ``df`` are replaced."""
    df = df.drop("lang_pred", "score", "ambiguous")
    schema = T.StructType(df.schema.fields + [T.StructField("lang_pred", T.StringType()),
                                              T.StructField("score", T.DoubleType()),
                                              T.StructField("ambiguous", T.BooleanType())])
    shared = df.sparkSession.sparkContext.broadcast(model)
    return df.mapInArrow(trimmed(_predict(shared, df.columns.index(text))), schema)
