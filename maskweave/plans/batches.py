"""The training-data plan end to end: corpus -> positioned, encoded rows
-> curriculum slices -> shuffled micro-batches -> masked, padded batches.

Shuffles: the position sort (keys only), the join of texts and positions, the
shuffle window (places and lengths, no ids), the join of its rows with their
ids, which are not sorted.  Encoding, slicing and masking are narrow; the
padding window reuses the shuffle partitioning when the buffer is a
multiple of the batch size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from maskweave.operators import collate as CO
from maskweave.operators import encode as EN
from maskweave.operators import position as P
from maskweave.operators import vocab as V
from maskweave.plans import curriculum as CU
from maskweave.plans.config import Curriculum
from maskweave.session import materialize, small_batches
from maskweave.sources import corpus as C


@dataclass
class TrainingData:
    n_rows: int
    encoded: DataFrame      # doc_id, pos, input_ids, attention_mask, special_tokens_mask
    batches: DataFrame      # slices (no ids) with epoch, phase, p, split, seq, block, micro_step, is_boundary
    masked: DataFrame       # batches + masked input_ids, labels, attention_mask (unpadded)
    padded: DataFrame       # masked, padded per batch
    batch_keys: list


def batch_keys(cfg: Curriculum) -> list[str]:
    keys = ["epoch", "phase", "split", "micro_step"]
    if cfg.block % cfg.batch == 0:
        keys.insert(3, "block")  # batches never straddle blocks: no new exchange
    return keys


def training_data(corpus: DataFrame, vocab: DataFrame, cfg: Curriculum, kind: str = "wordpiece",
                  merges: DataFrame | None = None, text_mode: str = "key",
                  key: str = "doc_id") -> TrainingData:
    small_batches(corpus.sparkSession)
    vocab, _ = V.ensure_pad(vocab)
    roles = {r["role"]: int(r["id"]) for r in vocab.filter("role is not null").collect()}
    n_vocab = vocab.count()
    t = C.resolve_text(corpus, text_mode, keys=(key,))
    # only the keys are sorted; positions meet the texts, which are a fraction
    # of their ids.  The encoded corpus is written once: later steps (slices,
    # frequencies, scores) read it instead of encoding again
    pos = materialize(P.with_position(t.select(key), order=(key,)), "positions")
    n = pos.count()
    ids = EN.encode(t.join(pos, key), vocab, kind, keys=(key, "pos"), merges=merges).select(key, "pos", "input_ids")
    ids = ids.withColumn("_row", F.monotonically_increasing_id()).withColumn("_max", F.size("input_ids"))
    specials = EN.special_ids(vocab)
    written = materialize(ids, "encoded")
    enc = EN.with_masks(written.drop("_row", "_max"), specials)  # masks follow from the ids
    # slices, order and batches need a row's place and length only; the ids
    # join them once, streamed past each task's share of the plan
    mb = CU.with_epochs(CU.micro_batches(CU.shuffled(CU.slices(written.drop("input_ids"), cfg, n), cfg, key), cfg), cfg)
    keys = batch_keys(cfg)
    rows = CO.with_longest(mb, keys, F.col("_max")).hint("shuffle_hash").join(written.select("_row", "input_ids"), "_row")
    masked = CO.mlm_mask(rows.drop("_row"), specials, roles["mask"], n_vocab, cfg.seed, keys=("epoch", "phase", "split", key))
    padded = CO.pad_batches(masked, roles["pad"], keys)
    masked = masked.drop("_max")
    return TrainingData(n, enc, mb.drop("_row", "_max"), masked, padded, keys)
