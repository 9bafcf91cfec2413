"""LM scoring by deleted interpolation of bigram, unigram and uniform estimates.

    P(w | h) = a(b) c(h w) / c(h) + u(b) c(w) / N + z(b) / (V + 1),    b the bucket of c(h) by powers of two

c, N and V count the learning documents; V + 1 leaves one place for all unknown words, so the probabilities of a history sum to
one. The weights a, u, z of a bucket are learned by expectation-maximisation on held-out counts: each token of the learning
documents is scored with its own occurrence deleted from the counts. For that, deleted counts are gathered into cells (bucket,
bigram share, unigram count, in half powers of two), of which there are `CELLS` at most whatever the corpus; the driver gets the
weight of each cell and nothing else.

Counts are asked for blockwise (`key_exchange`): the upper 56 bits of 64-bit hashes stand for words and pairs. What a block has found is written
once, compressed, and scored when the weights are known.

Null and empty texts have the end token only. Repeated rows count and are scored each. A null doc_id counts as the empty text when
folds are made. Without learning documents N = V = 0 and every token has probability 1. Columns other than id and text are not
read.
"""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.llm import common, key_exchange

FOLDS = 10
BUCKETS = 64
STEPS = 128
CELLS = BUCKETS * STEPS * STEPS
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD6E8FEB86659FD93)
# Not words, since they are white space.
_END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))
_BEGIN = np.uint64(xxhash.xxh3_64_intdigest(b"\t"))


def _pairs(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    mixed = (before * _MIX) ^ (word * _TURN)
    mixed ^= mixed >> np.uint64(31)
    mixed *= _MIX
    return mixed ^ (mixed >> np.uint64(29))


def _tokens(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all tokens, an end after each text, and each text's number of tokens."""
    found = [text.lower().split() for text in texts]
    sizes = np.array([len(x) + 1 for x in found], np.int64)
    flat = np.full(int(sizes.sum()), _END, np.uint64)
    words = np.ones(len(flat), bool)
    words[np.cumsum(sizes) - 1] = False
    flat[words] = np.fromiter((xxhash.xxh3_64_intdigest(w) for x in found for w in x), np.uint64, int(words.sum()))
    return flat, sizes


def _keys(table: pa.Table):
    texts = [x for chunk in table["text"].chunks for x in common.raw_bytes(chunk)]
    flat, sizes = _tokens(texts)
    firsts = np.cumsum(sizes) - sizes
    before = np.concatenate([[_BEGIN], flat[:-1]])
    before[firsts] = _BEGIN
    learned = np.repeat(~table["held_out"].to_numpy(), sizes)
    kinds, places = [], []
    for values in (flat, _pairs(before, flat)):
        keys, place = np.unique(values, return_inverse=True)
        kinds.append((keys, np.bincount(place, learned, len(keys))))
        places.append(place)
    return kinds, (sizes, firsts, learned, places)


def _history(word: np.ndarray, firsts: np.ndarray, ends: int) -> np.ndarray:
    """How often each token's history was seen: the count of the word before, at a text's start that of all texts."""
    seen = np.concatenate([[0], word[:-1]])
    seen[firsts] = ends
    return seen


def bucket(count: np.ndarray) -> np.ndarray:
    """0 for 0, then 1 + floor(log2)."""
    return np.where(count > 0, np.log2(np.maximum(count, 1)).astype(np.int64) + 1, 0)


def _step(value: np.ndarray) -> np.ndarray:
    """Half powers of two, 0 for 0; values of at least 1."""
    return np.where(value > 0, np.minimum(np.log2(np.maximum(value, 1)) * 2, STEPS - 2).astype(np.int64) + 1, 0)


def _middle(step: np.ndarray) -> np.ndarray:
    return np.where(step > 0, 2.0 ** ((step - 0.5) / 2), 0.0)


_BLOCK = (
    "doc_ids array<long>, held_out array<boolean>, sizes array<long>, counts binary, ends long, "
    "cells array<long>, weights array<long>, types long, tokens long"
)
_BLOCK_NAMES = [x.split()[0] for x in _BLOCK.split(", ")]


def _block_row(*values) -> pa.Table:
    longs = pa.list_(pa.int64())
    types = (longs, pa.list_(pa.bool_()), longs, pa.binary(), pa.int64(), longs, longs, pa.int64(), pa.int64())
    return pa.table([pa.array([v], t) for v, t in zip(values, types, strict=True)], names=_BLOCK_NAMES)


def _found(table: pa.Table, totals: list[np.ndarray], state) -> pa.Table:
    if not table.num_rows:
        # Each range of words once: its types and tokens.
        parts = [struct.unpack("<qqq", x) for x in state]
        words = [x for x in parts if x[0] == 0]
        return _block_row([], [], [], b"", 0, [], [], sum(x[1] for x in words), sum(x[2] for x in words))
    kinds, (sizes, firsts, learned, places) = state
    word, pair = (t[p].astype(np.int64) for t, p in zip(totals, places, strict=True))
    ends = int(totals[0][np.searchsorted(kinds[0][0], _END)])
    history = _history(word, firsts, ends)
    own = learned.astype(np.int64)
    pair_left, word_left, history_left = ((x - own)[learned] for x in (pair, word, history))
    # The share of the history that the pair has is a fraction; its inverse is not.
    share = _step(np.where(pair_left > 0, history_left / np.maximum(pair_left, 1), 0))
    cells = (bucket(history_left) * STEPS + share) * STEPS + _step(word_left)
    cell, weight = np.unique(cells, return_counts=True)
    packed = zstandard.compress(key_exchange.planes(word.astype("<u8")) + key_exchange.planes(pair.astype("<u8")), 1)
    return _block_row(
        table["doc_id"].to_pylist(), table["held_out"].to_pylist(), sizes, packed, ends, cell, weight, 0, 0
    )


def _summary(kind: int, totals: np.ndarray) -> bytes:
    return struct.pack("<qqq", kind, int((totals > 0).sum()), int(totals.sum()))


def learn(cells: np.ndarray, weights: np.ndarray, types: int, tokens: int, rounds: int = 60) -> np.ndarray:
    """Weights of bigram, unigram and uniform for each bucket, by expectation-maximisation over the cells."""
    mixture = np.tile([0.3, 0.4, 0.3], (BUCKETS, 1))
    mixture[0] = [0.0, 0.5, 0.5]
    if len(cells):
        at = cells // (STEPS * STEPS)
        inverse = _middle(cells // STEPS % STEPS)
        given = np.stack(
            [
                np.where(inverse > 0, np.minimum(1.0, 1.0 / np.maximum(inverse, 1e-300)), 0.0),
                _middle(cells % STEPS) / max(1, tokens - 1), np.full(len(cells), 1.0 / (types + 1)),
            ],
            axis=1,
        )
        # One token's worth of each keeps every weight above zero, but for pairs after unseen words.
        prior = np.array([1e-3, 1e-3, 1e-3])
        for _ in range(rounds):
            joint = mixture[at] * given
            joint *= (weights / np.maximum(joint.sum(axis=1), 1e-300))[:, None]
            sums = np.stack([np.bincount(at, joint[:, k], BUCKETS) for k in range(3)], axis=1) + prior
            sums[0, 0] = 0.0
            mixture = sums / sums.sum(axis=1, keepdims=True)
    return mixture


def log10_probability(
    word: np.ndarray, pair: np.ndarray, history: np.ndarray, mixture: np.ndarray, types: int, tokens: int
) -> np.ndarray:
    at = mixture[bucket(history)]
    p = at[:, 0] * pair / np.maximum(history, 1) + at[:, 1] * word / max(1, tokens)
    # Without any learned token the uniform part is all there is.
    return np.log10(p + (at[:, 2] if tokens else 1.0) / (types + 1))


SCHEMA = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
)


def score(docs: DataFrame, folds: int = FOLDS) -> DataFrame:
    """One row per document: its fold, token counts, the base model's and this model's log10 probability."""
    spark = docs.sparkSession
    rows = common.texts_of(docs).withColumn("held_out", common.fold(F.col("doc_id"), folds) == 0)
    total = common.text_bytes(rows)
    dealt = key_exchange.with_blocks(rows, total, "doc_id", "text")
    folder = session.scratch(spark, "language-model")
    key_exchange.exchange(dealt, total, _keys, _found, _BLOCK, drop_bits=8, summary=_summary).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")
    size = blocks.agg(F.sum("types"), F.sum("tokens")).first()
    types, tokens = int(size[0] or 0), int(size[1] or 0)
    cell = blocks.select(F.explode(F.arrays_zip("cells", "weights")).alias("x")).groupBy("x.cells")
    got = cell.agg(F.sum("x.weights").alias("weight")).orderBy("cells").toPandas()
    mixture = learn(got["cells"].to_numpy(np.int64), got["weight"].to_numpy(float), types, tokens)

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for ids, held, sizes, packed, ends in zip(
            *(batch[c].to_pylist() for c in ("doc_ids", "held_out", "sizes", "counts", "ends")), strict=True
        ):
            raw = zstandard.decompress(packed)
            word, pair = (key_exchange.numbers(raw[k : k + len(raw) // 2], "<u8").astype(np.int64) for k in (0, len(raw) // 2))
            firsts = np.cumsum(sizes) - sizes
            mine = log10_probability(word, pair, _history(word, firsts, ends), mixture, types, tokens)
            base = np.log10((word + 0.1) / (tokens + 0.1 * (types + 1)))
            known, mine, base = (np.add.reduceat(x, firsts) for x in ((word > 0).astype(np.int64), mine, base))
            out.append(
                pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()), pa.array(held), pa.array(sizes, pa.int64()), pa.array(known),
                        pa.array([tokens] * len(ids), pa.int64()), pa.array(base), pa.array(mine),
                    ],
                    names,
                )
            )
        return pa.concat_batches(out)

    names = [x.split()[0] for x in SCHEMA.split(", ")]
    return common.map_arrow(blocks.where("size(sizes) > 0").drop("cells", "weights"), step, SCHEMA)
