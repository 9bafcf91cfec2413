"""Quality classifier: histogram gradient-boosted trees over document statistics.

The trees are grown on the driver from a bounded sample of labelled rows (`TRAIN_ROWS`), flattened into
arrays, and every text of the table is scored by numpy, a batch at a time: each round moves all rows of
the batch one level down in all trees.

Null and empty texts have all statistics at zero and get a score like any other; repeated rows are scored
each; an empty label table gives the score 0.5; columns other than id and text are never read.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm import common

TRAIN_ROWS = 20_000
THRESHOLD = 0.3

FEATURES = (
    "log_words", "log_bytes", "mean_word", "long_words", "short_words", "upper", "digits", "symbols", "marks",
    "full_stops", "exclamations", "pipes", "beyond_ascii", "white", "distinct_words", "top_word", "same_as_before",
    "distinct_pairs", "distinct_triples", "line_words", "ended_lines", "repeated_lines", "upper_words",
    "symbol_words", "sentence_words", "byte_entropy",
)
_CLASS = np.zeros((256, 9))
for _k, _chars in enumerate((
    b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"#*$%&|<>@^~_=+{}[]\\/", b"!\"'(),-.:;?", b".", b"!", b"|",
    bytes(range(128, 256)), common.WHITE,
)):
    _CLASS[list(_chars), _k] = 1.0
_ENDS = (b".", b"!", b"?", b":", b'"', b"'", b")")
_SYMBOL_END = (b"#", b"*", b"$", b"%", b"&", b"|", b"<", b">", b"!!")


def statistics(texts: list[bytes]) -> np.ndarray:
    """One row of FEATURES for each text."""
    out = np.zeros((len(texts), len(FEATURES)))
    for row, text in zip(out, texts, strict=True):
        words = text.split()
        n = len(words)
        if not n:
            continue
        size = len(text)
        histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
        shares = histogram @ _CLASS / size
        seen = histogram[histogram > 0] / size
        lengths = np.fromiter(map(len, words), np.int64, n)
        lines = [x for x in text.split(b"\n") if not x.isspace() and x]
        pairs = max(1, n - 1)
        triples = max(1, n - 2)
        row[:] = (
            np.log1p(n), np.log1p(size), lengths.mean(), (lengths > 20).mean(), (lengths < 3).mean(), *shares,
            len(set(words)) / n, Counter(words).most_common(1)[0][1] / n,
            sum(map(bytes.__eq__, words, words[1:])) / pairs,
            len(set(zip(words, words[1:], strict=False))) / pairs,
            len(set(zip(words, words[1:], words[2:], strict=False))) / triples,
            min(200.0, n / len(lines)), sum(x.rstrip().endswith(_ENDS) for x in lines) / len(lines),
            1 - len(set(lines)) / len(lines), sum(map(bytes.isupper, words)) / n,
            sum(x.endswith(_SYMBOL_END) for x in words) / n,
            min(200.0, n / (1 + sum(x.endswith(_ENDS[:3]) for x in words))), float(-(seen * np.log2(seen)).sum()),
        )
    return out


@dataclass(frozen=True)
class Trees:
    """All trees as arrays with one row per tree; a leaf points at itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def score(self, x: np.ndarray) -> np.ndarray:
        trees, rows = np.arange(len(self.feature))[:, None], np.arange(len(x))[None, :]
        node = np.zeros((len(self.feature), len(x)), np.int32)
        for _ in range(self.depth):
            low = x[rows, self.feature[trees, node]] <= self.threshold[trees, node]
            node = np.where(low, self.left[trees, node], self.right[trees, node])
        return 1.0 / (1.0 + np.exp(-(self.start + self.value[trees, node].sum(axis=0))))


def grow(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 4, rate: float = 0.15, bins: int = 64,
    smooth: float = 1.0, least: float = 2.0,
) -> Trees:
    """Boost regression trees on the logistic loss; splits come from histograms of gradients per bin."""
    n, width = x.shape
    inner = np.linspace(0, 1, bins + 1)[1:-1]
    edges = [np.unique(np.quantile(x[:, k], inner)) for k in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(width) * bins
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    start = float(np.log(share / (1 - share)))
    margin = np.full(n, start)
    nodes = 2 ** (depth + 1) - 1
    shape = (rounds, nodes)
    feature, left = np.zeros(shape, np.int32), np.tile(np.arange(nodes, dtype=np.int32), (rounds, 1))
    threshold, value, right = np.full(shape, np.inf), np.zeros(shape), left.copy()
    for r in range(rounds):
        p = 1.0 / (1.0 + np.exp(-margin))
        gradient, hessian = p - y, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        for level in range(depth + 1):
            first, count = 2**level - 1, 2**level
            at = node - first
            open_rows = at >= 0
            g = np.bincount(at[open_rows], gradient[open_rows], count)
            h = np.bincount(at[open_rows], hessian[open_rows], count)
            value[r, first : first + count] = -rate * g / (h + smooth)
            if level == depth or not open_rows.any():
                break
            key = (at[open_rows, None] * (width * bins) + flat[open_rows]).ravel()
            cells = (count, width, bins)
            weight = lambda v: np.bincount(key, np.repeat(v[open_rows], width), count * width * bins).reshape(cells)  # noqa: B023, E731
            gl, hl = weight(gradient).cumsum(axis=2), weight(hessian).cumsum(axis=2)
            gt, ht = g[:, None, None], h[:, None, None]
            gain = gl**2 / (hl + smooth) + (gt - gl) ** 2 / (ht - hl + smooth) - gt**2 / (ht + smooth)
            gain[(hl < least) | (ht - hl < least)] = 0
            best = gain.reshape(count, -1).argmax(axis=1)
            for k in range(count):
                f, b = divmod(int(best[k]), bins)
                if gain[k, f, b] > 1e-6 and b < len(edges[f]):
                    here = first + k
                    feature[r, here], threshold[r, here] = f, edges[f][b]
                    left[r, here], right[r, here] = 2 * here + 1, 2 * here + 2
                    rows = node == here
                    node[rows] = np.where(binned[rows, f] <= b, 2 * here + 1, 2 * here + 2)
        margin += value[r, node]
    return Trees(feature, threshold, left, right, value, start, depth)


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = TRAIN_ROWS) -> Trees | None:
    """Trees from `rows` labelled texts of the learning folds at most; None if there is none."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = statistics(common.raw_bytes(batch["text"]))
        flat = pa.array(found.ravel())
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(found) + 1, dtype=np.int32) * len(FEATURES)), flat)
        return pa.RecordBatch.from_arrays([batch["doc_id"], batch["label"], lists], ["doc_id", "label", "x"])

    sample = common.labelled(docs, labels, label, rows)
    got = common.map_arrow(sample, step, "doc_id long, label int, x array<double>").toPandas()
    if got.empty:
        return None
    got = got.sort_values("doc_id", kind="stable")
    return grow(np.stack(got["x"].to_numpy()), (got["label"].to_numpy() > 0).astype(float))


def classify(docs: DataFrame, trees: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """Score every text: doc_id, held_out, score, predicted."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = common.raw_bytes(batch["text"])
        score = np.full(len(texts), 0.5) if trees is None else trees.score(statistics(texts))
        return pa.RecordBatch.from_arrays(
            [batch["doc_id"], batch["held_out"], pa.array(score), pa.array((score >= threshold).astype(np.int32))],
            ["doc_id", "held_out", "score", "predicted"],
        )

    rows = common.texts_of(docs).withColumn("held_out", common.fold(F.col("doc_id"), 5) == 0)
    return common.map_arrow(rows, step, "doc_id long, held_out boolean, score double, predicted int")


def keep_good(docs: DataFrame, trees: Trees | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, all columns, whose text the trees accept."""

    def run(batches):
        for batch in batches:
            texts = common.raw_bytes(batch["text"].fill_null(""))
            if trees is None or not texts:
                yield batch
            else:
                yield batch.filter(pa.array(trees.score(statistics(texts)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
