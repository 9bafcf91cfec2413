"""Centroid clustering with ns-bounds, in whole numbers.

Each vector keeps, for every centroid, a lower bound of its distance: the distance when it was last evaluated, and the round that
was. All centroids of all rounds are kept, so a bound is loosened by how far its centroid is from where it was then, the norm of its
total displacement, which is never more than its drifts round by round added up. If the loosened bound of the vector's own
centroid, as an upper one, is below all others, the vector stays without any distance being evaluated. Otherwise its own distance
is evaluated, and then those of the centroids whose bounds are not above it; they are compared in whole numbers, ties to the
smaller number. Bounds are rounded away from the truth, so a bound that fails only costs an exact look.

A round is one map over the vectors: their whole numbers and bounds are a table in the shared folder, which the next round reads.
Sums of a cluster are added up in each task, then for each centroid over all tasks; only the centroids reach the driver.

Vectors without exactly `DIMENSIONS` components, or with a component that is null, not a number or infinite, are left out.
Components are floor(64 * x). Components of 2 ** 26 and more are computed with numbers of any length; a distance or an inertia that
does not fit a long is null. The first centroids are the vectors of least sha256 of `1:<vec_id>` (of equal ones, the vector that
sorts first; a null id has an empty text); if there are fewer vectors than centroids, each vector is one. A centroid without vectors
stays where it is. Repeated rows are vectors each. Columns other than vec_id and embedding are not read. No vectors give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.llm import common

DIMENSIONS = 64
CENTROIDS = 16
ROUNDS = 3
# Components below this are squared and added up in 64 bits; below the smaller one a product of float matrices is exact.
_WIDE, _NARROW = 1 << 26, 1 << 20
_SAFE = 1 + 1e-9
# Farther distances are kept as this one: as a lower bound it is right, and as an upper one it counts as none.
_FAR = 1e37
_STATE = "vec_id long, ints binary, big string, cluster int, low binary, seen binary"
_TOLD = "vec_id long, cluster int, distance long"

Centroids = list[list[int]]


def usable(rows: DataFrame) -> DataFrame:
    """vec_id and embedding, as doubles, of the vectors that count."""
    vectors = rows.select(rows["vec_id"].cast("long").alias("vec_id"), rows["embedding"].cast("array<double>").alias("embedding"))
    # A comparison with null is null; not a number is above infinity.
    finite = F.forall("embedding", lambda x: F.coalesce(F.abs(x) < F.lit(math.inf), F.lit(False)))
    return vectors.where((F.size("embedding") == DIMENSIONS) & finite)


def whole(x: float) -> int:
    """floor(64 * x), exactly."""
    return int(x) * 64 if abs(x) >= 2.0**53 else math.floor(64.0 * x)


def first_centroids(vectors: DataFrame, k: int) -> Centroids:
    """The k vectors whose ids have the least hashes."""
    key = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    chosen = vectors.withColumn("key", key).orderBy("key", "embedding").limit(k).collect()
    return [[whole(x) for x in row["embedding"]] for row in chosen]


def as_text(centroid: list[int]) -> str:
    return ",".join(map(str, centroid))


class Rounds:
    """All centroids so far, and what follows from them for the latest round."""

    def __init__(self, history: list[Centroids]):
        self.now = history[-1]
        self.round = len(history) - 1
        self.numbers = np.array(self.now, object)
        self.most = max(abs(x) for c in self.now for x in c)
        if self.most < _WIDE:
            self.numbers = self.numbers.astype(np.int64)
        # How far each centroid is from where it was in each round, rounded up.
        self.moved = np.array([[self._norm(a, b) for a, b in zip(old, self.now, strict=True)] for old in history])

    @staticmethod
    def _norm(a: list[int], b: list[int]) -> float:
        square = sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
        try:
            return math.sqrt(square) * _SAFE
        except OverflowError:
            return math.inf

    def squares(self, vectors: np.ndarray) -> np.ndarray:
        """Squared distances of vectors of components below 2 ** 26 to all centroids."""
        most = max(self.most, int(np.abs(vectors).max(initial=0)))
        if most < _NARROW:
            v, c = vectors.astype(np.float64), self.numbers.astype(np.float64)
            return ((v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None, :]).astype(np.int64)
        if most < _WIDE:
            v, c = vectors, self.numbers
            return (v * v).sum(1)[:, None] - 2 * (v @ c.T) + (c * c).sum(1)[None, :]
        return ((vectors.astype(object)[:, None, :] - self.numbers[None, :, :]) ** 2).sum(2)

    def some(self, vectors: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The squared distance of each vector to one centroid each."""
        centroids = self.numbers[which]
        if centroids.dtype == object:
            vectors = vectors.astype(object)
        return ((vectors - centroids) ** 2).sum(1)


def _below(squares: np.ndarray) -> np.ndarray:
    """Distances of these squares, rounded down to single precision."""
    if squares.dtype == object:
        squares = np.minimum(squares, int(_FAR) ** 2)
    near = np.sqrt(squares.astype(np.float64)).astype(np.float32)
    return np.maximum(np.nextafter(near, np.float32(-1)), np.float32(0))


def _above(low: np.ndarray) -> np.ndarray:
    """A number that the distance which `_below` rounded does not pass."""
    up = np.nextafter(np.nextafter(low, np.float32(np.inf)), np.float32(np.inf))
    return np.where(low < 0.9 * _FAR, up.astype(np.float64), np.inf)


def _nearest(squares: np.ndarray) -> np.ndarray:
    if squares.dtype != object:
        return squares.argmin(1)
    return np.array([min(range(len(row)), key=row.__getitem__) for row in squares], np.int64)


def assign(
    vectors: np.ndarray, cluster: np.ndarray, low: np.ndarray, seen: np.ndarray, rounds: Rounds
) -> int:
    """Move vectors to their nearest centroid, in place, by bounds; returns how many distances were evaluated."""
    n, k = low.shape
    rows = np.arange(n)
    bound = low.astype(np.float64) - rounds.moved[seen, np.arange(k)[None, :]]
    upper = _above(low[rows, cluster]) + rounds.moved[seen[rows, cluster], cluster]
    bound[rows, cluster] = np.inf
    open_rows = np.flatnonzero(~(bound.min(1) > upper * _SAFE)) if k > 1 else rows[:0]
    if not len(open_rows):
        return 0
    own = cluster[open_rows]
    squares = rounds.some(vectors[open_rows], own)
    low[open_rows, own] = _below(squares)
    seen[open_rows, own] = rounds.round
    tight = _above(low[open_rows, own]) * _SAFE
    at, others = np.nonzero(~(bound[open_rows] > tight[:, None]))
    if len(at):
        found = rounds.some(vectors[open_rows[at]], others)
        low[open_rows[at], others] = _below(found)
        seen[open_rows[at], others] = rounds.round
        # The nearest of those evaluated, by square, then by number.
        every = np.concatenate([np.arange(len(open_rows)), at])
        numbers, distances = np.concatenate([own, others]), np.concatenate([squares, found])
        order = sorted(range(len(every)), key=lambda i: (every[i], distances[i], numbers[i])) if distances.dtype == object else np.lexsort((numbers, distances, every))
        order = np.asarray(order)
        first = order[np.append(True, np.diff(every[order]) != 0)]
        cluster[open_rows] = numbers[first]
    return len(open_rows) + len(at)


def _packed(vectors: np.ndarray) -> pa.Array:
    """Each vector's components in the narrowest of three widths that holds the whole batch."""
    most = int(np.abs(vectors).max(initial=0))
    kind = "<i1" if most < 1 << 7 else "<i2" if most < 1 << 15 else "<i4"
    return _rows(vectors.astype(kind))


def _rows(table: np.ndarray) -> pa.Array:
    data = np.ascontiguousarray(table).tobytes()
    width = table.shape[1] * table.itemsize
    return pa.array([data[k : k + width] for k in range(0, len(data), width)], pa.binary())


def _unpacked(column: pa.Array) -> np.ndarray:
    values = column.to_pylist()
    out = np.empty((len(values), DIMENSIONS), np.int64)
    widths = np.array([len(x) for x in values])
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        out[at] = np.frombuffer(b"".join(values[i] for i in at), f"<i{width // DIMENSIONS}").reshape(-1, DIMENSIONS)
    return out


def _table(column: pa.Array, kind: str, k: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, k).copy()


def _state(ids: pa.Array, vectors: np.ndarray, cluster: np.ndarray, low: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
    n = len(ids)
    return pa.RecordBatch.from_arrays(
        [ids, _packed(vectors), pa.nulls(n, pa.string()), pa.array(cluster, pa.int32()), _rows(low), _rows(seen)], _STATE_NAMES
    )


_STATE_NAMES = [x.split()[0] for x in _STATE.split(", ")]


def _big_state(ids: list, vectors: list[list[int]], rounds: Rounds) -> pa.RecordBatch:
    """Vectors with very large components have no bounds and are compared anew each round."""
    n = len(ids)
    cluster = _nearest(_any_squares(vectors, rounds))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()), pa.nulls(n, pa.binary()), pa.array(map(as_text, vectors), pa.string()), pa.array(cluster, pa.int32()),
            pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
        ],
        _STATE_NAMES,
    )


def _any_squares(vectors: list[list[int]], rounds: Rounds) -> np.ndarray:
    found = np.empty((len(vectors), len(rounds.now)), object)
    for i, v in enumerate(vectors):
        for j, c in enumerate(rounds.now):
            found[i, j] = sum((x - y) ** 2 for x, y in zip(v, c, strict=True))
    return found


def _numbers(text: str) -> list[int]:
    return [int(x) for x in text.split(",")]


def _begin(vectors: DataFrame, history: list[Centroids]) -> DataFrame:
    """The first round: every distance is evaluated."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(history)
        for batch in batches:
            if not batch.num_rows:
                continue
            table = batch["embedding"].flatten().to_numpy(zero_copy_only=False).reshape(-1, DIMENSIONS)
            is_big = np.abs(table).max(1) >= (_WIDE >> 6) - 1
            small = np.floor(table[~is_big] * 64.0).astype(np.int64)
            if len(small):
                squares = rounds.squares(small)
                seen = np.full(squares.shape, rounds.round, np.uint8)
                yield _state(batch["vec_id"].filter(pa.array(~is_big)), small, _nearest(squares), _below(squares), seen)
            if is_big.any():
                ids = batch["vec_id"].filter(pa.array(is_big)).to_pylist()
                yield _big_state(ids, [[whole(x) for x in row] for row in table[is_big].tolist()], rounds)

    return vectors.mapInArrow(run, _STATE)


def _continue(states: DataFrame, history: list[Centroids], told: bool) -> DataFrame:
    """A later round; with `told`, the last one: clusters and distances."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rounds = Rounds(history)
        k = len(rounds.now)
        for batch in batches:
            plain = batch.filter(batch["big"].is_null())
            if plain.num_rows:
                vectors, cluster = _unpacked(plain["ints"]), plain["cluster"].to_numpy().astype(np.int64)
                low, seen = _table(plain["low"], "<f4", k), _table(plain["seen"], "u1", k)
                assign(vectors, cluster, low, seen, rounds)
                yield _distances(plain["vec_id"], cluster, rounds.some(vectors, cluster)) if told else _state(plain["vec_id"], vectors, cluster, low, seen)
            large = batch.filter(batch["big"].is_valid())
            if large.num_rows:
                vectors = [_numbers(x) for x in large["big"].to_pylist()]
                if told:
                    squares = _any_squares(vectors, rounds)
                    cluster = _nearest(squares)
                    yield _distances(large["vec_id"], cluster, squares[np.arange(len(vectors)), cluster])
                else:
                    yield _big_state(large["vec_id"].to_pylist(), vectors, rounds)

    return states.mapInArrow(run, _TOLD if told else _STATE)


def _distances(ids: pa.Array, cluster: np.ndarray, squares: np.ndarray) -> pa.RecordBatch:
    distances = [x if x < 2**63 else None for x in squares.tolist()]
    return pa.RecordBatch.from_arrays([ids, pa.array(cluster, pa.int32()), pa.array(distances, pa.int64())], ["vec_id", "cluster", "distance"])


def _moved(states: DataFrame, before: Centroids) -> Centroids:
    """The means of the clusters, rounded down; those without vectors as before."""
    schema = "cluster int, n long, sums array<string>"

    def out(sums: dict[int, list], counts: dict[int, int]) -> pa.Table:
        keys = sorted(counts)
        return pa.table(
            [pa.array(keys, pa.int32()), pa.array([counts[c] for c in keys], pa.int64()), pa.array([[str(x) for x in sums[c]] for c in keys], pa.list_(pa.string()))],
            names=["cluster", "n", "sums"],
        )

    def add(sums: dict[int, list], counts: dict[int, int], cluster: int, n: int, numbers: list[int]) -> None:
        sums[cluster] = [x + y for x, y in zip(sums[cluster], numbers, strict=True)] if cluster in sums else numbers
        counts[cluster] = counts.get(cluster, 0) + n

    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            plain = batch.filter(batch["big"].is_null())
            if plain.num_rows:
                vectors, cluster = _unpacked(plain["ints"]), plain["cluster"].to_numpy()
                for c in np.unique(cluster).tolist():
                    own = vectors[cluster == c]
                    add(sums, counts, c, len(own), own.sum(0).tolist())
            large = batch.filter(batch["big"].is_valid())
            for c, text in zip(large["cluster"].to_pylist(), large["big"].to_pylist(), strict=True):
                add(sums, counts, c, 1, _numbers(text))
        if counts:
            yield from out(sums, counts).to_batches()

    def of_cluster(table: pa.Table) -> pa.Table:
        sums: dict[int, list] = {}
        counts: dict[int, int] = {}
        for batch in table.to_batches():
            for c, n, numbers in zip(*(batch[x].to_pylist() for x in ("cluster", "n", "sums")), strict=True):
                add(sums, counts, c, n, [int(x) for x in numbers])
        return out(sums, counts)

    # A row for each task and cluster, then one for each cluster.
    partial = states.select("ints", "big", "cluster").mapInArrow(of_task, schema)
    found = partial.groupBy("cluster").applyInArrow(of_cluster, schema).collect()
    means = {row["cluster"]: [int(x) // row["n"] for x in row["sums"]] for row in found}
    return [means.get(k, c) for k, c in enumerate(before)]


def cluster(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> tuple[DataFrame, Centroids]:
    """vec_id, cluster and distance of each usable vector after `rounds` rounds and one more assignment; and the centroids."""
    if not 0 < rounds < 256:
        raise ValueError("the number of rounds is kept in one byte")
    spark, vectors = rows.sparkSession, usable(rows)
    folder = session.scratch(spark, "ns-clusters")
    history = [first_centroids(vectors, k)]
    if not history[0]:
        return spark.createDataFrame([], _TOLD), []

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.parquet(f"{folder}/{name}")

    states = stored(_begin(vectors, history), "0")
    for n in range(1, rounds + 1):
        history.append(_moved(states, history[-1]))
        if n < rounds:
            states = stored(_continue(states, history, False), str(n))
    return stored(_continue(states, history, True), "told"), history[-1]


def report(rows: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, cluster, distance, the sums of distances of its cluster and of all, and the hash of its centroid."""
    found, centroids = cluster(rows, k, rounds)
    hashes = [(c, hashlib.sha256(as_text(x).encode()).hexdigest()) for c, x in enumerate(centroids)]
    named = found.sparkSession.createDataFrame(hashes, "cluster int, centroid_sha256 string")
    exact = F.sum(F.col("distance").cast("decimal(38,0)"))
    # A distance that fits no long makes the sums too large as well.
    fits = F.count("distance") == F.count(F.lit(1))
    # One row for each centroid.
    sums = found.groupBy("cluster").agg(F.when(fits, exact).alias("part"))
    total = sums.agg(F.when(F.count("part") == F.count(F.lit(1)), F.sum("part").cast("decimal(38,0)")).alias("whole"))
    told = sums.join(named, "cluster").select(
        "cluster", F.col("part").try_cast("long").alias("cluster_inertia"), total.scalar().try_cast("long").alias("inertia"), "centroid_sha256"
    )
    return found.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
