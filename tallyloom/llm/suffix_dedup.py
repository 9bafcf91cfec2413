"""Suffix-array dedup: remove every byte that lies in a string of `min_length` bytes which also starts anywhere else.

1. Windowing. Each string of min_length bytes has one anchor, its 32-byte piece of least hash, so equal strings have equal
   anchors. The starts that share an anchor form a run; a run's segment is the text from its first start to the end of its
   last string. Only runs whose anchor occurs twice in the corpus can hold repeats, and equal strings always meet under one
   anchor. Equal segments of an anchor are counted, and one of them stands for all with its number. A string reaches from one of
   `GRADES` distances before its anchor to a matching one behind it, so two segments can share strings only if they agree around
   their anchor between such a pair of places; those that agree with no other one are left out of the next step.
2. Threshold-bounded interval expansion. The different segments of an anchor go into a pool with its other anchors. A pool's
   suffixes are sorted and give its Burrows-Wheeler transform. Breadth-first backward extension of intervals then sets the
   common prefixes of neighbouring suffixes by increasing value and stops at min_length: what is unset by then is at least as
   long, so these neighbours repeat each other.
3. Anchors with more than `HOT` different segments are dealt into blocks by the segments' hashes. Each block is expanded the same
   way, and its classes of equal strings are added up over all blocks by their 64-bit hash (`key_exchange`).
4. The starts found go back to all runs of the corpus with that segment, and from there to their documents.

Strings are judged on the input; matches do not cross documents. Null texts are empty. Texts shorter than min_length lose
nothing. Repeated rows repeat each other. A null doc_id is an id like others. A text is read in pieces of `PIECE` starts, so one
very long text needs no more memory than its own bytes. Columns other than id and text are not read; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom import session
from tallyloom.llm import common, key_exchange

MIN_LENGTH = 400
ANCHOR = 32
PIECE = 1 << 20
POOL = 1 << 20
# Segments' bytes for one task, and the most tasks that this makes; beyond them tasks get larger.
TASK = 4 << 20
MOST_TASKS = 100_000
HOT = 256
GRADES = 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
_TURN = np.uint64(0xD6E8FEB86659FD93)
# Random numbers for the byte values, by a rule.
_BYTE = (np.arange(1, 257, dtype=np.uint64) * _MIX) ^ ((np.arange(1, 257, dtype=np.uint64) * _TURN) >> np.uint64(32))


def anchor_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the 32 bytes from each place on, by doubling."""
    h, width = _BYTE[data], 1
    while width < ANCHOR:
        h = h[:-width] * _MIX + h[width:]
        h ^= h >> np.uint64(29)
        h *= _TURN
        width *= 2
    return h ^ (h >> np.uint64(32))


def sliding_least(values: np.ndarray, span: int) -> np.ndarray:
    """The least of values[i : i + span] for each i."""
    n = len(values)
    blocks = -(-n // span)
    padded = np.full(blocks * span, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    table = padded.reshape(blocks, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - span + 1], ahead[span - 1 : n])


def runs(text: bytes, min_length: int) -> Iterator[tuple[int, int, int, int, bytes]]:
    """first start, last start, anchor, the anchor's place in the segment, hash of the segment for each run of starts with one anchor."""
    for at in range(0, max(0, len(text) - min_length + 1), PIECE):
        data = np.frombuffer(text, np.uint8)[at : at + PIECE + min_length - 1]
        hashes = anchor_hashes(data)
        span = min_length - ANCHOR + 1
        # Upper 40 bits of the hash, then the place counted backwards: of equal hashes the last one in the string is taken.
        place = np.arange(len(hashes), dtype=np.uint64)
        low = np.uint64((1 << 24) - 1)
        least = sliding_least((hashes & ~low) | (low - place), span)
        ends = np.flatnonzero(np.append(least[1:] != least[:-1], True))
        firsts = np.append(0, ends[:-1] + 1)
        places = (low - (least[ends] & low)).astype(np.int64)
        anchors = hashes[places].view(np.int64)
        for first, end, anchor, spot in zip(firsts.tolist(), ends.tolist(), anchors.tolist(), (places - firsts).tolist(), strict=True):
            segment = text[at + first : at + end + min_length]
            yield at + first, at + end, anchor, spot, xxhash.xxh3_128_digest(segment)


def _runs_of(docs: DataFrame, min_length: int) -> DataFrame:
    """doc_id, th, firsts, more, anchor, spot, segment: each different run of a text, where it begins and its last start after that.

    A text that repeats itself has a run for each period; equal ones are one row with many places.
    """

    def step(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows, firsts, more, anchors, spots, segments = [], [], [], [], [], []
        for k, text in enumerate(common.raw_bytes(batch["text"])):
            own: dict[tuple[int, bytes], list[int]] = {}
            for first, last, anchor, spot, segment in runs(text, min_length):
                places = own.get((anchor, segment))
                if places is None:
                    own[anchor, segment] = places = []
                    rows.append(k)
                    firsts.append(places)
                    more.append(last - first)
                    anchors.append(anchor)
                    spots.append(spot)
                    segments.append(segment)
                places.append(first)
        if not rows:
            return None
        at = pa.array(rows)
        return pa.RecordBatch.from_arrays(
            [
                batch["doc_id"].take(at), batch["th"].take(at), pa.array(firsts, pa.list_(pa.int64())), pa.array(more, pa.int64()),
                pa.array(anchors, pa.int64()), pa.array(spots, pa.int64()), pa.array(segments, pa.binary()),
            ],
            ["doc_id", "th", "firsts", "more", "anchor", "spot", "segment"],
        )

    return common.map_arrow(docs, step, "doc_id long, th long, firsts array<long>, more long, anchor long, spot long, segment binary")


def suffix_order(segments: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Suffix array of the segments, each closed by an end mark of its own, the marks smaller than all bytes.

    Returns the order, the symbol before each place (0 for a mark) and each place's segment. Prefixes are doubled from seven
    symbols on; only suffixes that are not yet told apart are sorted again.
    """
    lengths = np.array([len(s) for s in segments], np.int64)
    data = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    n = len(data)
    marks = np.cumsum(lengths + 1) - 1
    symbols = data.astype(np.uint64) + np.uint64(1)
    symbols[marks] = 0
    owner = np.repeat(np.arange(len(segments)), lengths + 1)
    left = marks[owner] - np.arange(n)
    # Seven symbols of nine bits, none after a mark.
    key = symbols.copy()
    for have, more in ((1, 1), (2, 2), (4, 3)):
        behind = np.zeros(n, np.uint64)
        behind[:-have] = key[have:] >> np.uint64(9 * (have - more))
        behind[left < have] = 0
        key = (key << np.uint64(9 * more)) | behind
    # Marks have the least keys, in the order of their segments: each is a group of its own.
    key[marks] = np.arange(len(segments), dtype=np.uint64)
    order = np.argsort(key)
    sorted_key = key[order]
    starts = np.flatnonzero(np.append(True, sorted_key[1:] != sorted_key[:-1]))
    # A group's rank is its first row. Rows in groups of one are settled; `rows` are the others.
    sizes = np.diff(np.append(starts, n))
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(starts, sizes)
    rows = np.flatnonzero(np.repeat(sizes > 1, sizes))
    width = 7
    while len(rows):
        places = order[rows]
        inside = left[places] >= width
        second = np.where(inside, rank[np.minimum(places + width, n - 1)] + len(segments), owner[places])
        wide = (rank[places].astype(np.uint64) << np.uint64(32)) | second.astype(np.uint64)
        by = np.argsort(wide)
        places, wide = places[by], wide[by]
        order[rows] = places
        starts = np.flatnonzero(np.append(True, wide[1:] != wide[:-1]))
        sizes = np.diff(np.append(starts, len(rows)))
        rank[places] = np.repeat(rows[starts], sizes)
        rows = rows[np.repeat(sizes > 1, sizes)]
        width *= 2
    return order, np.append(0, symbols[:-1]).astype(np.int64), owner


def bounded_repeats(order: np.ndarray, before: np.ndarray, bound: int) -> np.ndarray:
    """For each row of the suffix array whether its common prefix with the row above has at least `bound` symbols.

    Breadth-first: the queue of level l holds intervals of suffixes that start with one string of l symbols. Extending it to the
    left by each symbol before its rows gives intervals of level l + 1; the row after such an interval has common prefix l if no
    shorter one was found for it.
    """
    n = len(order)
    bwt = before[order]
    stable = np.argsort(bwt.astype(np.int16), kind="stable")
    lf = np.empty(n, np.int64)
    lf[stable] = np.arange(n)
    # The first symbol of the suffix in each row.
    begins = bwt[stable]
    unset = np.ones(n + 1, bool)
    unset[[0, n]] = False
    bits = n.bit_length()
    mask = (1 << bits) - 1
    low, high = np.array([0]), np.array([n])
    for _ in range(bound):
        if not len(low):
            break
        widths = high - low
        alone = widths == 1
        wide = np.flatnonzero(~alone)
        widths = widths[wide]
        total = int(widths.sum())
        rows = np.arange(total) - np.repeat(np.cumsum(widths) - widths, widths) + np.repeat(low[wide], widths)
        # A symbol's rows follow each other in the suffix array, so sorting by interval and target row sorts by symbol as well.
        key = np.sort(np.repeat(np.arange(len(wide)) << bits, widths) | lf[rows])
        which = key >> bits
        target = key & mask
        symbol = begins[target]
        # Marks differ from one another, so no string extends over them; but each ends the interval before it.
        new = (symbol[1:] != symbol[:-1]) | (which[1:] != which[:-1]) | (symbol[1:] == 0)
        first = np.flatnonzero(np.append(True, new)) if total else np.zeros(0, np.int64)
        one = lf[low[alone]]
        low = np.concatenate([target[first], one])
        high = np.concatenate([target[first] + np.diff(np.append(first, total)), one + 1])
        fresh = unset[high]
        low, high = low[fresh], high[fresh]
        unset[high] = False
    return unset[:n]


def equal_starts(segments: list[bytes], bound: int) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each segment the class of the string of `bound` bytes at each of its starts, and how often that class starts here."""
    order, before, owner = suffix_order(segments)
    same = bounded_repeats(order, before, bound)
    row_class = np.cumsum(~same) - 1
    size = np.bincount(row_class)
    classes = np.empty(len(order), np.int64)
    classes[order] = row_class
    first = np.append(0, np.flatnonzero(np.diff(owner)) + 1)
    starts = [slice(f, f + max(0, len(s) - bound + 1)) for f, s in zip(first.tolist(), segments, strict=True)]
    return [classes[s] for s in starts], [size[classes[s]] for s in starts]


def spans(repeated: np.ndarray) -> list[int]:
    """first, last, first, last, ... of the runs of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], repeated.astype(np.int8), [0]])))
    edges[1::2] -= 1
    return edges.tolist()


_MARKS = "anchor long, segment binary, spans array<long>"


def _marks(found: list[tuple[int, bytes, list[int]]]) -> list[pa.Array]:
    anchor, segment, where = zip(*found, strict=True) if found else ((), (), ())
    return [pa.array(anchor, pa.int64()), pa.array(segment, pa.binary()), pa.array(where, pa.list_(pa.int64()))]


def related(group: list[tuple[bytes, int]], min_length: int) -> list[bool]:
    """For each segment of one anchor, with the anchor's place in it, whether it may share a string of min_length bytes with another one.

    A string that begins at least `before` and less than before + step bytes ahead of the anchor holds the bytes from `before` ahead of it
    to the end that such a string reaches at least. Segments with a common string have these bytes in common, for one `before` at least.
    """
    beside = min_length - ANCHOR
    step = max(1, -(-beside // GRADES))
    seen: dict[tuple[int, int], int] = {}
    keys = []
    for segment, spot in group:
        own = []
        for before in range(0, beside + 1, step):
            end = spot + ANCHOR + max(0, beside - before - step + 1)
            if before > spot:
                break
            if end <= len(segment):
                key = before, xxhash.xxh3_64_intdigest(segment[spot - before : end])
                seen[key] = seen.get(key, 0) + 1
                own.append(key)
        keys.append(own)
    return [any(seen[key] > 1 for key in own) for own in keys]


def _pools(rows: DataFrame, total: int, min_length: int) -> DataFrame:
    """Expand pools of whole anchors; rows come sorted by anchor. `total` is the bytes of their segments."""

    def expand(held: list[tuple[int, bytes, int, int, bytes]], found: list[tuple[int, bytes, list[int]]]) -> pa.RecordBatch:
        sizes = equal_starts([x[4] for x in held], min_length)[1] if held else []
        for (anchor, segment, copies, _, _), size in zip(held, sizes, strict=True):
            if where := spans((size > 1) | (copies > 1)):
                found.append((anchor, segment, where))
        return pa.RecordBatch.from_arrays(_marks(found), ["anchor", "segment", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        columns = ("anchor", "segment", "copies", "spot", "bytes")
        rows = (row for batch in batches for row in zip(*(batch[c].to_pylist() for c in columns), strict=True))
        held, found, size = [], [], 0
        for _, group in itertools.groupby(rows, itemgetter(0)):
            own = list(group)
            for row, is_related in zip(own, related([(x[4], x[3]) for x in own], min_length), strict=True):
                if is_related:
                    held.append(row)
                    size += len(row[4])
                elif row[2] > 1:
                    # Equal to its copies only: all its starts are repeated.
                    found.append((row[0], row[1], [0, len(row[4]) - min_length]))
            if size > POOL:
                yield expand(held, found)
                held, found, size = [], [], 0
        if held or found:
            yield expand(held, found)

    # Sorting suffixes is far more work for a byte than reading it, so tasks are not gathered by the bytes they read.
    tasks = max(1, min(MOST_TASKS, -(-total // TASK)))
    return rows.repartition(tasks, "anchor").sortWithinPartitions("anchor").mapInArrow(run, _MARKS)


def _cuts(segments: list[bytes]) -> list[tuple[int, int]]:
    """Ranges of segments of about `POOL` bytes each, so that a block needs no more memory than a pool."""
    edges, size = [0], 0
    for k, segment in enumerate(segments):
        if size > POOL:
            edges.append(k)
            size = 0
        size += len(segment)
    return list(zip(edges, [*edges[1:], len(segments)], strict=True))


def _classes(segments: list[bytes], copies: np.ndarray, min_length: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """The hash of each different string of these segments, how often it starts here, and the number of the one at each start."""
    classes, _ = equal_starts(segments, min_length)
    flat = np.concatenate(classes)
    counts = np.bincount(flat, np.repeat(copies, [len(c) for c in classes]))
    first = np.full(len(counts), -1)
    places = np.cumsum([0, *map(len, classes)])
    first[flat[::-1]] = np.arange(len(flat))[::-1]
    named = np.flatnonzero(first >= 0)
    row = np.searchsorted(places, first[named], side="right") - 1
    at = first[named] - places[row]
    hashes = np.fromiter(
        (xxhash.xxh3_64_intdigest(segments[r][a : a + min_length]) for r, a in zip(row.tolist(), at.tolist(), strict=True)),
        np.uint64, len(named),
    )
    number = np.full(len(counts), -1, np.int32)
    number[named] = np.arange(len(named))
    return hashes, counts[named], [number[c] for c in classes]


def _hot(rows: DataFrame, total: int, min_length: int) -> DataFrame:
    """The same for anchors of very many segments: classes of each block, added up over all blocks."""

    def keys_of(table: pa.Table):
        segments, copies = table["bytes"].to_pylist(), table["copies"].to_numpy()
        found = [_classes(segments[a:b], copies[a:b], min_length) for a, b in _cuts(segments)]
        keys, place = np.unique(np.concatenate([hashes for hashes, _, _ in found]), return_inverse=True)
        counts = np.bincount(place, np.concatenate([counts for _, counts, _ in found]), len(keys))
        slots, at = [], 0
        for hashes, _, starts in found:
            own = place[at : at + len(hashes)]
            slots += [own[x] for x in starts]
            at += len(hashes)
        return [(keys, counts)], slots

    def use(table: pa.Table, totals: list[np.ndarray], state) -> pa.Table:
        found = []
        if table.num_rows:
            for anchor, segment, slots in zip(table["anchor"].to_pylist(), table["segment"].to_pylist(), state[1], strict=True):
                if where := spans(totals[0][slots] > 1):
                    found.append((anchor, segment, where))
        return pa.table(_marks(found), names=["anchor", "segment", "spans"])

    dealt = key_exchange.with_blocks(rows, total, "segment")
    return key_exchange.exchange(dealt, total, keys_of, use, _MARKS)


def _segments(docs: DataFrame, wanted: DataFrame, min_length: int) -> DataFrame:
    """The bytes of one occurrence of each wanted segment."""
    lists = wanted.groupBy("at.doc_id", "at.th").agg(
        F.collect_list(F.struct("anchor", "segment", "copies", "kinds", "at.first", "at.more", "at.spot")).alias("cuts")
    )
    schema = "anchor long, segment binary, copies long, kinds long, spot long, bytes binary"

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, cuts in zip(common.raw_bytes(batch["text"]), batch["cuts"].to_pylist(), strict=True):
            for c in cuts:
                segment = text[c["first"] : c["first"] + c["more"] + min_length]
                out.append((c["anchor"], c["segment"], c["copies"], c["kinds"], c["spot"], segment))
        types = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
        columns = [pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "segment", "copies", "kinds", "spot", "bytes"])

    return common.map_arrow(_with(docs, lists, "inner").select("text", "cuts"), step, schema)


def _with(docs: DataFrame, lists: DataFrame, how: str) -> DataFrame:
    """Join lists to the texts they belong to; the hash table is built of the lists, the texts are not sorted."""
    lists = lists.select(F.col("doc_id").alias("id"), F.col("th").alias("hash"), lists.columns[-1]).hint("shuffle_hash")
    return docs.join(lists, docs["doc_id"].eqNullSafe(F.col("id")) & (docs["th"] == F.col("hash")), how)


def _stored(df: DataFrame, folder: str, name: str) -> DataFrame:
    df.write.parquet(f"{folder}/{name}")
    return df.sparkSession.read.parquet(f"{folder}/{name}")


def repeats(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """docs with `found`, the ranges of repeated starts of each run, or null; doc_id and text as `common.texts_of` gives them."""
    names = docs.columns
    folder = session.scratch(docs.sparkSession, "suffix")
    docs = docs.withColumn("th", F.xxhash64("text"))
    every = _stored(_runs_of(docs.select("doc_id", "th", "text"), min_length), folder, "runs")
    twice = every.groupBy("anchor").agg(F.sum(F.size("firsts")).alias("n")).where("n > 1").select("anchor")
    some = _stored(every.join(twice, "anchor"), folder, "some")
    kinds = some.groupBy("anchor", "segment").agg(
        F.sum(F.size("firsts")).alias("copies"),
        F.min(F.struct("doc_id", "th", F.get("firsts", F.lit(0)).alias("first"), "more", "spot")).alias("at"),
    )
    kinds = _stored(kinds, folder, "kinds")
    several = kinds.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    pool = _stored(_segments(docs.select("doc_id", "th", "text"), kinds.join(several, "anchor"), min_length), folder, "pool")
    size, is_hot = F.octet_length("bytes"), F.col("kinds") > HOT
    totals = pool.agg(F.sum(F.when(~is_hot, size)).alias("cold"), F.sum(F.when(is_hot, size)).alias("hot")).first()
    marks = _pools(pool.where(~is_hot), int(totals["cold"] or 0), min_length)
    if totals["hot"]:
        marks = marks.union(_hot(pool.where(is_hot), int(totals["hot"]), min_length))
    marks = _stored(marks, folder, "marks")
    # An anchor with one kind of segment: all its starts are repeated.
    alone = some.join(several.select("anchor"), "anchor", "left_anti").select(
        "doc_id", "th", "firsts", F.array(F.lit(0).cast("long"), F.col("more")).alias("spans")
    )
    found = alone.union(some.join(marks, ["anchor", "segment"]).select("doc_id", "th", "firsts", "spans"))
    lists = found.groupBy("doc_id", "th").agg(F.collect_list(F.struct("firsts", "spans")).alias("found"))
    return _with(docs, lists, "left").select(*names, "found")


def removed_spans(found: list[dict] | None, min_length: int) -> list[tuple[int, int]]:
    """Maximal byte ranges [from, to) that the repeated starts cover."""
    if not found:
        return []
    ranges = sorted(
        (first + a, first + b + min_length)
        for x in found for first in x["firsts"] for a, b in zip(x["spans"][::2], x["spans"][1::2], strict=True)
    )
    out = [ranges[0]]
    for a, b in ranges[1:]:
        if a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def without(text: bytes, cuts: list[tuple[int, int]]) -> bytes:
    edges = [0, *(x for cut in cuts for x in cut), len(text)]
    return b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))


def dedup(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, and the removed spans."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text, found in zip(common.raw_bytes(batch["text"]), batch["found"].to_pylist(), strict=True):
            cuts = removed_spans(found, min_length)
            rest = without(text, cuts)
            flat = [x for cut in cuts for x in cut]
            rows.append((len(text), len(text) - len(rest), len(cuts), hashlib.sha256(rest).hexdigest(), flat))
        types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.int64()))
        columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<long>"
    names = [x.split()[0] for x in schema.split(", ")]
    return common.map_arrow(repeats(common.texts_of(docs), min_length), step, schema)


def clean(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """docs with the repeated bytes taken out of `text`, all other columns as they are, n_chars counted anew.

    A character of which only some bytes were removed goes as a whole.
    """
    rows = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    own = [c for c in docs.columns if c not in ("doc_id", "text")]
    held = rows.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*(F.col(f"`{c}`") for c in own)).alias("own") if own else F.lit(1).alias("own"))

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = [
            without(text, removed_spans(found, min_length)).decode("utf-8", "ignore")
            for text, found in zip(common.raw_bytes(batch["text"]), batch["found"].to_pylist(), strict=True)
        ]
        return pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(kept, pa.string()), batch["own"]], ["doc_id", "text", "own"])

    cleaned = common.map_arrow(repeats(held, min_length), step, held.schema)
    columns = {c: F.col("own")[c] for c in own} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if "n_chars" in columns:
        columns["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cleaned.select(*(columns[c].alias(c) for c in docs.columns))
