"""Packing: sum-of-squares online packing into windows of a fixed number of tokens.

Each document becomes its token ids and one end id. Whole windows are cut off its front; what remains is placed into the
fill level h for which the sum over all levels of N(h) squared, N(h) being the number of open windows filled up to h, comes
out least. N is kept in an array, so one placement is a few array operations over the levels.

Every partition packs on its own, as a stream: only the open windows are held. At its end they are closed against one
another: the emptiest are cut up to fill the fullest, and the single window that is left is cut into lengths that are
powers of two, which need no padding. Nothing is dropped; each id is in exactly one piece.

Null and empty texts are a document of the end id alone. Repeated rows are packed each. A null doc_id stays null. Columns
other than id and text are not read. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import common, word_ids

WINDOW = 1024
END = np.array([0], "<u4").tobytes()

# A piece: the row's number and id, its first id's place, its ids, the document's tokens.
Piece = tuple[int | None, int, bytes, int]


class Packer:
    def __init__(self, window: int = WINDOW):
        self.window = window
        self.count = np.zeros(window + 1, np.int64)
        self.open: list[list[list[Piece]]] = [[] for _ in range(window + 1)]

    def place(self, piece: Piece) -> list[Piece] | None:
        """Put a piece shorter than the window where it costs least; returns the window if it is full then."""
        size, n = len(piece[2]) // 4, self.count
        # Cost of moving one window from level h to h + size, for h = 1 ... window - size; a full window leaves the count.
        h = n[1 : self.window - size + 1]
        after = 2 * n[size + 1 :] + 1
        if len(after):
            after[-1] = 0
        cost = np.where(h > 0, after - 2 * h + 1, np.iinfo(np.int64).max)
        best = len(cost) - 1 - int(cost[::-1].argmin()) if len(cost) else -1
        if best < 0 or cost[best] > 2 * n[size] + 1:
            level, pieces = 0, []
        else:
            level = best + 1
            n[level] -= 1
            pieces = self.open[level].pop()
        pieces.append(piece)
        if level + size == self.window:
            return pieces
        n[level + size] += 1
        self.open[level + size].append(pieces)
        return None

    def close(self) -> Iterator[list[Piece]]:
        """Fill the fullest open windows with pieces cut from the emptiest, then cut the last one at powers of two."""
        left = [pieces for level in self.open for pieces in level]
        fill = [level for level, windows in enumerate(self.open) for _ in windows]
        low, high = 0, len(left) - 1
        while low < high:
            free = self.window - fill[high]
            while free and low < high:
                piece = left[low].pop()
                size = len(piece[2]) // 4
                if size > free:
                    head, tail = cut(piece, size - free)
                    left[low].append(head)
                    piece, size = tail, free
                left[high].append(piece)
                fill[high] += size
                fill[low] -= size
                free -= size
                if not left[low]:
                    low += 1
            if free == 0:
                yield left[high]
                high -= 1
        if low == high and left[low]:
            rest, total = left[low][::-1], fill[low]
            while total:
                size = 1 << (total.bit_length() - 1)
                total -= size
                window = []
                while size:
                    piece = rest.pop()
                    if len(piece[2]) // 4 > size:
                        piece, tail = cut(piece, size)
                        rest.append(tail)
                    window.append(piece)
                    size -= len(piece[2]) // 4
                yield window


def cut(piece: Piece, at: int) -> tuple[Piece, Piece]:
    doc, start, ids, tokens = piece
    return (doc, start, ids[: 4 * at], tokens), (doc, start + at, ids[4 * at :], tokens)


def windows(batches: Iterator[tuple[list[int | None], list[str]]], path: str, window: int) -> Iterator[list[Piece]]:
    encoder, packer = word_ids.shared(path), Packer(window)
    for ids, texts in batches:
        for doc, found in zip(ids, encoder.encode(texts), strict=True):
            found += END
            tokens = len(found) // 4
            whole = tokens - tokens % window
            for start in range(0, whole, window):
                yield [(doc, start, found[4 * start : 4 * (start + window)], tokens)]
            if whole < tokens and (full := packer.place((doc, whole, found[4 * whole :], tokens))):
                yield full
    yield from packer.close()


SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, with_ids: bool = False) -> DataFrame:
    """One row per piece; with `with_ids` also the ids, as little-endian unsigned 32-bit numbers."""
    names = [x.split()[0] for x in SCHEMA.split(", ")] + ["ids"] * with_ids
    types = [pa.int64()] * 7 + [pa.binary()] * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 40
        # Long texts make few rows of many ids: a batch of output is closed by bytes, not by rows.
        rows, held = [], 0

        def out() -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        given = ((b["doc_id"].to_pylist(), b["text"].to_pylist()) for b in batches)
        for pieces in windows(given, tokenizer, window):
            offset = 0
            for doc, start, ids, tokens in pieces:
                size = len(ids) // 4
                more = (ids,) if with_ids else ()
                rows.append((doc, start, size, zlib.crc32(ids), tokens, number, offset, *more))
                offset += size
                held += len(ids)
            number += 1
            if held > 8 << 20:
                yield out()
                rows, held = [], 0
        if rows:
            yield out()

    return common.texts_of(docs).mapInArrow(run, SCHEMA + (", ids binary" if with_ids else ""))
