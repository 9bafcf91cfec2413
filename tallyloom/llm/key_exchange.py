"""Totals of keys over a whole table, asked for and answered in blocks.

Counting every word sequence of a corpus as rows would shuffle several times the corpus. Here the rows of a table are dealt
into blocks by their hash; a block sends each of its distinct 64-bit keys once, with a count, packed into one binary value for
each range of keys; the owner of the range adds up and answers with the totals in the order of the question. The block then
goes over its rows again with the totals at hand. What moves is the table once and a few bytes for each key of a block.

Blocks and ranges are even whatever the texts are, since both follow from hashes: a text that a third of all rows share has
one key set for each block. Both sizes grow with the square root of the table, so that one packed value keeps about a
kilobyte: 4 MB blocks up to 32 GB of text, and some 230 MB for 100 TB.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BLOCK = 4 << 20
ASKED = "part long, block long, keys binary, counts binary"
ANSWER = "block long, part long, totals binary"


def block_bytes(total: int) -> int:
    return max(LEAST_BLOCK, int((512 * total) ** 0.5))


def with_blocks(rows: DataFrame, total: int, *by: str) -> DataFrame:
    blocks = max(1, -(-total // block_bytes(total)))
    return rows.withColumn("block", F.pmod(F.xxhash64(*by), F.lit(blocks)))


def planes(values: np.ndarray) -> bytes:
    """Equal bytes of all numbers side by side: the high ones of sorted keys are runs, which the shuffle compresses."""
    width = values.dtype.itemsize
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, width).T).tobytes()


def numbers(data: bytes, kind: str) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(width, -1).T).view(kind).ravel()


def ranges(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each range of sorted keys begins, and the end."""
    edges = np.array([(k << 64) // parts for k in range(1, parts)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def exchange(
    rows: DataFrame,
    total: int,
    keys_of: Callable[[pa.Table], tuple[list[tuple[np.ndarray, np.ndarray]], Any]],
    use: Callable[[pa.Table, list[np.ndarray], Any], pa.Table],
    schema: str,
    drop_bits: int = 0,
    summary: Callable[[int, np.ndarray], bytes] | None = None,
) -> DataFrame:
    """Rows with a `block` column in, rows of `schema` out.

    keys_of gives, for the rows of a block, sorted distinct keys with counts for each kind of key, and anything else that
    `use` wants to have; `use` gets the rows, the totals for each kind, and that. `drop_bits`: low bits of a key that need
    not be told apart. `summary` makes bytes of the kind and the totals of each range of keys; `use` gets all of them once,
    with an empty table and no totals.
    """
    parts = max(1, -(-total // (2 * block_bytes(total))))

    def ask(table: pa.Table) -> pa.Table:
        found, _ = keys_of(table)
        block = table["block"][0].as_py()
        out = []
        for kind, (keys, counts) in enumerate(found):
            at = ranges(keys, parts)
            sent = keys >> np.uint64(drop_bits)
            width = 8 - drop_bits // 8
            for part in range(parts):
                cut = slice(at[part], at[part + 1])
                raw = planes(sent[cut])
                # The highest bytes that drop_bits has emptied are not sent.
                out.append((kind * parts + part, block, raw[: width * (cut.stop - cut.start)], planes(counts[cut].astype("<u4"))))
        return pa.table(
            [pa.array(x, t) for x, t in zip(zip(*out, strict=True), (pa.int64(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
            names=["part", "block", "keys", "counts"],
        )

    def answer(table: pa.Table) -> pa.Table:
        part = table["part"][0].as_py()
        asked = [numbers(x + bytes(len(x) // (8 - drop_bits // 8) * (drop_bits // 8)), "<u8") for x in table["keys"].to_pylist()]
        counts = [numbers(x, "<u4") for x in table["counts"].to_pylist()]
        _, place = np.unique(np.concatenate(asked), return_inverse=True)
        totals = np.bincount(place, np.concatenate(counts)) if len(place) else np.zeros(0)
        told = totals[place].astype("<u8")
        cuts = np.cumsum([len(x) for x in asked])[:-1]
        blocks, sent = table["block"].to_pylist(), [planes(x) for x in np.split(told, cuts)]
        if summary is not None:
            blocks.append(-1)
            sent.append(summary(part // parts, totals))
        return pa.table(
            [pa.array(blocks, pa.int64()), pa.array([part] * len(blocks), pa.int64()), pa.array(sent, pa.binary())],
            names=["block", "part", "totals"],
        )

    def apply(left: pa.Table, right: pa.Table) -> pa.Table:
        if left.num_rows == 0:
            return use(left, [], right["totals"].to_pylist())
        found, state = keys_of(left)
        order = np.argsort(right["part"].to_numpy(), kind="stable")
        told = [right["totals"][int(k)].as_py() for k in order]
        totals = [
            np.concatenate([numbers(x, "<u8") for x in told[kind * parts : (kind + 1) * parts]]) for kind in range(len(found))
        ]
        return use(left, totals, (found, state))

    answers = rows.groupBy("block").applyInArrow(ask, ASKED).groupBy("part").applyInArrow(answer, ANSWER)
    return rows.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(apply, schema)
