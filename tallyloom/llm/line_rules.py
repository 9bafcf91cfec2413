"""Quality rules, line first: judge every line, remove the failed ones, then reject documents that lost too much.

A line fails as
* navigation: it is cut up by separators such as `|`, `»` or `•`;
* punctuation: it is long enough for a sentence and has no sentence mark, or is mostly symbols, or its words carry
  trailing symbols, or it shouts (all capitals with several exclamation marks);
* boilerplate: it has a set phrase of notices, or repeats an earlier line, or one of its words many times in a row.
The document is rejected if less than `least_kept` of its word characters are left, or too few words.

Null and empty texts have no words, all counts are zero, and they are rejected. Repeated rows are judged each.
Columns other than id and text are not read. No line and no text is cut short.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm import common

LEAST_KEPT = 0.5
LEAST_WORDS = 20
SYMBOLS = b"#*$%&|<>"
_NOT_IN_WORDS = common.WHITE + bytes(range(0x80, 0xC0))
_MARKS = re.compile(rb"[.!?:;,]")
_SEPARATORS = re.compile(rb"[|\xb7]|\xc2\xbb|\xe2\x80\xa2|\s[>/]\s")
_TRAILING = re.compile(rb"(?:[#*$%&@^~=_<>]{2,}|!{2,})(?=\s|$)")
# Set phrases of notices; part of the rule's definition.
_NOTICE = re.compile(
    rb"all rights reserved|terms of (?:use|service)|privacy policy|cookie (?:policy|settings|consent)|accept (?:all )?cookies"
    rb"|sign up for our|subscribe to our|javascript (?:is|must be)|lorem ipsum",
    re.I,
)


def base_counts(text: bytes, words: list[bytes]) -> tuple[int, int, int, int]:
    """Word characters, symbols, repeated lines, words in repeated three-word windows."""
    letters = len(text.translate(None, _NOT_IN_WORDS))
    symbols = len(text) - len(text.translate(None, SYMBOLS))
    lines = [x for x in text.split(b"\n") if x and not x.isspace()]
    windows = list(zip(words, words[1:], words[2:], strict=False))
    counts = Counter(windows) if len(set(windows)) < len(windows) else {}
    covered = 0
    if counts:
        again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
        inside = np.zeros(len(words), bool)
        for k in range(3):
            inside[k : k + len(again)] |= again
        covered = int(inside.sum())
    return letters, symbols, len(lines) - len(set(lines)), covered


def line_fails(line: bytes, words: list[bytes]) -> bool:
    n = len(words)
    if len(_SEPARATORS.findall(line)) * 4 >= n and n >= 3:
        return True
    if n >= 12 and not _MARKS.search(line):
        return True
    if len(_TRAILING.findall(line)) * 4 >= n:
        return True
    if len(line) - len(line.translate(None, SYMBOLS)) > len(line) // 5:
        return True
    if n >= 6 and sum(map(bytes.__eq__, words, words[1:])) * 3 >= n:
        return True
    return _NOTICE.search(line) is not None


def clean_lines(text: bytes) -> tuple[list[bytes], int]:
    """The lines that pass, and how many were removed. Blank lines are neither."""
    kept, seen, removed = [], set(), 0
    for line in text.split(b"\n"):
        words = line.split()
        if not words:
            continue
        if line in seen or line_fails(line, words):
            removed += 1
        else:
            kept.append(line)
        seen.add(line)
    return kept, removed


_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, n_lines_removed long, chars_left long"
)


def judge(docs: DataFrame, least_kept: float = LEAST_KEPT, least_words: int = LEAST_WORDS, with_text: bool = False) -> DataFrame:
    """One row per document: the base counts, the verdict, and with `with_text` the text that is left."""

    def step(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, left = [], []
        for text in common.raw_bytes(batch["text"]):
            words = text.split()
            letters, symbols, lines, repeated = base_counts(text, words)
            failed = len(words) < 50 or 100 * repeated > 50 * len(words)
            kept, removed = clean_lines(text)
            rest = b"\n".join(kept)
            chars = len(rest.translate(None, _NOT_IN_WORDS))
            good = not failed and chars >= least_kept * letters and len(rest.split()) >= least_words
            rows.append((len(words), letters, symbols, lines, repeated, failed, good, removed, chars))
            left.append(rest if with_text else None)
        columns = [pa.array(x) for x in zip(*rows, strict=True)]
        out = [batch["doc_id"], *columns, *([pa.array(left, pa.binary()).cast(pa.string())] if with_text else [])]
        return pa.RecordBatch.from_arrays(out, names)

    schema = _SCHEMA + (", clean_text string" if with_text else "")
    names = [x.split()[0] for x in schema.split(", ")]
    return common.map_arrow(common.texts_of(docs), step, schema)
