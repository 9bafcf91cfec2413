"""Packing: an exact round trip."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from tallyloom.llm import packing, queries, word_ids
from tests.llm.conftest import ODD

PATH = queries.public_tokenizer()


def plain_ids(texts):
    """By a tokenizer as it comes from its file."""
    found = Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)
    return [np.array(x.ids, "<u4").tobytes() for x in found]


def test_a_special_token_is_one_id():
    assert np.frombuffer(word_ids.WordIds(PATH).encode(["a <|endoftext|> b"])[0], "<u4").tolist() == [64, 220, 50256, 275]


def test_words_are_the_tokenizers_ids():
    r = random.Random(0)
    texts = ["", " ", "  ", "a  b", "a   b", "a \n b", "\n\n x", "x\n\n y\t z ", "it's  don't 'll", "　a 　b", " é́ <|endoftext|> x"]
    texts += ["".join(r.choice(" \n\tab1!'s<é|漢") for _ in range(40)) for _ in range(3000)]
    special = "<|endoftext|>"
    texts += [special, f"a {special} b", f"a{special}b {special}{special}", f"{special} ", f" x  {special}\n y", special[:-1], f"a {special[:5]} {special[5:]}"]
    memory = word_ids.WordIds(PATH)
    wanted = plain_ids(texts)
    assert memory.encode(texts) == wanted
    assert memory.encode(texts[::-1]) == wanted[::-1]


def test_words_that_come_again_are_not_forgotten(monkeypatch):
    monkeypatch.setattr(word_ids, "REMEMBERED", 40)
    memory, asked = word_ids.WordIds(PATH), []
    monkeypatch.setattr(memory, "_words", lambda words, own=memory._words: asked.extend(words) or own(words))
    for k in range(30):
        texts = ["the same words", "", "x ", " the same", " ".join(f"n{k}w{i}" for i in range(12))]
        assert memory.encode(texts) == plain_ids(texts)
        assert len(memory.known) + len(memory.known_before) <= 80
    assert asked.count("same") == 1 and asked.count("words") == 1 and len(asked) == len(set(asked))


def check(docs, rows, window=1024):
    wanted = sorted((i is not None, i or 0, x + packing.END) for (i, _), x in zip(rows, plain_ids([t or "" for _, t in rows]), strict=True))
    pieces = packing.pack(docs, PATH, window, with_ids=True).collect()
    sequences, texts = defaultdict(list), defaultdict(lambda: defaultdict(list))
    for p in pieces:
        assert p.length * 4 == len(p.ids) > 0 and p.ids_crc32 == zlib.crc32(p.ids)
        sequences[p.sequence_id].append((p.offset, p.length))
        texts[p.doc_id][p.start].append((p.ids, p.doc_tokens))
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    assert padding == 0
    if len({i for i, _ in rows}) == len(rows):
        found = sorted((i is not None, i or 0, b"".join(parts[s][0][0] for s in sorted(parts))) for i, parts in texts.items())
        assert found == wanted
        assert all(t == sum(len(x) for s in parts.values() for x, _ in s) // 4 for parts in texts.values() for s in parts.values() for _, t in s)
    assert sum(p.length for p in pieces) == sum(len(x) // 4 for _, _, x in wanted)


@pytest.mark.parametrize("window", [64, 1024])
def test_round_trip(documents, window):
    check(documents, [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()], window)


def test_odd_rows(odd, empty):
    check(odd, ODD)
    assert packing.pack(empty, PATH).count() == 0


def test_placement_costs_least():
    r = random.Random(2)
    packer = packing.Packer(32)
    for _ in range(2000):
        size = r.randrange(1, 32)
        before = packer.count.copy()
        costs = []
        for level in range(0, 32 - size + 1):
            if level and not before[level]:
                continue
            after = before.copy()
            if level:
                after[level] -= 1
            if level + size < 32:
                after[level + size] += 1
            costs.append(int((after**2).sum()))
        packer.place((0, 0, b"\0\0\0\0" * size, size))
        assert int((packer.count**2).sum()) == min(costs)
