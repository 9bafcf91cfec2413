"""Token ids of whole texts, with the ids of each space-separated word remembered.

The tokenizer's own pre-tokenisation never joins two words across a single space: the space goes to the word after it.
So a text is the concatenation of its words, each but the first with its space in front. Only a space followed by more
white space breaks that rule, and such a text goes to the tokenizer whole. Words that are new are tokenized many at a time,
joined by spaces; only the first id of a word can hold a space, which parts them again. A text that holds a special token's own
text (such as <|endoftext|>) goes to the tokenizer whole too, which makes that one id of it, as it does by itself.

The words of a batch of texts are told apart by Arrow, so each is looked up once a batch, and the ids are put together as arrays.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words remembered in one worker; a speed bound only. When half of them are new, those not seen since the last time are forgotten.
REMEMBERED = 800_000
JOINED = 100
_TWO_SPACES = re.compile(r" \s")


class WordIds:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = [x.content for x in self.tokenizer.get_added_tokens_decoder().values()]
        # A special token with white space in it could arise from two words, so nothing is taken apart then.
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)") if not any(re.search(r"\s", x) for x in added) else re.compile("")
        vocabulary = self.tokenizer.get_vocab()
        self.opens = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        # Byte-level vocabularies write the space as this letter.
        self.opens[[k for token, k in vocabulary.items() if token.startswith("\u0120")]] = True
        self.known: dict[str, bytes] = {}
        self.known_before: dict[str, bytes] = {}

    def _plain(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def _words(self, words: list[str]) -> list[bytes]:
        """The ids of each word with a space in front; no word is empty or begins with white space."""
        texts = [" " + " ".join(words[k : k + JOINED]) for k in range(0, len(words), JOINED)]
        out: list[bytes] = []
        for k, found in enumerate(self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            ids = np.array(found.ids, "<u4")
            edges = np.append(np.flatnonzero(self.opens[ids]), len(ids)).tolist()
            few = words[k * JOINED : (k + 1) * JOINED]
            if len(edges) != len(few) + 1:
                out += self._plain([" " + w for w in few])
                continue
            raw = ids.tobytes()
            out += [raw[4 * a : 4 * b] for a, b in zip(edges, edges[1:])]
        return out

    def _remembered(self, words: list[str]) -> list[bytes]:
        """The ids of each word with a space in front; no word comes twice."""
        if len(self.known) > REMEMBERED // 2:
            self.known, self.known_before = {}, self.known
        known, before = self.known, self.known_before
        ids = list(map(known.get, words))
        missed = [k for k, x in enumerate(ids) if x is None]
        new = []
        for k in missed:
            w = words[k]
            if w in before:
                ids[k] = known[w] = before[w]
            elif w:
                new.append(k)
            else:
                ids[k] = known[w] = self._plain([" "])[0]
        fresh = [words[k] for k in new]
        found = self._words(fresh)
        known.update(zip(fresh, found, strict=True))
        for k, x in zip(new, found, strict=True):
            ids[k] = x
        return ids

    def _parted(self, texts: list[str]) -> list[bytes]:
        """The ids of texts that are the concatenation of their words."""
        split = pc.split_pattern(pa.array(texts, pa.large_string()), " ")
        edges = split.offsets.to_numpy().astype(np.int64)
        words = split.values.dictionary_encode()
        at = words.indices.to_numpy().astype(np.int64)
        # The first word of a text has no space in front.
        first = np.zeros(len(at), bool)
        first[edges[:-1]] = True
        spaced = np.zeros(len(words.dictionary), bool)
        spaced[at[~first]] = True
        ids = self._remembered(words.dictionary.filter(pa.array(spaced)).to_numpy(zero_copy_only=False).tolist())
        place = np.cumsum(spaced) - 1
        openings = words.dictionary.take(pa.array(at[first]))
        at = place[at]
        at[first] = len(ids) + np.arange(len(texts))
        ids += self._plain(openings.to_pylist())
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        starts = np.cumsum(sizes) - sizes
        taken = sizes[at]
        ends = np.append(0, np.cumsum(taken))
        flat = np.frombuffer(b"".join(ids), "<u4")
        raw = flat[np.repeat(starts[at] - ends[:-1], taken) + np.arange(ends[-1])].tobytes()
        cuts = (4 * ends[edges]).tolist()
        return [raw[a:b] for a, b in zip(cuts, cuts[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """For each text its ids as little-endian unsigned 32-bit numbers."""
        parted = [not _TWO_SPACES.search(t) and not self.special.search(t) for t in texts]
        found = iter(self._parted([t for t, p in zip(texts, parted, strict=True) if p]))
        whole = iter(self._plain([t for t, p in zip(texts, parted, strict=True) if not p]))
        return [next(found if p else whole) for p in parted]


@functools.lru_cache(maxsize=4)
def shared(path: str) -> WordIds:
    """One per tokenizer and worker process."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    return WordIds(path)
