"""Token ids of whole texts by a public byte-level BPE vocabulary, words remembered by hash.

The vocabulary's pre-tokenizer always cuts before a single space, and before and after a single
line feed, that stands between two characters other than white space. A *simple* text has no
other white space and only ASCII and Latin characters (U+00A1 to U+023F); its ids are therefore
those of its words one after the other, each word with the space or line feed before it, and
equal words have equal ids. Words are looked up in numpy by a 64-bit hash; new ones go, joined
by line feeds, to the rank file's encoder, which holds the same merges. Any other text is encoded
as one by the vocabulary's own encoder.
"""

from __future__ import annotations

import base64
from functools import cached_property

import numpy as np

from strata.llm.common import kept
from strata.llm.words import U64, seeds, split

VOCABULARY = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Words that a worker remembers (about 30 bytes each).
REMEMBERED = 1_000_000
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, 0x0A]] = True
#: Bytes of simple texts; a lead byte C2 only before A1 to BF.
_SIMPLE = np.zeros(256, bool)
_SIMPLE[[0x20, 0x0A, *range(0x21, 0x7F), *range(0x80, 0xC0), *range(0xC2, 0xC9)]] = True
_KINDS = np.concatenate([np.zeros(1, U64), seeds(2, 99)])  # after a space, after a line feed, first of a text


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(VOCABULARY), public_tokenizers.path(RANKS)


def simple(text: bytes) -> bool:
    if not text or text[0] in b" \n" or text[-1] in b" \n":
        return not text
    data = np.frombuffer(text, np.uint8)
    blank = _BLANK[data]
    latin = (data[:-1] == 0xC2) & (data[1:] < 0xA1)
    return bool(_SIMPLE[data].all() and not (blank[1:] & blank[:-1]).any() and not latin.any())


class Encoder:
    def __init__(self, vocabulary: str, ranks: str):
        import tiktoken
        from public_tokenizers import PATTERN

        self.vocabulary = vocabulary
        with open(ranks, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=merges, special_tokens={})
        self.feed = merges[b"\n"]
        # sorted word hashes, and where the ids of each begin and end in ``ids``
        self.keys = np.zeros(0, U64)
        self.begin, self.end = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint16)

    @cached_property
    def tokenizer(self):
        """The vocabulary's own encoder, loaded when a text needs it."""
        from tokenizers import Tokenizer

        out = Tokenizer.from_file(self.vocabulary)
        out.encode_special_tokens = True
        return out

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of each UTF-8 text as unsigned 32-bit numbers."""
        plain = [i for i, t in enumerate(texts) if simple(t)]
        out: list[np.ndarray] = [np.zeros(0, "<u4")] * len(texts)
        for i, ids in zip(plain, self._simple([texts[i] for i in plain])):
            out[i] = ids
        rest = sorted({*range(len(texts))} - {*plain})
        if not rest:
            return out
        for i, e in zip(rest, self.tokenizer.encode_batch([texts[i].decode() for i in rest], add_special_tokens=False)):
            out[i] = np.array(e.ids, "<u4")
        return out

    def _simple(self, texts: list[bytes]) -> list[np.ndarray]:
        if not texts:
            return []
        words = split(texts, _BLANK)
        kind = (words.data[words.starts - 1] == 0x0A).astype(np.int8)
        kind[words.first[:-1][np.diff(words.first) > 0]] = 2
        keys, at, back = np.unique(words.hashes() ^ _KINDS[kind], return_index=True, return_inverse=True)
        begin, end, ids = self._look_up(keys, at, kind, words)
        size = (end - begin)[back]
        to = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=to[1:])
        stream = ids[np.repeat(begin[back] - to[:-1], size) + np.arange(to[-1])].astype("<u4")
        bounds = to[words.first]
        return [stream[a:z] for a, z in zip(bounds, bounds[1:])]

    def _look_up(self, keys, at, kind, words):
        """Begin and end of each key's ids, and the ids."""
        place = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        new = self.keys[place] != keys if len(self.keys) else np.ones(len(keys), bool)
        begin, end = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        begin[~new], end[~new] = self.begin[place[~new]], self.end[place[~new]]
        if not new.any():
            return begin, end, self.ids
        which = at[new]
        joined = words.data.tobytes()
        spelled = [joined[s:e].decode() for s, e in zip(words.starts[which].tolist(), words.ends[which].tolist())]
        kinds = kind[which]
        fresh = np.array(self.fast.encode_ordinary("\n".join(
            [w if k else " " + w for w, k in zip(spelled, kinds.tolist())])), np.uint16)
        stops = np.concatenate([np.flatnonzero(fresh == self.feed), [len(fresh)]])
        assert len(stops) == len(spelled)
        # a word after a line feed also takes the feed's id, which stands right before it
        fresh = np.concatenate([np.array([self.feed], np.uint16), fresh])
        starts = np.concatenate([[0], stops[:-1] + 1]) + 1 - (kinds == 1)
        begin[new], end[new] = starts + len(self.ids), stops + 1 + len(self.ids)
        ids = np.concatenate([self.ids, fresh])
        if len(self.keys) + len(which) <= REMEMBERED:
            order = np.argsort(np.concatenate([self.keys, keys[new]]), kind="stable")
            self.keys = np.concatenate([self.keys, keys[new]])[order]
            self.begin = np.concatenate([self.begin, begin[new]])[order]
            self.end = np.concatenate([self.end, end[new]])[order]
            self.ids = ids
        return begin, end, ids


def encoder(vocabulary: str, ranks: str) -> Encoder:
    """One encoder per worker process and vocabulary."""
    return kept((vocabulary, ranks), lambda: Encoder(vocabulary, ranks))
