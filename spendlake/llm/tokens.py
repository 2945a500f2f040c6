"""Token ids of texts as the ``tokenizers`` library gives them, with a bounded memo.

Byte-level BPE first cuts a text so that no cut piece goes from a visible character into white
space. A single space between two visible characters therefore always begins a new piece, and
what stands between two such spaces is encoded alike wherever it stands. Texts are cut, their pieces
made distinct and their ids put together array-wise, so Python sees only the distinct pieces of a slice
of text. Each worker keeps the ids of the first pieces it has met, up to ``MEMO_BYTES`` of them, and
other pieces go to the library in one call per slice.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from spendlake.llm import text as X

MEMO_BYTES = 48 << 20   # of hashes, places and ids: about 35 bytes a piece
SLICE = 1 << 20         # bytes of text encoded at once
#: A space between two characters that are surely visible for every white-space definition.
_INVISIBLE = r"\s\x00-\x1f\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
_CUT = re.compile(f"(?<=[^{_INVISIBLE}]) (?=[^{_INVISIBLE}])")
#: The same characters for the search in whole columns: a space that is not such a cut.
_ODD_SPACE = " [{0}]|[{0}] |^ | $".format("".join(
    ["\\x00-\\x20\\x7f-\\x{a0}", *(f"\\x{{{c}}}" for c in ("1680", "180e")), "\\x{2000}-\\x{200f}", "\\x{2028}-\\x{202f}", "\\x{205f}-\\x{206f}", "\\x{3000}", "\\x{feff}"]))


def _runs(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places begin:begin + size of all runs, one after the other."""
    end = np.cumsum(size)
    return np.repeat(begin - (end - size), size) + np.arange(int(end[-1]) if len(end) else 0)


class Encoder:
    """Encodes whole texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        import os
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        size = self.library.get_vocab_size()
        self.spaced = np.array([(self.library.id_to_token(i) or "").startswith("Ġ") for i in range(size)])
        # pieces by a 128-bit hash, ordered by its first half; ids of all pieces one after the other
        self.hash1, self.hash2 = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begin, self.size, self.ids = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, "<u4")

    def plain(self, texts: list[str]) -> list[bytes]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, "<u4").tobytes() for x in found]

    def learn(self, pieces: list[str]) -> list[bytes]:
        """The ids of pieces that follow a space, from the library."""
        out: dict[str, bytes] = {}
        simple = [p for p in pieces if " " not in p]
        for lo in range(0, len(simple), 20_000):
            some = simple[lo:lo + 20_000]
            ids = np.array(self.library.encode_batch_fast([" " + " ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cuts = np.flatnonzero(self.spaced[ids])
            if len(cuts) == len(some) and len(cuts) and cuts[0] == 0:
                bounds = [*(4 * cuts).tolist(), 4 * len(ids)]
                raw = ids.tobytes()
                out.update((p, raw[a:b]) for p, a, b in zip(some, bounds, bounds[1:]))
            else:
                out.update(zip(some, self.plain([" " + p for p in some])))
        rest = [p for p in pieces if " " in p]
        if rest:
            out.update(zip(rest, self.plain([" " + p for p in rest])))
        return [out[p] for p in pieces]

    def known(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size): the ids of distinct pieces that follow a space lie at begin:begin + size.

        They are these pieces' ids alone: the memo is never copied for a slice once it is full."""
        data, offsets = X.utf8(pieces)
        words = X.Words(offsets[:-1], offsets[1:], offsets)
        hash1, hash2 = X.word_hashes(data, words), X.word_hashes(data ^ np.uint8(0x5A), words)
        place = np.searchsorted(self.hash1, hash1)
        at = np.minimum(place, max(0, len(self.hash1) - 1))
        hit = (self.hash1[at] == hash1) & (self.hash2[at] == hash2) if len(self.hash1) else np.zeros(len(place), bool)
        new, at = np.flatnonzero(~hit), at[hit]
        learned = self.learn(pieces.take(pa.array(new)).to_pylist()) if len(new) else []
        size = np.empty(len(place), np.int64)
        size[hit], size[new] = self.size[at], [len(x) // 4 for x in learned]
        begin = np.cumsum(size) - size
        ids = np.empty(int(size.sum()), "<u4")
        ids[_runs(begin[hit], size[hit])] = self.ids[_runs(self.begin[at], size[hit])]
        fresh = np.frombuffer(b"".join(learned), "<u4")
        ids[_runs(begin[new], size[new])] = fresh
        if len(new) and self.ids.nbytes + 28 * len(self.hash1) < MEMO_BYTES:     # full: what came first, and so is common, stays
            own = len(self.ids) + np.cumsum(size[new]) - size[new]
            self.ids = np.concatenate([self.ids, fresh])
            order = np.argsort(hash1[new], kind="stable")
            to = place[new][order]
            for name, values in (("hash2", hash2[new]), ("begin", own), ("size", size[new]), ("hash1", hash1[new])):
                setattr(self, name, np.insert(getattr(self, name), to, values[order]))
        return ids, begin, size

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids.tobytes() for ids in self.slices(pa.array(texts, pa.string()))]

    def slices(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of every text of a column, in order; a null text is empty."""
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        column = pc.fill_null(column.cast(pa.large_string()), "")
        offsets = X.utf8(column)[1]
        for lo, hi in X.slices(offsets, SLICE):
            yield from self._slice(column.slice(lo, hi - lo))
        give_back()         # what a batch frees would stay with the worker and grow with the next ones

    def _slice(self, texts: pa.Array) -> list[np.ndarray]:
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        lists = pc.split_pattern(texts, " ")
        first, pieces = lists.offsets.to_numpy().astype(np.int64), lists.flatten()
        first = first - first[0]
        if odd.any():       # cut these by the exact rule
            cut = [_CUT.split(t) for t in texts.filter(pa.array(odd)).to_pylist()]
            own = iter(cut)
            parts = [next(own) if o else pieces.slice(a, b - a).to_pylist() for o, a, b in zip(odd.tolist(), first[:-1].tolist(), first[1:].tolist())]
            first = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
            pieces = pa.array([x for p in parts for x in p], pa.large_string())
        # a text's first piece follows no space: it is encoded by itself
        head = np.zeros(len(pieces), bool)
        head[first[:-1]] = True
        coded = pieces.filter(pa.array(~head)).dictionary_encode()
        ids, begin, size = self.known(coded.dictionary)
        heads = self.plain(pieces.take(pa.array(first[:-1])).to_pylist())
        own = np.array([len(x) // 4 for x in heads], np.int64)
        begin = np.concatenate([begin, len(ids) + np.cumsum(own) - own])
        size = np.concatenate([size, own])
        source = np.concatenate([ids, np.frombuffer(b"".join(heads), "<u4")])
        which = np.empty(len(pieces), np.int64)
        which[~head] = coded.indices.to_numpy(zero_copy_only=False)
        which[head] = len(coded.dictionary) + np.arange(len(texts))
        length = size[which]
        end = np.cumsum(length)
        out = source[_runs(begin[which], length)]
        edges = np.concatenate([[0], end])[first]
        return [out[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]


_ENCODERS: dict[str, Encoder] = {}


def give_back() -> None:
    """Hand free memory back to the system: a worker that is used again holds what earlier stages freed."""
    import ctypes
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def encoder(path: str) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    give_back()
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def vocabulary(name: str) -> str:
    """Where a public vocabulary file lies (every machine has it)."""
    import public_tokenizers
    return public_tokenizers.path(name)


def version(path: str) -> str:
    """Digest of a tokenizer: its library, the library's version and its file."""
    import tokenizers
    with open(path, "rb") as f:
        return hashlib.sha256(f"tokenizers {tokenizers.__version__}\n".encode() + f.read()).hexdigest()
