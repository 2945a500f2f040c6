import random

import numpy as np
import pyarrow as pa
import pytest

from spendlake.llm import text as X
from spendlake.llm import tokens
from tests.llm.helpers import words

TEXTS = ["", None, "a", " \t\n", "The the THE tHe\x0bx", "é ü\x0cß  z", "\x00 a\x00b", "x" * 700_000 + " y " + "z" * 300_000, "a b c d e f"]


def test_words_are_those_of_the_pattern():
    data, offsets = X.utf8(pa.array(TEXTS))
    data = X.LOWER[data]
    found = X.find_words(data, offsets)
    for d, t in enumerate(TEXTS):
        own = [data[a:b].tobytes().decode() for a, b in zip(found.start[found.first[d]:found.first[d + 1]], found.end[found.first[d]:found.first[d + 1]])]
        assert own == words(t)


def test_equal_words_and_only_those_have_equal_hashes():
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("ab\u00e9") for _ in range(rng.randint(1, 6))) for _ in range(5000))
    data, offsets = X.utf8(pa.array([text, text[::-1]]))
    found = X.find_words(data, offsets)
    by = {}
    for a, b, h in zip(found.start, found.end, X.word_hashes(data, found).tolist()):
        by.setdefault(data[a:b].tobytes(), set()).add(h)
    assert all(len(v) == 1 for v in by.values()) and len({h for v in by.values() for h in v}) == len(by)


def test_slices_cover_all_texts_and_hold_one_long_text():
    offsets = np.cumsum([0, 3, 0, 50, 2, 2, 0])
    assert [(lo, hi) for lo, hi in X.slices(offsets, 5)][0][0] == 0
    covered = [i for lo, hi in X.slices(offsets, 5) for i in range(lo, hi)]
    assert covered == list(range(6))


def test_shingle_sets_match_brute_force():
    texts = TEXTS[:7] + TEXTS[8:] + ["a b c d e a b c d e a b c d e", "one two three"]
    data, offsets = X.utf8(pa.array(texts))
    for t, s in zip(texts, X.shingle_sets(data, offsets)):
        w = words(t)
        want = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        assert len(s) == len(want)


@pytest.mark.parametrize("seed", range(3))
def test_token_ids_are_the_librarys(seed):
    own = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"))
    rng = random.Random(seed)
    bits = ["a", "the", " ", "  ", "\n", "\t", "'s", "<|endoftext|>", "1", "é", "\u00a0", "\u3000", "\u200b", "\x85", "\x1c", "!", "..", "'", "\u180e", "日本", "\r\n", "|", "x" * 50]
    texts = ["", " ", "a", *("".join(rng.choice(bits) for _ in range(rng.randint(0, 40))) for _ in range(3000))]
    assert own.encode(texts) == own.plain(texts)
    assert own.encode(texts[::-1]) == own.plain(texts[::-1])     # with a filled memo


def test_a_slice_holds_its_own_ids_and_not_the_memo():
    """What is gathered for a few pieces does not grow with what the worker has met before."""
    own = tokens.Encoder(tokens.vocabulary("byte_bpe_50k.json"))
    many = " ".join(f"word{i}" for i in range(20_000))
    few = "of the word7 and a never1met word9 word7"
    own.encode([many])
    pieces = pa.array(sorted(set(few.split()[1:])), pa.large_string())
    ids, begin, size = own.known(pieces)
    assert len(ids) == size.sum() < 40 < len(own.ids)
    for p, a, n in zip(pieces.to_pylist(), begin.tolist(), size.tolist()):
        assert ids[a:a + n].tolist() == own.library.encode(" " + p, add_special_tokens=False).ids
    assert own.encode([few, "", many]) == own.plain([few, "", many])
