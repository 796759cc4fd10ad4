import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from userflow.llm import words

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
TEXTS = st.lists(st.one_of(st.none(), st.text(st.sampled_from("aAbZ é\t\n.9☃"), max_size=30), st.text(max_size=20)), max_size=12)


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def of(texts, size, alphabet):
    return [
        [tuple(found.hashes[a:b].tolist()) for a, b in zip(found.bounds[:-1], found.bounds[1:], strict=True)]
        for part in words.slices(pa.array(texts, pa.string()), size)
        for found in [words.words(part, alphabet)]
    ]


@settings(max_examples=200, deadline=None)
@given(TEXTS, st.sampled_from([1, 40, 1 << 20]), st.sampled_from(["alnum", "spaced"]))
def test_hashes_stand_for_words(texts, size, kind):
    pattern, alphabet = (ALNUM, words.ALNUM) if kind == "alnum" else (SPACED, words.SPACED)
    got = [row for part in of(texts, size, alphabet) for row in part]
    want = [pattern.findall(lowered(t)) for t in texts]
    assert [len(g) for g in got] == [len(w) for w in want]
    names = {}
    for hashes, found in zip(got, want, strict=True):
        for h, word in zip(hashes, found, strict=True):
            assert names.setdefault(h, word) == word
    assert len(names) == len(set(names.values()))


@settings(max_examples=100, deadline=None)
@given(TEXTS, st.integers(1, 4))
def test_windows_are_consecutive_words(texts, n):
    names = {}
    for part in words.slices(pa.array(texts, pa.string())):
        found = words.windows(words.words(part), n)
        for i, (a, b) in enumerate(zip(found.bounds[:-1], found.bounds[1:], strict=True)):
            own = SPACED.findall(lowered(texts[part.first + i]))
            want = [tuple(own[j : j + n]) for j in range(len(own) - n + 1)] or ([tuple(own)] if own else [])
            assert b - a == len(want)
            for h, window in zip(found.hashes[a:b].tolist(), want, strict=True):
                assert names.setdefault(h, window) == window
    assert len(names) == len(set(names.values()))
