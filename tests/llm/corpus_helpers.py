"""Frames and texts for the corpus operators' tests."""

import random

import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def doc_rows(texts, sources=None):
    """(doc_id, text, lang, source, n_chars) for texts, with sources in turn."""
    return [(i, t, "en", (sources or ["a"])[i % len(sources or ["a"])], None if t is None else len(t)) for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def prose():
    """A maker of sentences from a fixed vocabulary, the same for each seed."""
    words = ["".join(random.Random(k).choices("abcdefghijklmnopqrstuvwxyz", k=3 + k % 7)) for k in range(300)]

    def make(seed, n):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))
    return make
