import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gridpulse.llm import lattice_lm as op
from gridpulse.llm.lattice import Lattice
from odd_cases import ODD

PIECES = [b" a", b" ab", b"b", b"ab", b"a", b"c", b" ", b"abc", b" abca"]
LOG_P = np.log(np.array([0.2, 0.1, 0.15, 0.05, 0.2, 0.1, 0.1, 0.05, 0.05]))


def segmentations(text, p):
    """Every way to cut ``text`` into pieces, as lists of pieces."""
    if not text:
        yield []
    for piece in p:
        if text.startswith(piece):
            yield from ([piece, *rest] for rest in segmentations(text[len(piece) :], p))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text("abc", min_size=1, max_size=7), min_size=1, max_size=6))
def test_marginals_and_expected_counts(words):
    words = [w.encode() for w in words]
    lattice, p = Lattice(PIECES, LOG_P), dict(zip(PIECES, np.exp(LOG_P), strict=True))
    total, counts = [], np.zeros(len(PIECES))
    for w in words:
        ways = [(math.prod(p[x] for x in s), s) for s in segmentations(b" " + w, p)]
        mass = sum(m for m, _ in ways)
        total.append(math.log(mass))
        for m, s in ways:
            for x in s:
                counts[PIECES.index(x)] += m / mass
    assert lattice.log_likelihood(words) == pytest.approx(total)
    assert lattice.expected_counts(words, np.ones(len(words))) == pytest.approx(counts)


def test_long_words_take_the_same_sums():
    lattice = Lattice(PIECES, LOG_P)
    for word in (b"abc" * 21, b"abc" * 22, b"a" * 2000):
        alpha = [0.0] + [-math.inf] * (len(word) + 1)
        text = b" " + word
        for j in range(1, len(text) + 1):
            for piece, lp in zip(PIECES, LOG_P, strict=True):
                if text[:j].endswith(piece):
                    alpha[j] = np.logaddexp(alpha[j], alpha[j - len(piece)] + lp)
        assert lattice.log_likelihood([word, b"ab"])[0] == pytest.approx(alpha[-1])


def held_out(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2


def check_base(rows, texts):
    train = [t for d, t in texts if not held_out(d)]
    counts = Counter(w for t in train for w in (t or "").encode().lower().split())
    n, v, ends = sum(counts.values()) + len(train), len(counts) + bool(train), len(train)
    expected = []
    for d, t in texts:
        words = (t or "").encode().lower().split()
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in words) + math.log10((ends + 1) / (n + v + 1))
        known = sum(counts[w] > 0 for w in words) + bool(ends)
        expected.append((str(d), held_out(d), len(words) + 1, known, n, base))
    found = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows)
    assert [f[:5] for f in found] == [e[:5] for e in sorted(expected)]
    assert [f[5] for f in found] == pytest.approx([e[5] for e in sorted(expected)])
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_odd_cases(odd_docs):
    check_base(op.lattice_scores(odd_docs, rounds=1, frequent=5).collect(), ODD)


def test_documents_and_frequent_words(documents, texts_of):
    """The table of frequent words is a shortcut: with few or many words in it the scores are the same."""
    few = {r.doc_id: r for r in op.lattice_scores(documents, rounds=1, frequent=20).collect()}
    many = {r.doc_id: r for r in op.lattice_scores(documents, rounds=1).collect()}
    check_base(list(few.values()), list(texts_of.items()))
    assert [few[d].score for d in texts_of] == pytest.approx([many[d].score for d in texts_of])


def test_scores_tell_texts_from_shuffled_letters(make_docs, texts_of):
    """Held-out texts are likelier than the same words with their letters reversed."""
    rows = list(texts_of.items())
    turned = [(d + 10_000, " ".join(w[::-1] for w in t.split())) for d, t in rows if held_out(d + 10_000)]
    plain = [(d - 10_000, t) for d, t in rows if held_out(d + 10_000)]
    train = [(d, t) for d, t in rows if not held_out(d)]
    found = {r.doc_id: r.score for r in op.lattice_scores(make_docs(train + turned)).collect()}
    other = {r.doc_id: r.score for r in op.lattice_scores(make_docs(train + plain)).collect()}
    pairs = [(other[d - 20_000], found[d]) for d, _ in turned if d in found and d - 20_000 in other]
    assert pairs and sum(a > b for a, b in pairs) >= 0.95 * len(pairs)


def test_without_training_rows(make_docs):
    ids = [d for d in range(200) if held_out(d)][:3]
    rows = op.lattice_scores(make_docs([(d, "the cat") for d in ids])).collect()
    assert {(r.train_tokens, r.n_known, r.held_out) for r in rows} == {(0, 0, True)} and all(r.score < -3 for r in rows)


def test_empty(no_docs):
    assert op.lattice_scores(no_docs).collect() == []
