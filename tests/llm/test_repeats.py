import hashlib
import random
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridpulse.llm import phrases as ph
from gridpulse.llm import repeats as op
from odd_cases import ODD


def brute_force(rows):
    rank = lambda d: (d is None, d or 0)
    first = {}
    for d, t in rows:
        b = (t or "").encode()
        for i in range(len(b) - 49):
            w = b[i : i + 50]
            first[w] = min(first.get(w, d), d, key=rank)
    out = Counter()
    for d, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - 49):
            if first[b[i : i + 50]] != d:
                gone[i : i + 50] = b"\1" * 50
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out[(d, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())] += 1
    return out


def found(df):
    rows = op.without_repeats(df).collect()
    assert all(hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in rows)
    return Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows)


def test_odd_cases(odd_docs):
    assert found(odd_docs) == brute_force(ODD)


def test_documents(documents, texts_of):
    assert found(documents) == brute_force(list(texts_of.items()))


def test_empty(no_docs):
    assert op.without_repeats(no_docs).collect() == []


def test_shifted_and_overlapping_copies(make_docs):
    rng = random.Random(3)
    base = "".join(rng.choice("abcdefgh \n") for _ in range(4000))
    rows = [(i, base[a:b]) for i, (a, b) in enumerate((rng.randrange(3500), rng.randrange(50, 4000)) for _ in range(60))]
    rows += [(100 + n, "x" * n + base[200 : 249 + n % 3] + "y" * n) for n in range(30)]
    assert found(make_docs(rows)) == brute_force(rows)


def test_low_entropy(make_docs):
    rows = [(i, ("ab" * 60 + "a" * i + "ba" * 40)[i:]) for i in range(25)] + [(50, "ab" * 500), (51, "aab" * 300)]
    assert found(make_docs(rows)) == brute_force(rows)


def test_long_texts_are_parsed_in_segments(make_docs, monkeypatch):
    monkeypatch.setattr(ph, "SEGMENT", 128)
    rng = random.Random(4)
    base = "".join(rng.choice("abcdefghijklmnop") for _ in range(1500))
    rows = [(1, base), (2, base[100:900] + "zz" + base[900:]), (3, base[333:]), (4, base[:700])]
    assert found(make_docs(rows)) == brute_force(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("ab\x00", max_size=180), max_size=4))
def test_every_window_has_one_phrase(texts):
    texts = [t.encode() for t in texts]
    windows = Counter()
    for part in ph.phrases(texts):
        for i, a, b in zip(part["text"].tolist(), part["first"].tolist(), part["last"].tolist(), strict=True):
            assert b - a < ph.SPAN
            windows.update((i, w) for w in range(a, b + 1))
    assert windows == Counter((i, w) for i, t in enumerate(texts) for w in range(len(t) - ph.MATCH + 1))


def test_buckets_get_alike_many_phrases():
    # Triggers are the smallest hashes around them: dealt by these as they are, the first bucket got many times its share.
    rng = random.Random(5)
    text = np.frombuffer("".join(rng.choice("abcdefghijklmnop ") for _ in range(200_000)).encode(), dtype=np.uint8)
    (found,) = ph.phrases([text.tobytes()])
    rows = op._phrase_rows(text, found["first"], found["last"] - found["first"] + ph.MATCH)
    codes = op._trigger_codes(rows)
    assert len(np.unique(codes)) == len(np.unique(found["hash"]))
    for numbers in (codes, op._spread(found["hash"])):
        of = ((numbers >> np.uint64(32)) * np.uint64(50) >> np.uint64(32)).astype(int)
        assert np.bincount(of, minlength=50).max() < 1.5 * len(of) / 50


def test_answers_go_to_all_buckets_alike():
    place = [np.zeros(40_960, dtype=t) for t in op.PLACE]
    dealt, sent = 3, Counter()
    for _ in range(7):
        answers = op._answers(dealt, 7, place)
        dealt += len(answers)
        sent.update(bucket for bucket, *_ in answers)
    assert set(sent.values()) == {10} and len(sent) == 7
