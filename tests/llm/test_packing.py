import itertools
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from gridpulse.llm import packing as op
from odd_cases import ODD


def padding(lengths, counts, bounds):
    total, low = 0, 0
    for b in bounds:
        total += sum(c * (b - n) for n, c in zip(lengths, counts, strict=True) if low < n <= b)
        low = b
    return total


def test_boundaries_are_optimal():
    rng = random.Random(1)
    for _ in range(40):
        lengths = sorted(rng.sample(range(1, 60), rng.randint(1, 9)))
        counts = [rng.randint(1, 30) for _ in lengths]
        k = rng.randint(1, 5)
        found = op.optimal_boundaries(lengths, counts, k)
        choices = (
            (*c, lengths[-1]) for n in range(min(k, len(lengths))) for c in itertools.combinations(lengths[:-1], n)
        )
        assert found == sorted(set(found)) and found[-1] == lengths[-1] and len(found) <= k
        assert padding(lengths, counts, found) == min(padding(lengths, counts, c) for c in choices)


def check(rows, texts, max_length, n_buckets, budget):
    pieces = defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
    expected = Counter()
    for d, t in texts:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
        sizes = [max_length] * (n // max_length) + ([n % max_length] if n % max_length or not n else [])
        expected.update((d, i, len(sizes), s) for i, s in enumerate(sizes))
    assert Counter((r.doc_id, r.piece, r.n_pieces, r.n_tokens) for r in rows) == expected
    full = [r for r in rows if r.n_tokens]
    assert all(r.batch_id is None and r.bucket_length is None for r in rows if not r.n_tokens)
    histogram = Counter(r.n_tokens for r in full)
    lengths = sorted(histogram)
    bounds = op.optimal_boundaries(lengths, [histogram[n] for n in lengths], n_buckets)
    batches = defaultdict(list)
    for r in full:
        assert r.bucket_length == min(b for b in bounds if b >= r.n_tokens) and r.padding == r.bucket_length - r.n_tokens
        batches[r.batch_id].append(r)
    open_batches = Counter()
    for rows_of in batches.values():
        (length,) = {r.bucket_length for r in rows_of}
        room = max(1, budget // length)
        assert sorted(r.slot for r in rows_of) == list(range(len(rows_of))) and len(rows_of) <= room
        open_batches[length] += len(rows_of) < room
    assert all(n <= 1 for n in open_batches.values()) and sorted(batches) == list(range(len(batches)))


def test_odd_cases(odd_docs):
    check(op.pack(odd_docs, 100, 3, 400).collect(), ODD, 100, 3, 400)


def test_documents(documents, texts_of):
    found = op.pack(documents, 300, 5, 2000).collect()
    check(found, list(texts_of.items()), 300, 5, 2000)


def test_hot_bucket_and_own_length(make_docs):
    rows = [(i, "x" * (7 if i % 3 else i % 50)) for i in range(900)]
    found = op.pack(make_docs(rows), 40, 4, 64, length=F.length("t")).collect()
    assert sum(r.n_tokens for r in found) == sum(len(t) for _, t in rows)
    assert max(Counter(r.batch_id for r in found if r.n_tokens).values()) <= 64


def test_empty(no_docs, make_docs):
    assert op.pack(no_docs).collect() == []
    assert [r.batch_id for r in op.pack(make_docs([(1, None)])).collect()] == [None]
