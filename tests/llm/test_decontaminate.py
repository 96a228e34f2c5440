import random
from collections import Counter

import numpy as np
import pytest

from gridpulse.llm import decontaminate as op
from odd_cases import ODD


@pytest.fixture(scope="module")
def benchmark(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/benchmark.parquet")


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


def test_common_is_the_longest_common_subsequence():
    rng = random.Random(9)
    for _ in range(200):
        a, b = ([rng.randint(0, 4) for _ in range(rng.randint(1, 30))] for _ in range(2))
        assert op.common(np.array(a), np.array(b)) == lcs(a, b)


def test_documents(documents, texts_of, benchmark):
    """Every passage that stands in a text word for word is found, and little else."""
    items = {r.item_id: r.text for r in benchmark.collect()}
    exact = {(d, i) for d, t in texts_of.items() for i, x in items.items() if x in t}
    found = {(r.doc_id, r.item_id): r for r in op.leaks(documents, benchmark).collect()}
    assert exact and exact <= set(found)
    for (d, i), r in found.items():
        assert r.word_share >= op.PARAPHRASE and 0 < r.cosine <= 1.001
        words = op.words_of(items[i].encode())
        # The whole text holds at least what the window around the place does.
        assert lcs(words, op.words_of(texts_of[d].encode())) >= op.PARAPHRASE * min(len(words), op.LENGTHS[-1])


def test_paraphrases_and_clean_texts(spark, documents, benchmark):
    """Items with a tenth of their words replaced are found wherever they stand; shuffled ones are not."""
    rng = random.Random(7)
    items = [(r.item_id, r.text.split()) for r in benchmark.collect() if len(r.text.split()) >= 25][:12]
    filler = [t.text.split() for t in documents.limit(40).collect()]
    rows, planted = [], set()
    for n, (item, words) in enumerate(items):
        changed = [f"other{n}" if rng.random() < 0.1 else w for w in words]
        around = filler[n]
        at = rng.randint(0, len(around))
        rows.append((n, "".join(c.upper() if c.isascii() else c for c in " ".join(around[:at] + changed + around[at:]))))
        planted.add((n, item))
        rows.append((100 + n, " ".join(rng.sample(words, len(words)))))
    df = spark.createDataFrame([(d, t, 1, 2) for d, t in rows], "doc_id long, text string, rid int, item_id int")
    found = {(r.doc_id, r.item_id) for r in op.leaks(df, benchmark).collect()}
    assert len(planted & found) >= 0.9 * len(planted) and not any(d >= 100 for d, _ in found)


def test_shortened_items_as_whole_documents(spark, documents, benchmark):
    """An item that lost a tenth to a quarter of its words is found where it is all of a document."""
    rng = random.Random(5)
    items = [(r.item_id, op.words_of(r.text.encode())) for r in benchmark.orderBy("item_id").collect()]
    rows, shorter = [], 0
    for share in (0.1, 0.2, 0.25):
        for item, words in items:
            left = sorted(rng.sample(range(len(words)), len(words) - int(share * len(words))))
            rows.append((10_000 + len(rows), b" ".join(words[i] for i in left).decode(), item))
            shorter += len(left) < max(n for n in op.LENGTHS if n <= len(words))
    assert shorter >= len(items)
    df = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string").unionByName(documents.select("doc_id", "text"))
    found = {(r.doc_id, r.item_id) for r in op.leaks(df, benchmark).collect()}
    assert {(d, item) for d, _, item in rows} <= found


@pytest.mark.parametrize("share", [0.25, 0.4])
def test_recall_at_the_limits_of_the_check(spark, documents, benchmark, share):
    """Of all items that still pass the word-by-word check with so many words replaced, nine of ten are found and more.

    With four tenths replaced only the answer's words stay, as far as the check asks for them.
    """
    rng = random.Random(int(share * 100))
    filler = [op.words_of(t.text.encode()) for t in documents.orderBy("doc_id").limit(60).collect()]
    other = sorted({w for f in filler for w in f})
    rows = []
    for item in benchmark.orderBy("item_id").collect():
        words, answer = op.words_of(item.text.encode()), len(op.words_of(op.answer_of(item.text.encode())))
        if len(words) < op.SHORT or len(words) > op.LENGTHS[-1] * 3 // 2:
            continue
        free = range(len(words) if share <= 0.25 else len(words) - answer)
        if len(free) < int(share * len(words)):
            continue
        gone = set(rng.sample(free, int(share * len(words))))
        changed = [rng.choice(other) if i in gone else w for i, w in enumerate(words)]
        around, at = filler[len(rows) % len(filler)], rng.randint(0, 30)
        rows.append((10_000 + len(rows), b" ".join([*around[:at], *changed, *around[at:]]).decode(), item.item_id))
    assert len(rows) >= 5
    df = spark.createDataFrame([(d, t) for d, t, _ in rows], "doc_id long, text string").unionByName(documents.select("doc_id", "text"))
    found = {(r.doc_id, r.item_id) for r in op.leaks(df, benchmark).collect()}
    planted = {(d, item) for d, _, item in rows}
    assert len(planted & found) >= 0.9 * len(planted), (len(planted & found), len(planted))


def test_telling_words_bound_every_copy():
    """Whatever words a copy keeps, it has as many telling ones as the index asks for."""
    rng = random.Random(3)
    for _ in range(300):
        n = rng.randint(1, 60)
        words = np.array([rng.randint(0, 40) for _ in range(n)])
        often = np.array([rng.choice([0.2, 0.01, 0.0001, 0.0]) for _ in range(41)])
        telling, least = op._telling(words, often, rng.randint(5, 200))
        need = int(np.ceil((op.PARAPHRASE if n >= op.SHORT else 1.0) * n - 1e-9))
        kept = rng.sample(range(n), need)
        assert least >= 1 and sum(int(words[i]) in set(telling.tolist()) for i in kept) >= least


def test_odd_cases(spark, odd_docs, no_docs, benchmark):
    items = [(1, None), (2, ""), (3, "..."), (None, "One line that repeats in other documents"), (5, "One line that repeats in other documents"),
             (6, "many words " * 200), (7, "second line"), (7, "second line")]
    asked = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    found = Counter((r.doc_id, r.item_id) for r in op.leaks(odd_docs, asked).collect())
    holders = {d for d, t in ODD if t and "one line that repeats" in t.lower()}
    assert {d for d, i in found if i == 5} == holders and {d for d, i in found if i == 7} == {4}
    assert set(i for _, i in found) == {5, 7}
    assert op.leaks(no_docs, asked).collect() == [] and op.leaks(odd_docs, asked.filter("false")).collect() == []
    kept = op.without_leaks(odd_docs, asked)
    assert kept.columns == odd_docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(d for d, t in ODD if not (t and "one line that repeats" in t.lower()))


def test_blocks_of_a_large_benchmark(monkeypatch, documents, texts_of, benchmark):
    monkeypatch.setattr(op, "BLOCK_WORDS", 1500)
    exact = {(d, r.item_id) for r in benchmark.collect() for d, t in texts_of.items() if r.text in t}
    assert {(r.doc_id, r.item_id) for r in op.leaks(documents, benchmark).collect()} >= exact


def test_all_windows_of_the_corpus_shape_the_latent_vectors(spark, monkeypatch):
    monkeypatch.setattr(op, "RANK", 1)
    rng, window, size = np.random.default_rng(4), 5, 6
    texts = [rng.integers(-1, size, rng.integers(0, 23)).astype("<i2") for _ in range(2_500)]
    passages, idf = [np.array([0, 1, 2, 0]), np.array([3, 3])], np.linspace(0.5, 2.0, size)
    numbers = spark.createDataFrame([(i, i, t.tobytes()) for i, t in enumerate(texts)], "d long, rid long, w binary").repartition(5)

    def gram(windows):
        rows = [np.bincount(w[w >= 0], minlength=size) * idf for w in windows]
        unit = np.array([r / max(np.linalg.norm(r), 1e-12) for r in rows])
        return unit.T @ unit

    windows = [t[a : a + window] for t in texts for a in range(0, len(t), window)]
    values, vectors = np.linalg.eigh(gram(windows) * len(passages) / len(windows) + gram(passages))
    found = op.latent_words(numbers, window, passages, idf)
    assert found.shape == (size, 1)
    assert np.allclose(np.abs(found[:, 0]), np.abs(vectors[:, -1] * idf), atol=1e-4)


def test_windows_are_multiplied_in_blocks_of_their_words():
    """No row for each word: of texts that hold few different ones only those few are multiplied."""
    rng, window, size = np.random.default_rng(5), 7, 50
    texts = [rng.integers(-1, size, n) for n in (0, 3, 7, 8, 900, 1)] + [np.full(9, -1)]
    idf, thin, total = np.linspace(0.5, 2.0, size), rng.standard_normal((size, 4)).astype(np.float32), np.ones((size, 4))
    op._products(texts, window, idf, thin, total)
    rows = [np.bincount(w[w >= 0], minlength=size) * idf for t in texts for w in (t[a : a + window] for a in range(0, len(t), window))]
    unit = np.array([r / max(np.linalg.norm(r), 1e-12) for r in rows])
    assert len(rows) > 2 * op.WINDOWS and np.allclose(total, 1 + unit.T @ (unit @ thin), atol=1e-4)


def test_signs_are_blanked_in_all_texts_at_once():
    rng = np.random.default_rng(6)
    texts = [bytes(rng.choice(list(b"abZ.,- \n\t\x00\x1c\x85"), size=n).astype(np.uint8)) for n in rng.integers(0, 30, 2_000)]
    vocabulary = {b"a": 0, b"ab": 1, b"a.b": 2, b"z-a": 3, b"b": 4}
    found = op.Numbers(vocabulary).each(texts)
    assert [x.tolist() for x in found] == [[vocabulary.get(w, -1) for w in op.words_of(t)] for t in texts]
    assert [x.tolist() for x in op.Numbers(vocabulary).each([b"", b""])] == [[], []] and op.Numbers(vocabulary).each([]) == []
