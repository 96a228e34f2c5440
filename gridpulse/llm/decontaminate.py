"""Benchmark passages found in documents, also paraphrased: latent semantic retrieval, then checks word by word.

The benchmark is the query set. Its words are the vocabulary; how many documents hold each is counted over the whole
corpus. A randomised SVD of TF-IDF passages (those of the benchmark and all windows of the corpus, which together weigh as
much) gives every word a latent vector, so a window of any length is a difference of two running sums. Windows whose cosine to a benchmark
passage of about their length is high are candidates, unless too few of the passage's rarer words stand around them to
pass the check that follows. Postings of those words tell which passages that leaves, for stretches of a text, so the
bound loses nothing and the latent sums are taken for few. A candidate counts if enough of the item's words stand around
it in the item's order (longest common subsequence), or fewer but also those of its answer, the item's last sentence.

Tasks hold the benchmark, in blocks of ``BLOCK_WORDS`` words however large it is. Documents are split into words once for
each block and stored as numbers, which the SVD and the search read.
"""

from __future__ import annotations

import itertools
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import stored, texts

RANK, EXTRA, POWER_STEPS, SEED = 64, 8, 2, 11
BLOCK_WORDS = 1_000_000  # words of the benchmark searched in one scan of the documents
LENGTHS = (5, 8, 12, 18, 27, 40, 60, 90)  # words of a window; items of over 1.5 times the last have several passages
MIN_COSINE = 0.6
COPY, PARAPHRASE, ANSWER = 0.75, 0.6, 0.8  # share of the item's words; with answer; share of the answer's words
SHORT = 8  # items of fewer words count only word for word
CHUNK = 1024  # words of a text looked at together
SLICE = 250  # texts unpacked together
TOGETHER = 8192  # words of short texts looked through together
EDGES = b".,;:!?\"'()[]{}<>*#%&$@-_~`/\\|+=^"
SIGN, BLANK = 1, 2
KINDS = np.zeros(256, dtype=np.uint8)
KINDS[list(EDGES)], KINDS[list(b" \t\n\r\x0b\x0c")] = SIGN, BLANK
SENTENCE = re.compile(rb"[.!?]\s+|\n+")
WINDOWS = 32  # of the SVD multiplied together


def words_of(text: bytes) -> list[bytes]:
    """Words, A-Z lower-cased, without ASCII signs at either end; those of signs alone are no words."""
    return [w for w in (raw.strip(EDGES) for raw in text.lower().split()) if w]


class Numbers:
    """Words of a text as vocabulary numbers, -1 for words of no item."""

    def __init__(self, vocabulary: dict[bytes, int]):
        self.vocabulary = vocabulary

    def of(self, text: bytes) -> np.ndarray:
        return self.each([text])[0]

    def each(self, texts: list[bytes]) -> list[np.ndarray]:
        """The words of each text; signs at the ends of words are blanked in all texts at once."""
        whole = np.frombuffer(bytearray(b"\n".join([*texts, b""]).lower()), dtype=np.uint8)
        kind = KINDS[whole]
        at = np.flatnonzero(kind)
        if not len(at):
            return [np.empty(0, dtype=np.int32) for _ in texts]
        # Of neighbouring signs and spaces all are between words if any is a space.
        starts = np.flatnonzero(np.concatenate([[True], np.diff(at) > 1]))
        blank = np.maximum.reduceat(kind[at], starts) == BLANK
        whole[at[np.repeat(blank, np.diff(np.append(starts, len(at))))]] = ord(" ")
        clean, out, get, a = whole.tobytes(), [], self.vocabulary.get, 0
        for text in texts:
            words = clean[a : a + len(text)].split()
            out.append(np.fromiter(map(get, words, itertools.repeat(-1)), dtype=np.int32, count=len(words)))
            a += len(text) + 1
        return out


def answer_of(text: bytes) -> bytes:
    """The item's last sentence; the whole item if it has one only."""
    parts = [p for p in SENTENCE.split(text) if words_of(p)]
    return parts[-1] if parts else b""


def common(item: np.ndarray, window: np.ndarray) -> int:
    """Length of the longest common subsequence, a row of the table in one number's bits."""
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | (1 << i)
    full = row = (1 << len(item)) - 1
    for w in window.tolist():
        hit = row & masks.get(w, 0)
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def passages_of(n_words: int) -> list[tuple[int, int]]:
    """(start, end) of an item's passages: the item itself, or overlapping parts of a long one."""
    most = LENGTHS[-1] * 3 // 2
    if n_words <= most:
        return [(0, n_words)]
    starts = range(0, n_words - LENGTHS[-1] // 2, LENGTHS[-1] // 2)
    return [(s, min(n_words, s + LENGTHS[-1])) for s in starts]


def _products(texts: list[np.ndarray], window: int, idf: np.ndarray, thin: np.ndarray, total: np.ndarray) -> None:
    """Adds to ``total`` what the windows of ``texts`` give: the sum, over their TF-IDF vectors x of unit length, of
    x times (x times ``thin``). Windows of ``window`` words follow each other; a text's last one may be shorter.
    ``WINDOWS`` of them are a small matrix over the words they hold."""
    lengths = np.array([len(t) for t in texts])
    n = -(-lengths // window)
    of = np.repeat(np.cumsum(n) - n, lengths)
    of = of + (np.arange(len(of)) - np.repeat(np.cumsum(lengths) - lengths, lengths)) // window
    words = np.concatenate(texts).astype(np.int64)
    words, of, idf = words[words >= 0], of[words >= 0], idf.astype(np.float32)
    place = np.empty(len(idf), dtype=np.int64)  # of each word in the small matrix that holds it
    cuts = np.searchsorted(of, np.arange(0, int(n.sum()) + WINDOWS, WINDOWS))
    for i, (start, end) in enumerate(itertools.pairwise(cuts.tolist())):
        if start == end:
            continue
        some = words[start:end]
        here = np.zeros(len(idf), dtype=bool)  # marking words is cheaper than sorting them
        here[some] = True
        held = np.flatnonzero(here)
        place[held] = np.arange(len(held))
        tf = np.bincount((of[start:end] - i * WINDOWS) * len(held) + place[some], minlength=WINDOWS * len(held))
        x = tf.reshape(WINDOWS, -1).astype(np.float32) * idf[held]
        x /= np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), 1e-12)[:, None]  # windows without known words stay zero
        total[held] += x.T @ (x @ thin[held])


def numbered(rows: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(d, rid, w): the texts as vocabulary numbers in bytes, written once, so that words are split once."""
    shared, kind = rows.sparkSession.sparkContext.broadcast(vocabulary), _number_type(len(vocabulary))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Numbers(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                w = [x.astype(kind).tobytes() for x in known.each(part.column("t").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column("d"), part.column("rid"), pa.array(w, pa.binary())], names=["d", "rid", "w"])

    return stored(rows.select("d", "rid", "t").mapInArrow(split, "d long, rid long, w binary"), "numbered-words")


def _number_type(size: int) -> str:
    return "<i2" if size < 1 << 15 else "<i4"


def word_weights(numbers: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Inverse document frequency of each of ``size`` words over all texts, its share of all words, and the number of texts."""
    kind = _number_type(size)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, uses = np.zeros(size + 1, dtype=np.int64), np.zeros(size + 1, dtype=np.int64)  # the last: of all words
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                texts = [np.frombuffer(w.as_buffer(), dtype=kind) for w in batch.column("w").slice(at, SLICE)]
                words = np.concatenate(texts).astype(np.int64)
                of = np.repeat(np.arange(len(texts)), [len(t) for t in texts])[words >= 0]
                held[-1] += len(texts)
                uses[-1] += len(words)
                words = words[words >= 0]
                uses[:-1] += np.bincount(words, minlength=size)
                held[:-1] += np.bincount(np.unique(of * size + words) % size, minlength=size)
        at = np.flatnonzero(held)
        columns = [pa.array(at, pa.int32()), pa.array(held[at]), pa.array(uses[at])]
        yield pa.RecordBatch.from_arrays(columns, names=["word", "held", "uses"])

    counted = numbers.select("w").mapInArrow(count, "word int, held long, uses long")
    sums = counted.groupBy("word").agg(F.sum("held").alias("held"), F.sum("uses").alias("uses")).collect()
    n = np.zeros((2, size + 1))
    for r in sums:
        n[:, r["word"]] = r["held"], r["uses"]
    idf = np.log((n[0, -1] + 1) / (n[0, :-1] + 1)) + 0.1
    return idf, n[1, :-1] / max(n[1, -1], 1), int(n[0, -1])


def latent_words(numbers: DataFrame, window: int, passages: list[np.ndarray], weights: np.ndarray) -> np.ndarray:
    """A vector for each word, such that a passage's latent vector is the sum over its words.

    The right singular vectors of the TF-IDF matrix, times the weights. Its rows are the benchmark's ``passages`` and every
    window of ``window`` words of the texts in ``numbers``; the windows count so much less that all of them weigh as much
    as the passages. Each step multiplies a thin matrix by the rows in parallel; the driver adds the benchmark's own and
    orthogonalises what has a row for each vocabulary word.
    """
    spark, size = numbers.sparkSession, len(weights)
    kind, width = _number_type(size), min(RANK + EXTRA, size)
    n_windows = numbers.agg(F.sum(F.ceil(F.octet_length("w") / F.lit(np.dtype(kind).itemsize * window)))).first()[0] or 1

    def times(thin: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast((weights, thin.astype(np.float32)))

        def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            idf, q = shared.value
            total = np.zeros(q.shape)
            for batch in batches:
                for _, held in _together(batch, kind):
                    _products(held, window, idf, q, total)
            at = np.flatnonzero(total.any(axis=1))
            for start in range(0, len(at), CHUNK):
                some = at[start : start + CHUNK]
                rows = pa.array(total[some].tolist(), pa.list_(pa.float64()))
                yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), rows], names=["word", "v"])

        rows = numbers.select("w").mapInArrow(multiply, "word int, v array<double>")
        sums = rows.groupBy("word").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).toArrow()
        out = np.zeros((size, thin.shape[1]))
        if sums.num_rows:
            out[sums["word"].to_numpy()] = np.array(sums["v"].to_pylist())
        out *= min(1.0, len(passages) / n_windows)
        for p in passages:
            _products([p], max(len(p), 1), weights, shared.value[1], out)
        shared.unpersist()
        return out

    basis = np.linalg.qr(np.random.default_rng(SEED).standard_normal((size, width)))[0]
    for _ in range(POWER_STEPS):
        basis = np.linalg.qr(times(basis))[0]
    values, turn = np.linalg.eigh(basis.T @ times(basis))
    best = np.argsort(values)[::-1][:RANK]
    return ((basis @ turn[:, best]) * weights[:, None]).astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-9)


def _reach(n: int, length: int) -> int:
    """Words on either side of a window that can belong to a copy of a passage of ``n`` words."""
    return n - length + max(2, length // 2) + n // 8


@dataclass
class Group:
    """The passages searched with windows of one length; they are numbered from ``offset`` in the index."""

    passages: list[tuple[int, int, int]]  # item, start, end
    vectors: np.ndarray  # latent, of unit length
    offset: int
    reach: int


@dataclass
class Index:
    """Passages by length of their windows, and for each word the passages that it tells: as a rule their rarer words."""

    groups: dict[int, Group]
    need: np.ndarray  # telling words that a copy of each passage holds at least
    reach: np.ndarray  # words of a window of each passage with those around it that belong to a copy
    starts: np.ndarray  # of each word's postings; words of no item come last and have none
    postings: np.ndarray

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, passage) of every telling word of a passage among ``words``."""
        first, n = self.starts[words], self.starts[words + 1] - self.starts[words]
        position = np.repeat(np.arange(len(words)), n)
        inside = np.arange(len(position)) - np.repeat(np.cumsum(n) - n, n)
        return position, self.postings[np.repeat(first, n) + inside]

    def in_a_stretch(self, position: np.ndarray, passage: np.ndarray) -> np.ndarray:
        """Passages of which some stretch as wide as their windows reach has as many hits as a copy needs."""
        passage, _ = self._near(position, passage)
        return np.unique(passage)

    def open_texts(self, texts: list[np.ndarray]) -> np.ndarray:
        """Numbers of the texts that have such a passage. ``texts``: words, those of no item with the last number."""
        gap = int(self.reach.max())  # no stretch reaches from one text into the next
        starts = np.cumsum([0, *(len(t) + gap for t in texts)])
        position, passage = self.hits(np.concatenate(texts))
        position += np.repeat(starts[:-1] - np.cumsum([0, *(len(t) for t in texts[:-1])]), [len(t) for t in texts])[position]
        _, position = self._near(position, passage)
        return np.unique(np.searchsorted(starts, position, side="right") - 1)

    def _near(self, position: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(passage, position) of the first hit of every stretch that has enough."""
        enough = (np.bincount(passage, minlength=len(self.need)) >= self.need)[passage]
        width = int(position.max()) + 1 if len(position) else 1
        key = np.sort(passage[enough] * width + position[enough])
        passage, position = key // width, key % width
        last = np.arange(len(key)) + self.need[passage] - 1
        inside = last < len(key)
        passage, position, last = passage[inside], position[inside], last[inside]
        near = (key[last] // width == passage) & (key[last] % width - position < self.reach[passage])
        return passage[near], position[near]


def _telling(words: np.ndarray, often: np.ndarray, width: int) -> tuple[np.ndarray, int]:
    """The words of a passage that tell it best, and how many of them a copy holds at least.

    A copy matches a share of the words, so of the rarest m it lacks at most those that need not match. Any m gives a
    bound that holds; the one is taken that ``width`` words of other texts reach least likely, by Chernoff's bound.
    """
    matching = math.ceil((PARAPHRASE if len(words) >= SHORT else 1.0) * len(words) - 1e-9)
    ranked = words[np.argsort(often[words], kind="stable")]
    first = np.zeros(len(ranked), dtype=bool)
    first[np.unique(ranked, return_index=True)[1]] = True
    expected = width * np.cumsum(np.where(first, often[ranked], 0.0)) + 1e-9
    least = np.arange(1, len(words) + 1) - (len(words) - matching)
    with np.errstate(divide="ignore", invalid="ignore"):
        chance = np.where(least > expected, least - expected + least * np.log(expected / least), 0.0)
    m = int(np.argmin(np.where(least > 0, chance, np.inf)))
    return np.unique(ranked[: m + 1]), int(least[m])


def prepared(items: list[tuple[int, np.ndarray, np.ndarray]], latent: np.ndarray, often: np.ndarray) -> Index:
    """The index of the passages of all ``items``. ``often``: each word's share of all words of the corpus."""
    parts: dict[int, list] = {}
    for k, (_, numbers, _) in enumerate(items):
        for start, end in passages_of(len(numbers)):
            length = max([n for n in LENGTHS if n <= end - start], default=end - start)
            parts.setdefault(length, []).append((k, start, end))
    groups, need, widths, pairs = {}, [], [], []
    for length, passages in parts.items():
        words = [items[k][1][start:end] for k, start, end in passages]
        vectors = _unit(np.array([latent[w].sum(axis=0) for w in words]))
        reach = max(_reach(len(w), length) for w in words)
        groups[length] = Group(passages, vectors, len(need), reach)
        for w in words:
            telling, least = _telling(w, often, length + 2 * reach)
            pairs.append(np.column_stack([telling, np.full(len(telling), len(need))]))
            need.append(least)
            widths.append(length + 2 * reach)
    both = np.concatenate(pairs) if pairs else np.zeros((0, 2), dtype=np.int64)
    both = both[np.argsort(both[:, 0], kind="stable")]
    starts = np.searchsorted(both[:, 0], np.arange(len(often) + 2))
    return Index(groups, np.array(need, dtype=np.int64), np.array(widths, dtype=np.int64), starts, both[:, 1].astype(np.int64))


def find(numbers: np.ndarray, items: list, index: Index, latent: np.ndarray) -> dict[int, tuple]:
    """Items found in one text: (share of words, share of the answer's words, cosine, place) of each.

    ``latent`` has a last row of zeros, for words of no item.
    """
    found: dict[int, tuple] = {}
    overlap = max(n + 2 * g.reach for n, g in index.groups.items())
    known = np.where(numbers >= 0, numbers, len(latent) - 1)
    for start in range(0, max(1, len(numbers) - overlap), CHUNK):
        part, sums = known[start : start + CHUNK + overlap], None
        if not len(part):
            continue
        position, passage = index.hits(part)
        open_ = index.in_a_stretch(position, passage)
        for length, group in index.groups.items() if len(open_) else ():
            chosen = open_[(open_ >= group.offset) & (open_ < group.offset + len(group.passages))]
            if not len(chosen):
                continue
            asked, need = chosen - group.offset, index.need[chosen]
            size = min(length, len(part))  # a text shorter than the windows is one window
            position_here, place = _of(position, passage, chosen, len(index.need))
            at = np.unique(np.append(np.arange(0, len(part) - size + 1, max(1, size // 2)), len(part) - size))
            low, high = np.maximum(at - group.reach, 0), np.minimum(at + size + group.reach, len(part))
            # Telling words of each passage around each window, counted where they stand: few of the part's words are.
            keys, own = np.sort(place * (len(part) + 1) + position_here), np.arange(len(asked)) * (len(part) + 1)
            possible = np.searchsorted(keys, own + high[:, None]) - np.searchsorted(keys, own + low[:, None]) >= need
            some = np.flatnonzero(possible.any(axis=1))
            if not len(some):
                continue
            at, possible = at[some], possible[some]
            if len(some) * size < len(part):
                windows = latent[part[at[:, None] + np.arange(size)]].sum(axis=1)
            else:
                if sums is None:
                    sums = np.zeros((len(part) + 1, latent.shape[1]), dtype=np.float32)
                    np.cumsum(latent[part], axis=0, out=sums[1:])
                windows = sums[at + size] - sums[at]
            cosines = _unit(windows) @ group.vectors[asked].T
            for w, p in zip(*np.nonzero(possible & (cosines >= MIN_COSINE)), strict=True):
                k, first, last = group.passages[asked[p]]
                judged = judge(numbers, start + int(at[w]), size, items[k], first, last)
                if judged and judged > found.get(k, (0.0, 0.0))[:2]:
                    found[k] = (*judged, float(cosines[w, p]), start + int(at[w]))
    return found


def _of(position: np.ndarray, passage: np.ndarray, chosen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hits of the ``chosen`` passages: positions, and places in ``chosen``."""
    place = np.full(n, -1)
    place[chosen] = np.arange(len(chosen))
    place = place[passage]
    return position[place >= 0], place[place >= 0]


def judge(numbers: np.ndarray, at: int, length: int, item: tuple, first: int, last: int) -> tuple[float, float] | None:
    """Shares of the passage's words, and of the answer's, around a window in the right order; None if too few."""
    _, words, answer = item
    passage = words[first:last]
    n = len(passage)
    if n < SHORT:
        near = range(max(0, at - length), min(len(numbers) - n, at + length) + 1)
        return (1.0, 1.0) if any(np.array_equal(numbers[i : i + n], passage) for i in near) else None
    reach = _reach(n, length)
    window = numbers[max(0, at - reach) : at + length + reach]
    window = window[window >= 0]  # words of no item match nothing
    share = common(passage, window) / n
    if share < PARAPHRASE:
        return None
    kept = common(answer, window) / max(len(answer), 1)
    return (share, kept) if share >= COPY or kept >= ANSWER else None


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, rid, item_id, word_share, answer_share, cosine, word_at), one for each document and item in it.

    ``docs``: doc_id, text. ``benchmark``: item_id, text. Words are A-Z lower-cased and without ASCII signs at their ends.
    An item is in a document if three quarters of its words (of a long item, of one passage of it) stand there in order
    within about its length, or 60 % and 80 % of its last sentence's. Items of fewer than eight words must stand there word
    for word. Items without words, with NULL text or NULL item_id, and documents without words give no row. rid tells
    rows with the same doc_id and other texts apart; rows repeated whole give one.
    """
    spark = docs.sparkSession
    rows = texts(docs).select("d", "rid", F.col("t").cast("binary").alias("t"))
    asked = benchmark.select(F.col("item_id").cast("long").alias("item"), F.col("text").cast("string").alias("text"))
    asked = asked.filter("item IS NOT NULL AND text IS NOT NULL").select("item", F.col("text").cast("binary").alias("t")).distinct()
    total = asked.agg(F.sum(F.size(F.split(F.col("t").cast("string"), r"\s+")))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_WORDS))
    schema = "d long, rid long, item_id long, word_share double, answer_share double, cosine double, word_at long"
    out = spark.createDataFrame([], schema)
    for b in range(n_blocks):
        # A block holds about ``BLOCK_WORDS`` words, whatever the benchmark's size.
        block = asked.filter(F.pmod(F.xxhash64("item", "t"), F.lit(n_blocks)) == b).orderBy("item", "t").collect()
        block = [(r["item"], bytes(r["t"])) for r in block if words_of(bytes(r["t"]))]
        if block:
            out = out.unionByName(_leaks_of_block(rows, block, schema))
    best = F.max(F.struct("word_share", "answer_share", "cosine", (-F.col("word_at")).alias("back"))).alias("best")
    one = out.groupBy("d", "rid", "item_id").agg(best)
    shown = [F.col(f"best.{c}").alias(c) for c in ("word_share", "answer_share", "cosine")]
    return one.select(F.col("d").alias("doc_id"), "rid", "item_id", *shown, (-F.col("best.back")).alias("word_at"))


def _leaks_of_block(rows: DataFrame, block: list[tuple[int, bytes]], schema: str) -> DataFrame:
    spark = rows.sparkSession
    vocabulary: dict[bytes, int] = {}
    for _, text in block:
        for w in words_of(text):
            vocabulary.setdefault(w, len(vocabulary))
    texts_as_numbers = numbered(rows, vocabulary)
    weights, often, _ = word_weights(texts_as_numbers, len(vocabulary))
    numbers = Numbers(vocabulary)
    items = [(i, numbers.of(t), numbers.of(answer_of(t))) for i, t in block]
    own = [words[a:z] for _, words, _ in items for a, z in passages_of(len(words))]
    window = max(5, sum(map(len, own)) // len(own))
    latent = latent_words(texts_as_numbers, window, own, weights)
    index = prepared(items, latent, often)
    packed = {**vars(index), "groups": {n: vars(g) for n, g in index.groups.items()}}
    shared = spark.sparkContext.broadcast((items, packed, np.vstack([latent, np.zeros_like(latent[:1])])))
    kind = _number_type(len(vocabulary))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, packed, vectors = shared.value
        searched = Index(**{**packed, "groups": {n: Group(**g) for n, g in packed["groups"].items()}})
        other = len(vectors) - 1
        for batch in batches:
            out: list[tuple] = []
            for rows_of, numbers in _together(batch, kind):
                known = [np.where(n >= 0, n, other) for n in numbers]
                for i in searched.open_texts(known).tolist():
                    row = rows_of[i]
                    for k, (share, kept, cosine, at) in find(numbers[i], asked, searched, vectors).items():
                        d, rid = batch.column("d")[row].as_py(), batch.column("rid")[row].as_py()
                        out.append((d, rid, asked[k][0], share, kept, cosine, at))
            if out:
                names = ["d", "rid", "item_id", "word_share", "answer_share", "cosine", "word_at"]
                types = [pa.int64()] * 3 + [pa.float64()] * 3 + [pa.int64()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return texts_as_numbers.mapInArrow(search, schema)


def _together(batch: pa.RecordBatch, kind: str) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """The texts of a batch with any words, some at a time: row numbers and words."""
    rows, held, size = [], [], 0
    for i, w in enumerate(batch.column("w")):
        words = np.frombuffer(w.as_buffer(), dtype=kind)
        if len(words):
            rows.append(i)
            held.append(words.astype(np.int64))
            size += len(words)
        if size >= TOGETHER:
            yield rows, held
            rows, held, size = [], [], 0
    if held:
        yield rows, held


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; other rows and columns are unchanged."""
    found = leaks(docs, benchmark).select(F.col("doc_id").alias("__d"), F.col("rid").alias("__rid")).distinct()
    rid = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(found["__d"]) & (rid == found["__rid"])
    return docs.join(found.hint("shuffle_hash"), same, "left_anti")
