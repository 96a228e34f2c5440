"""Language-model scores: a document's probability summed over all segmentations into pieces of a given vocabulary.

Words are scored once each, not once per occurrence. Counting a word, expecting its pieces and summing its lattice are
passes over the table of distinct words, which grows with the corpus and is never gathered. Documents then need only
sums over their words: frequent words come from a table of fixed size in each task, the others from a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import id_remainder, stored, texts
from gridpulse.llm.lattice import START, Lattice

FREQUENT = 150_000  # words that every task holds
FLUSH = 500_000  # distinct words that a task counts before it passes them on
EM_ROUNDS = 2
PRIOR = 100.0  # weight of the vocabulary's own scores, in pieces


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def read_vocabulary(path: str) -> tuple[list[bytes], np.ndarray]:
    """Pieces and prior probabilities; the file's scores are ranks, read as probabilities falling with the rank.

    All 256 bytes are pieces, so every word has a segmentation.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ranked = sorted(range(model.get_piece_size()), key=lambda i: (-model.get_score(i), i))
    prior: dict[bytes, float] = {bytes([b]): 1e-6 for b in range(256)}
    for rank, i in enumerate(k for k in ranked if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k))):
        piece = model.id_to_piece(i).replace("▁", chr(START)).encode()
        if piece.count(bytes([START])) <= 1 and piece.find(bytes([START])) <= 0:
            prior[piece] = prior.get(piece, 0.0) + 1 / (rank + 10)
    p = np.array(list(prior.values()))
    return list(prior), p / p.sum()


def word_counts(docs: DataFrame, folds: int, held_out: int) -> DataFrame:
    """Every distinct word of ``docs`` as (w, c); c counts rows outside the held-out fold."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        train: Counter = Counter()
        other: set = set()

        def rows() -> pa.RecordBatch:
            words = [*train, *(w for w in other if w not in train)]
            counts = [*train.values(), *[0] * (len(words) - len(train))]
            return pa.RecordBatch.from_arrays([pa.array(words, pa.binary()), pa.array(counts, pa.int64())], names=["w", "c"])

        for batch in batches:
            text, out = batch.column("t"), batch.column("held_out")
            for i in range(batch.num_rows):
                (other if out[i].as_py() else train).update(text[i].as_py().lower().split())
                if len(train) + len(other) >= FLUSH:
                    yield rows()
                    train.clear()
                    other.clear()
        if train or other:
            yield rows()

    rows = texts(docs).select(F.col("t").cast("binary").alias("t"), (id_remainder(F.col("d"), folds) == held_out).alias("held_out"))
    return rows.mapInArrow(count, "w binary, c long").groupBy("w").agg(F.sum("c").alias("c"))


def _chunks(batches: Iterator[pa.RecordBatch], size: int = 200_000) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= size or sum(b.nbytes for b in held) >= 32 << 20:
            yield pa.Table.from_batches(held)
            held = []
    if held:
        yield pa.Table.from_batches(held)


def fit_pieces(words: DataFrame, pieces: list[bytes], prior: np.ndarray, rounds: int = EM_ROUNDS) -> np.ndarray:
    """Piece probabilities after ``rounds`` of expectation maximisation over all distinct training words.

    Each distinct word counts once, because the pieces have to explain new words. Only a sum for each piece reaches
    the driver.
    """
    context = words.sparkSession.sparkContext
    counted, p = words.filter("c > 0"), prior
    for _ in range(rounds):
        shared = context.broadcast((pieces, np.log(p)))

        def expect(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            lattice, total = Lattice(*shared.value), np.zeros(len(shared.value[0]))
            for rows in _chunks(batches):
                total += lattice.expected_counts(rows.column("w").to_pylist(), np.ones(rows.num_rows))
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["piece", "n"])

        sums = counted.mapInArrow(expect, "piece int, n double").groupBy("piece").agg(F.sum("n").alias("n")).collect()
        got = PRIOR * prior
        got[[r["piece"] for r in sums]] += [r["n"] for r in sums]
        p = got / got.sum()
        shared.unpersist()
    return p


def word_scores(words: DataFrame, pieces: list[bytes], p: np.ndarray, total: int, discount: float, new: float) -> DataFrame:
    """``words`` with ``lp``, the log10 of each word's probability.

    The lattice has one arc more than the pieces give, the whole word as counted: its count less ``discount``, of
    ``total``. The mass ``new`` that the discount frees weighs the segmentations.
    """
    shared = words.sparkSession.sparkContext.broadcast((pieces, np.log(p)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(*shared.value)
        for rows in _chunks(batches):
            split = np.log(new) + lattice.log_likelihood(rows.column("w").to_pylist())
            seen = np.maximum(rows.column("c").to_numpy() - discount, 0.0) / max(total, 1)
            with np.errstate(divide="ignore"):
                lp = np.logaddexp(split, np.log(seen)) / math.log(10)
            yield from rows.append_column("lp", pa.array(lp)).to_batches()

    return words.select("w", "c").mapInArrow(score, "w binary, c long, lp double")


def lattice_scores(
    docs: DataFrame,
    vocabulary: str | None = None,
    folds: int = 7,
    held_out: int = 2,
    rounds: int = EM_ROUNDS,
    frequent: int = FREQUENT,
) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Tokens are the words (A-Z lower-cased, split at ASCII white space) and one end. base_score is the add-one unigram
    log10 probability over tokens. score is the log10 of the text's marginal probability: the product over words of the
    sum over all their segmentations, times the probability of the end. A word's segmentations are those into pieces,
    weighted by the mass that absolute discounting leaves for new words, and the whole word as counted. ``vocabulary``
    is an existing SentencePiece file; only probabilities are fitted, by rows whose crc32(doc_id) modulo ``folds`` is
    not ``held_out`` (a NULL id counts as the empty text). NULL and empty texts are the end alone. Without any training
    row the vocabulary's own scores stand and an end has probability 1/1000.
    """
    spark = docs.sparkSession
    words = stored(word_counts(docs, folds, held_out), "word-counts")
    seen = lambda n: F.count_if(F.col("c") == n)
    totals = words.agg(
        F.sum("c").alias("n"), F.count_if(F.col("c") > 0).alias("v"), seen(1).alias("once"), seen(2).alias("twice")
    ).first()
    ends = docs.filter(id_remainder(F.col("doc_id").cast("long"), folds) != held_out).count()
    n_train, n_distinct = (totals["n"] or 0) + ends, totals["v"] + (ends > 0)
    pieces, prior = read_vocabulary(vocabulary or default_vocabulary())
    p = fit_pieces(words, pieces, prior, rounds)
    discount = min(0.9, max(0.1, totals["once"] / max(totals["once"] + 2 * totals["twice"], 1)))
    new = discount * n_distinct / n_train if n_train else 1.0
    scored = stored(word_scores(words, pieces, p, n_train, discount, new), "word-scores")
    # ``frequent`` rows at most, packed for the way to the tasks.
    top = scored.orderBy(F.col("c").desc(), "w").limit(frequent).toArrow()
    columns = (b" ".join(top["w"].to_pylist()), top["c"].to_numpy(), top["lp"].to_numpy())
    packed = spark.sparkContext.broadcast(columns)
    del top, columns
    floor = math.log10(n_train + n_distinct + 1)
    end = (math.log10(ends + 1) - floor, math.log10((ends - discount) / n_train if ends else 1e-3), int(ends > 0))

    def known_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document with the sums over its frequent words, and one for each other word of it."""
        words, counts, logs = packed.value
        table = dict(zip(words.split(), zip(counts.tolist(), logs.tolist(), strict=True), strict=True))
        for batch in batches:
            out: list[list] = [[], [], [], [], [], [], [], []]
            ids, rids, text = batch.column("d").to_pylist(), batch.column("rid").to_pylist(), batch.column("t")
            for i, (d, rid) in enumerate(zip(ids, rids, strict=True)):
                tokens = text[i].as_py().lower().split()
                base, score, known = end
                for w, n in Counter(tokens).items():
                    hit = table.get(w)
                    if hit is None:
                        for column, x in zip(out, (d, rid, w, n, 0, 0, 0.0, 0.0), strict=True):
                            column.append(x)
                    else:
                        base += n * (math.log10(hit[0] + 1) - floor)
                        score += n * hit[1]
                        known += n * (hit[0] > 0)
                # A key that no word has: with a space, and spread over the partitions.
                row = (d, rid, b" %d" % rid, 0, len(tokens) + 1, known, base, score)
                for column, x in zip(out, row, strict=True):
                    column.append(x)
            types = (pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(out, types, strict=True)],
                names=["d", "rid", "dw", "tf", "n_tokens", "known", "base", "lm"],
            )

    schema = "d long, rid long, dw binary, tf long, n_tokens long, known long, base double, lm double"
    parts = texts(docs).select("d", "rid", F.col("t").cast("binary").alias("t")).mapInArrow(known_sums, schema)
    rows = parts.join(scored, F.col("dw") == F.col("w"), "left")
    tf = F.col("tf")
    sums = rows.groupBy("d", "rid").agg(
        F.count_if(F.col("n_tokens") > 0).alias("copies"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("known") + F.when(F.col("c") > 0, tf).otherwise(0)).alias("known"),
        F.sum(F.col("base") + F.when(tf > 0, tf * (F.log10(F.col("c") + 1.0) - floor)).otherwise(0.0)).alias("base"),
        F.sum(F.col("lm") + F.when(tf > 0, tf * F.col("lp")).otherwise(0.0)).alias("lm"),
    )
    # Repeated rows were summed together; they come back as often as they came.
    each = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    per_row = sums.select("*", each.alias("_copy"))
    copies = F.col("copies")
    return per_row.select(
        F.col("d").alias("doc_id"),
        (id_remainder(F.col("d"), folds) == held_out).alias("held_out"),
        F.expr("n_tokens div copies").alias("n_tokens"),
        F.expr("known div copies").alias("n_known"),
        F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("base") / copies).alias("base_score"),
        (F.col("lm") / copies).alias("score"),
    )
