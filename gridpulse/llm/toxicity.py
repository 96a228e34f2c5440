"""Toxicity scores: gradient-boosted trees over dense text features, calibrated by isotonic regression.

One pass over the texts turns each into a fixed vector: how dense lexicon words are, how close they stand to words that
address the reader, how much is capitals, punctuation and disguised spelling. The lexicon is a short fixed list plus
words and word stems that labelled rows mark, so it isn't bound to a language. Labelled training rows are split in three by a hash: one part marks lexicon words, one
grows the trees, one calibrates, so no part grades itself. At most ``SAMPLE`` labelled rows are used.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import id_remainder, stored, texts

SAMPLE = 20_000  # labelled rows to learn from
LEXICON_SIZE = 2_000  # learnt words and stems
STEMS = range(3, 8)  # letters of a stem, the start of a longer word
MIN_MARKED, MIN_RATIO = 3, 4.0  # toxic documents of a learnt entry; odds against clean ones
MEMO = 200_000  # words whose facts a task remembers
REACH = 5  # words between an insult and the person addressed
THRESHOLD = 0.3
TREES, DEPTH, SEED = 20, 3, 17
# General insults, words that address someone, and signs that stand for letters.
INSULTS = """
asshole bastard bitch bullshit clown crap creep cretin damn degenerate despicable dickhead disgusting dumb dumbass
fool fuck fucking garbage hate idiot idiotic imbecile jackass jerk kill liar loser lowlife moron moronic nasty nazi
parasite pathetic pervert pig psycho rat retard retarded scum scumbag shit shut slut sick stupid sucks terrible thug trash
troll ugly useless vermin vile whore worthless
""".split()
SECOND_PERSON = """
you your yours yourself yourselves u ur du dich dir dein deine euch euer ihr tu te toi ton ta tes vous votre vos
usted ustedes tú ti tus vosotros vuestro
""".split()
LOOKALIKE = str.maketrans("0134578@$!|€", "oieastbasile")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGES = ".,;:!?\"'()[]{}<>*#%&$-_~`/\\|+=…«»„“”"
FEATURES = (
    "n_words lexicon_density learnt_density learnt_weight strongest lexicon_count person_density near_person "
    "capital_rate shout_rate exclaim_rate punctuation_rate disguised_rate disguised_lexicon"
).split()


def word_facts(raw: str, insults: frozenset, learnt: dict[str, float], persons: frozenset) -> tuple:
    """(person, shouted, disguised, disguised lexicon word, fixed lexicon word, learnt weight) of one word."""

    def weight(word: str) -> float:
        return max([learnt.get(word, 0.0), *(learnt.get(word[:k] + "*", 0.0) for k in STEMS if k < len(word))])

    word = raw.strip(EDGES).lower()
    disguised = caught = False
    w = weight(word)
    if word and not word.isalpha():
        disguised = word.isascii() and any(c.isalpha() for c in word)
        plain = "".join(c for c in word.translate(LOOKALIKE) if c.isalpha())
        if plain != word and (plain in insults or plain in learnt):
            caught, word, w = True, plain, weight(plain)
    return word in persons, len(raw) > 2 and raw.isupper(), disguised, caught, word in insults, w


def features(text: str, insults: frozenset, learnt: dict[str, float], persons: frozenset, memo: dict) -> list[float]:
    """The feature vector of one text, in the order of ``FEATURES``; all zeros for a text without words."""
    words = WORD.findall(text)
    n = len(words)
    if not n:
        return [0.0] * len(FEATURES)
    hits, people = [], []
    fixed = marked = shouted = disguised = disguised_hits = 0
    weight, strongest = 0.0, 0.0
    for i, raw in enumerate(words):
        facts = memo.get(raw)
        if facts is None:
            facts = word_facts(raw, insults, learnt, persons)
            if not any(facts):
                facts = ()
            if len(memo) >= MEMO:
                memo.clear()
            memo[raw] = facts
        if facts:
            person, shout, hidden, caught, listed, w = facts
            shouted += shout
            disguised += hidden
            disguised_hits += caught
            if person:
                people.append(i)
            if listed or w:
                hits.append(i)
                fixed += listed
                marked += w > 0
                weight += w
                strongest = max(strongest, w)
    at = np.array(people)
    near = 0
    if hits and people:
        place = np.searchsorted(at, hits)
        left = np.abs(np.array(hits) - at[np.maximum(place - 1, 0)])
        right = np.abs(at[np.minimum(place, len(at) - 1)] - np.array(hits))
        near = int((np.minimum(left, right) <= REACH).sum())
    chars = max(len(text), 1)
    signs = sum(map(text.count, ".,;:!?*#%&$@"))
    return [
        math.log1p(n),
        fixed / n,
        marked / n,
        weight / n,
        strongest,
        math.log1p(len(hits)),
        len(people) / n,
        near / n,
        sum(map(str.isupper, text)) / chars,
        shouted / n,
        text.count("!") / chars,
        signs / chars,
        disguised / n,
        disguised_hits / n,
    ]


def learn_lexicon(labelled: DataFrame, size: int = LEXICON_SIZE) -> dict[str, float]:
    """Words, and stems ending in ``*``, that mark toxic documents of ``labelled`` (t, toxic), with log odds.

    ``size`` entries at most.
    """
    words = F.array_distinct(F.transform(F.split(F.lower("t"), r"[\x20\x09-\x0D]+"), lambda w: F.btrim(w, F.lit(EDGES))))
    words = F.filter(words, lambda w: F.length(w).between(2, 40))

    def stems(k: int) -> Column:
        longer = F.filter(words, lambda w: F.length(w) > k)
        return F.transform(longer, lambda w: F.concat(F.substring(w, 1, k), F.lit("*")))

    seen = labelled.select("toxic", F.explode(F.array_distinct(F.concat(words, *map(stems, STEMS)))).alias("word"))
    counts = seen.groupBy("word").agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b"))
    totals = labelled.agg(F.sum("toxic").alias("a"), F.sum(1 - F.col("toxic")).alias("b")).first()
    if not totals["a"] or not totals["b"]:
        return {}
    ratio = ((F.col("a") + 0.1) / (totals["a"] + 1)) / ((F.col("b") + 0.5) / (totals["b"] + 1))
    # Enough documents beyond chance: of a rare word, a few toxic ones are no sign.
    share = totals["a"] / (totals["a"] + totals["b"])
    needed = MIN_MARKED + 3 * share * (F.col("a") + F.col("b"))
    marks = counts.filter((F.col("a") >= needed) & (ratio >= MIN_RATIO)).withColumn("w", F.log(ratio))
    best = marks.orderBy((F.col("w") * F.sqrt("a")).desc(), "word").limit(size).collect()
    return {r["word"]: r["w"] for r in best}


def feature_rows(docs: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """(d, rid, x): every row's feature vector."""
    insults, persons = frozenset(INSULTS), frozenset(SECOND_PERSON)
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo: dict = {}
        for batch in batches:
            rows = [features(batch.column("t")[i].as_py(), insults, shared.value, persons, memo) for i in range(batch.num_rows)]
            x = pa.array(rows, pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("rid"), x], names=["d", "rid", "x"])

    return texts(docs).mapInArrow(measure, "d long, rid long, x array<double>")


def toxicity_scores(docs: DataFrame, labels: DataFrame, folds: int = 4, held_out: int = 2, sample: int = SAMPLE) -> DataFrame:
    """Per row of ``docs``: doc_id, held_out, score, predicted.

    ``labels``: doc_id, toxic (0 or 1; NULL is no label, of several the largest counts). Only labels whose
    crc32(doc_id) modulo ``folds`` is not ``held_out`` are read, of those the ``sample`` with the smallest hashed ids.
    The score is a probability and depends on the text alone; NULL and empty texts are scored like others, as texts
    without words. If a part of the labelled rows lacks either class, the score is 1 - exp(-50 x) for the density x of
    lexicon words.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("ld"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter("ld IS NOT NULL AND toxic IS NOT NULL").filter(id_remainder(F.col("ld"), folds) != held_out)
    known = known.groupBy("ld").agg(F.max("toxic").alias("toxic")).withColumn("part", F.xxhash64("ld"))
    known = stored(known.orderBy("part", "ld").limit(sample).withColumn("part", F.pmod("part", F.lit(10))), "labels")
    used = F.broadcast(known)  # ``sample`` rows at most

    rows = texts(docs)
    marking = rows.join(used.filter("part < 4"), F.col("d") == F.col("ld")).select("t", "toxic")
    lexicon = learn_lexicon(marking)
    measured = stored(feature_rows(docs, lexicon), "toxicity-features")
    out = (id_remainder(F.col("d"), folds) == held_out).alias("held_out")

    learning = measured.dropDuplicates(["d", "rid"]).join(used.filter("part >= 4"), F.col("d") == F.col("ld"))
    learning = stored(learning.select(array_to_vector("x").alias("x"), F.col("toxic").cast("double").alias("toxic"), "part"), "learning")
    learning = learning.coalesce(4)
    classes = learning.groupBy((F.col("part") < 8).alias("grow"), "toxic").count().count()
    if classes < 4:
        density = F.get("x", F.lit(FEATURES.index("lexicon_density"))) + F.get("x", F.lit(FEATURES.index("learnt_density")))
        scored = measured.select("d", out, (1 - F.exp(-50 * density)).alias("score"))
    else:
        trees = GBTClassifier(featuresCol="x", labelCol="toxic", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=SEED)
        model = trees.fit(learning.filter("part < 8"))
        raw = lambda df: model.transform(df).withColumn("p", F.get(vector_to_array("probability"), F.lit(1)))
        steps = IsotonicRegression(featuresCol="p", labelCol="toxic", predictionCol="calibrated").fit(raw(learning.filter("part >= 8")))
        scored = steps.transform(raw(measured.select("d", out, array_to_vector("x").alias("x"))))
        # Isotonic steps are flat; a hundredth of the trees' own probability keeps the order inside a step.
        scored = scored.select("d", "held_out", (0.99 * F.col("calibrated") + 0.01 * F.col("p")).alias("score"))
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return scored.select(
        F.col("d").alias("doc_id"), "held_out", score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted")
    )
