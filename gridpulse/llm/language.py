"""Language identification by Bayesian fusion of text, declared language, address and host.

The text model is naive Bayes over hashed byte trigrams. Its evidence is tempered to that of ``EVIDENCE`` trigrams, as
trigrams of one text are far from independent. What a declaration or an address suffix says about the language, and
what languages a host or its domain uses, is counted over all rows with the text model's first guesses. Host priors are
smoothed towards the domain's, domain priors towards the corpus'. Counts are grouped aggregations and come back by
joins; nothing that grows with the number of hosts is gathered.

Texts of no modelled language, and junk, are a class of their own: its log probability of a trigram is halfway between
what each language's labelled rows have under the other rows of that language and what even odds over all slots give.
Only trigrams of letters count for it, so numbers and signs between words don't make a text strange.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import stored

SLOTS = 1 << 16
SAMPLE = 8_000  # labelled rows of a language, about, that the text model learns from
MIN_LABELLED, MAX_LANGUAGES = 3, 200  # labelled rows of a language; languages
EVIDENCE, MIN_LETTERS, MIN_POSTERIOR = 60, 3, 0.5
HOST_WEIGHT = 10.0
UNKNOWN = "und"
MARKUP = re.compile(rb"<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.S | re.I)
LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])
HASHES = 1 << 30
STRANGE_ODDS = math.log(1000)  # for a text of a modelled language, before its trigrams are looked at


def _trigrams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Slots of all trigrams, how many each text has, and each text's letters (bytes from 128 on count as such)."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8).astype(np.uint32)
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    ends = np.cumsum(lengths)
    letters = np.diff(np.concatenate([[0], np.cumsum(LETTER[data])])[np.concatenate([[0], ends])])
    if len(data) < 3:
        return np.empty(0, dtype=np.int64), np.zeros(len(texts), dtype=np.int64), letters
    mixed = (data[:-2] * 0x9E3779B1 + data[1:-1] * 0x85EBCA6B + data[2:] * 0xC2B2AE35).astype(np.uint32)
    slots = ((mixed ^ (mixed >> 15)) * np.uint32(0x2C1B3C6D)) >> np.uint32(16)
    inside = np.ones(len(data), dtype=bool)
    for back in (1, 2):
        at = ends - back
        inside[at[(at >= 0) & (lengths >= back)]] = False
    return slots[inside[: len(slots)]].astype(np.int64), np.maximum(lengths - 2, 0), letters


def _in_words(texts: list[bytes]) -> np.ndarray:
    """Whether each trigram of ``_trigrams`` is of letters, or of two and a space."""
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data) < 3:
        return np.empty(0, dtype=bool)
    letter, blank = LETTER[data], data == 0x20
    n = letter[:-2].astype(np.int8) + letter[1:-1] + letter[2:]
    fits = (n == 3) | ((n == 2) & (blank[:-2] | blank[1:-1] | blank[2:]))
    starts = [np.arange(max(len(t) - 2, 0)) for t in texts]
    before = np.cumsum([0, *map(len, texts)])
    return fits[np.concatenate([s + b for s, b in zip(starts, before[:-1], strict=True)])]


def _parts(texts: list[bytes], size: int = 4 << 20) -> Iterator[list[bytes]]:
    held, total = [], 0
    for t in texts:
        held.append(t)
        total += len(t)
        if total >= size:
            yield held
            held, total = [], 0
    if held:
        yield held


def fit_text_model(labelled: DataFrame, sample: int = SAMPLE) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, their log probabilities of each trigram slot, and the least mean one that their texts should have.

    ``labelled``: doc_id, text, lang. Of each language the rows with the smallest hashes are learnt from, about ``sample``
    of them, or all if it has fewer; so a language is in the model whatever the number of rows of others.
    """
    rows = labelled.select(
        F.xxhash64("doc_id", "text").alias("order"), F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("t"), F.lower("lang").alias("l")
    ).filter("l IS NOT NULL AND l <> ''")
    used = rows.groupBy("l").count().filter(F.col("count") >= MIN_LABELLED)
    sizes = {r["l"]: r["count"] for r in used.orderBy(F.col("count").desc(), "l").limit(MAX_LANGUAGES).collect()}
    if not sizes:
        return [], np.empty((0, SLOTS)), np.empty(0)
    languages = sorted(sizes)
    number = {lang: i for i, lang in enumerate(languages)}
    # Hashes are even, so this share of their range holds about ``sample`` rows of the language.
    shares = F.create_map(*[F.lit(x) for lang in languages for x in (lang, math.ceil(HASHES * min(1.0, sample / sizes[lang])))])
    rows = rows.filter(F.pmod("order", F.lit(HASHES)) < F.element_at(shares, F.col("l")))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for text, lang in zip(batch.column("t").to_pylist(), batch.column("l").to_pylist(), strict=True):
                if lang in number:
                    seen = np.bincount(_trigrams([text.lower()])[0], minlength=SLOTS)
                    total[number[lang]] = total.get(number[lang], 0) + seen
        for lang, seen in total.items():
            at = np.flatnonzero(seen)
            columns = [pa.array(np.full(len(at), lang), pa.int32()), pa.array(at, pa.int32()), pa.array(seen[at], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["l", "slot", "n"])

    counts = np.full((len(languages), SLOTS), 0.5)
    for r in rows.mapInArrow(count, "l int, slot int, n long").groupBy("l", "slot").agg(F.sum("n").alias("n")).collect():
        counts[r["l"], r["slot"]] += r["n"]
    shared = labelled.sparkSession.sparkContext.broadcast(counts)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row's mean log probability by the other rows of its language."""
        counts = shared.value
        sums = counts.sum(axis=1)
        for batch in batches:
            out = []
            for text, lang in zip(batch.column("t").to_pylist(), batch.column("l").to_pylist(), strict=True):
                slots, at = _trigrams([text.lower()])[0], number.get(lang)
                used = slots[_in_words([text.lower()])]
                if at is not None and len(used):
                    own = np.bincount(slots, minlength=SLOTS)[used]
                    out.append((at, float(np.log((counts[at][used] - own) / (sums[at] - len(slots))).mean())))
            if out:
                columns = [pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.float64())]
                yield pa.RecordBatch.from_arrays(columns, names=["l", "fit"])

    usual = rows.mapInArrow(weigh, "l int, fit double").groupBy("l").agg(F.percentile_approx("fit", 0.5, 10_000).alias("fit")).collect()
    floors = np.full(len(languages), -math.log(SLOTS))
    for r in usual:
        floors[r["l"]] = (r["fit"] - math.log(SLOTS)) / 2
    return languages, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32), floors


def text_evidence(rows: DataFrame, model: np.ndarray, floors: np.ndarray, markup: bool) -> DataFrame:
    """``rows`` (key, t, ...) with t replaced by evidence: tempered log likelihoods, and letters; and by strange: log odds
    of no modelled language against the likeliest."""
    shared = rows.sparkSession.sparkContext.broadcast((model, floors))
    kept = [c for c in rows.columns if c != "t"]
    types = dict(rows.dtypes)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, least = shared.value
        any_of = np.logaddexp.reduce(table, axis=0) - math.log(len(table))  # a text of several languages is not strange
        for batch in batches:
            texts = [t.lower() for t in batch.column("t").to_pylist()]
            if markup:
                texts = [MARKUP.sub(b" ", t) for t in texts]
            found, letters, strange = [], [], []
            for part in _parts(texts):
                slots, n, n_letters = _trigrams(part)
                of = np.repeat(np.arange(len(part)), n)
                sums = np.column_stack([np.bincount(of, weights=row[slots], minlength=len(part)) for row in table])
                found.append(sums * (np.minimum(n, EVIDENCE) / np.maximum(n, 1))[:, None])
                letters.append(n_letters)
                best, inside = sums.argmax(axis=1), _in_words(part)
                of, slots = of[inside], slots[inside]
                n = np.bincount(of, minlength=len(part))
                fits = [np.bincount(of, weights=w, minlength=len(part)) for w in (table[best[of], slots], any_of[slots])]
                below = least[best] * n - np.maximum(*fits)
                strange.append(below * (np.minimum(n, EVIDENCE) / np.maximum(n, 1)) - STRANGE_ODDS)
            flat = np.concatenate(found) if found else np.empty((0, len(table)))
            evidence = pa.ListArray.from_arrays(np.arange(len(flat) + 1, dtype=np.int32) * len(table), pa.array(flat.reshape(-1)))
            columns = [batch.column(c) for c in kept]
            n = pa.array(np.concatenate(letters) if letters else [], pa.int64())
            odds = pa.array(np.concatenate(strange) if strange else [], pa.float64())
            yield pa.RecordBatch.from_arrays([*columns, evidence, n, odds], names=[*kept, "evidence", "n_letters", "strange"])

    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", evidence array<double>, n_letters long, strange double"
    return rows.mapInArrow(weigh, schema)


def identify(rows: DataFrame, labelled: DataFrame, markup: bool = False, sample: int = SAMPLE) -> DataFrame:
    """Per row: key, lang, posterior, text_lang (by text alone), n_letters.

    ``rows``: key, text, declared, suffix, host (each may be NULL: no evidence of that kind). ``labelled``: doc_id, text,
    lang. The language is ``und`` if the text has fewer than three letters, if no language reaches a posterior of one
    half against the others and against none of them, or if nothing is labelled; text_lang is ``und`` too where the text is
    of none, and such rows tell nothing about their hosts. Repeated rows come back each with the same answer.
    """
    languages, model, floors = fit_text_model(labelled, sample)
    n = len(languages)
    if not n:
        nothing = [F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("posterior"), F.lit(UNKNOWN).alias("text_lang")]
        return rows.select("key", *nothing, F.lit(0).cast("long").alias("n_letters"))
    names = F.array(*[F.lit(x) for x in languages])
    declared = F.lower(F.regexp_extract(F.coalesce("declared", F.lit("")), r"^\s*([A-Za-z]+)", 1))
    plain = rows.select(
        "key",
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("t"),
        F.array_position(names, declared).cast("int").alias("said"),  # 0: another language, or none
        F.when(F.coalesce("declared", F.lit("")) == "", False).otherwise(True).alias("says"),
        F.lower("suffix").alias("suffix"),
        F.lower("host").alias("host"),
        F.regexp_extract(F.lower("host"), r"([^.]+\.[^.]+)$", 1).alias("domain"),
    )
    seen = stored(text_evidence(plain, model, floors, markup), "text-evidence")
    guess = F.array_position("evidence", F.array_max("evidence")) - 1
    seen = seen.withColumn("guess", F.when((F.col("n_letters") >= MIN_LETTERS) & (F.col("strange") < 0), guess))
    sure = seen.filter("guess IS NOT NULL")

    totals = {r["guess"]: r["count"] for r in sure.groupBy("guess").count().collect()}
    size = [totals.get(i, 0) for i in range(n)]
    overall = [(s + 1) / (sum(size) + n) for s in size]
    said = {(r["said"], r["guess"]): r["count"] for r in sure.filter("says").groupBy("said", "guess").count().collect()}
    by_language = [sum(said.get((k, i), 0) for k in range(n + 1)) for i in range(n)]
    markup_shares = F.array(
        *[
            F.array(*[F.lit(math.log((said.get((k, i), 0) + 1) / (by_language[i] + n + 1))) for i in range(n)])
            for k in range(n + 1)
        ]
    )
    none = F.array(*[F.lit(0.0)] * n)
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    guesses = lambda: F.array(*[F.count_if(F.col("guess") == i).cast("double") for i in range(n)])

    suffixes = sure.filter("suffix IS NOT NULL").groupBy(F.col("suffix").alias("s_key")).agg(guesses().alias("s_n"))
    per_language = F.array(*[F.lit(float(s + 100)) for s in size])
    suffixes = suffixes.select("s_key", F.zip_with("s_n", per_language, lambda a, b: F.log((a + 1) / b)).alias("s_share"))

    def prior(counts: Column, parent: Column) -> Column:
        total = F.aggregate(counts, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(counts, parent, lambda a, p: (a + HOST_WEIGHT * p) / (total + HOST_WEIGHT))

    hosts = sure.filter("host IS NOT NULL").groupBy(F.col("host").alias("h_key"), F.col("domain").alias("h_domain")).agg(guesses().alias("h_n"))
    sums = F.array(*[F.sum(F.get("h_n", F.lit(i))) for i in range(n)])
    whole = F.array(*[F.lit(x) for x in overall])
    domains = hosts.groupBy(F.col("h_domain").alias("d_key")).agg(sums.alias("d_n")).select("d_key", prior(F.col("d_n"), whole).alias("d_prior"))
    hosts = hosts.join(domains, F.col("h_domain") == F.col("d_key"), "left")
    hosts = hosts.select("h_key", prior(F.col("h_n"), F.coalesce("d_prior", whole)).alias("h_prior"))

    joined = seen.join(suffixes, F.col("suffix") == F.col("s_key"), "left").join(hosts, F.col("host") == F.col("h_key"), "left")
    belief = F.transform(F.coalesce("h_prior", whole), lambda p: F.log(p))
    belief = add(belief, F.coalesce("s_share", none))
    belief = add(belief, F.when(F.col("says"), F.get(markup_shares, F.col("said"))).otherwise(none))
    joined = joined.withColumn("belief", add(F.col("evidence"), belief)).withColumn("top", F.array_max("belief"))
    mass = F.aggregate(F.transform("belief", lambda b: F.exp(b - F.col("top"))), F.lit(0.0), lambda s, x: s + x)
    joined = joined.withColumn("posterior", 1 / (mass + F.exp("strange")))
    clear = (F.col("n_letters") >= MIN_LETTERS) & (F.col("posterior") >= MIN_POSTERIOR)
    best = F.get(names, F.array_position("belief", F.col("top")).cast("int") - 1)
    return joined.select(
        "key",
        F.when(clear, best).otherwise(UNKNOWN).alias("lang"),
        "posterior",
        F.coalesce(F.get(names, F.col("guess").cast("int")), F.lit(UNKNOWN)).alias("text_lang"),
        "n_letters",
    )


def page_languages(pages: DataFrame, labelled: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``identify`` for web pages (page_id, url, html), which declare a language in their markup and have an address."""
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    host = F.nullif(F.regexp_extract(F.coalesce("url", F.lit("")), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@]*@)?([^/:?#]+)", 1), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("key"),
        html.alias("text"),
        F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1), F.lit("")).alias("declared"),
        F.nullif(F.regexp_extract(F.coalesce(host, F.lit("")), r"\.([^.]+)$", 1), F.lit("")).alias("suffix"),
        host.alias("host"),
    )
    return identify(rows, labelled, markup=True, sample=sample).withColumnRenamed("key", "page_id")


def document_languages(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``identify`` for documents, which have no markup or address; their source takes the place of the host.

    Column lang of a sample of the documents trains the text model; it is no evidence for the row that carries it.
    """
    none = F.lit(None).cast("string")
    source = F.col("source").cast("string") if "source" in docs.columns else none
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    key = F.struct(F.col("doc_id").cast("long").alias("d"), F.xxhash64(text).alias("rid"))
    rows = docs.select(key.alias("key"), text.alias("text"), none.alias("declared"), none.alias("suffix"), source.alias("host"))
    return identify(rows, docs, sample=sample)


def with_known_language(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` without the rows whose language comes out as ``und``; other rows and columns are unchanged."""
    unknown = document_languages(docs, sample).filter(F.col("lang") == UNKNOWN)
    unknown = unknown.select(F.col("key.d").alias("__d"), F.col("key.rid").alias("__rid"))
    rid = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(unknown["__d"]) & (rid == unknown["__rid"])
    return docs.join(unknown.hint("shuffle_hash"), same, "left_anti")
