"""Long repeated byte strings removed across documents, by prefix-free parsing.

Each document is parsed into phrases (see ``phrases``), so that every 50-byte string lies in one phrase and equal strings
lie at the same place of phrases around equal triggers. Three passes find what repeats:

1. Trigger hashes with document and place are dealt by hash, packed by thousands. Only triggers that two documents hold
   with the same bytes on one side come back, a small share of all unless the corpus repeats itself.
2. The phrases around those triggers form the dictionary. Each task keeps distinct phrases with their first document, so
   a passage that a third of all documents hold crosses the shuffle once a task. Dealt by trigger, equal phrases of later
   documents are settled at once; where a trigger has several phrases, the suffixes of these dictionary entries are sorted
   to ``MATCH`` bytes. Strings of this suffix array that are equal are neighbours, and each has its first document.
3. The parse, that is the documents' phrases in order, takes the decisions and joins removed strings into runs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import shuffle_partitions, stored, texts
from gridpulse.llm.phrases import MATCH, MIX, TRIGGER, phrases, rolling_hashes

NO_ID = np.iinfo(np.int64).max  # a NULL doc_id ranks after every number
PACKET = "bucket int, n int, keyed boolean, data binary"
PACKET_SCHEMA = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("keyed", pa.bool_()), ("data", pa.binary())])
PLACES = "d long, o long, first int, last int"
PLACE = ("<i8", "<i8", "<i4", "u1")  # document, row of it, first window, windows after it
PHRASE_BYTES = 2 * MATCH  # more than any phrase has
LEAD = 128  # added to the length of a place that only tells its trigger is shared
FLUSH = 100_000  # phrases a task holds before it sends them on
WINDOWS_OF = 4_000  # dictionary entries whose suffixes are sorted together, more where one trigger has more
BUCKET_PHRASES = 50_000  # places of shared phrases a bucket has on average, at most
KEY_BITS = 44  # of a trigger's spread hash, which tell as much as 48 of the small ones; more triggers that seem shared cost time, not exactness


def _packed(arrays: list[np.ndarray], letters: bytes = b"") -> bytes:
    """Arrays compressed with their bytes by significance: all lowest ones, then all second ones and so on. ``letters``
    follow compressed on their own: text and numbers need other codes."""
    planes = [np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T).tobytes() for x in arrays]
    numbers = zstandard.ZstdCompressor(level=1).compress(b"".join(planes))
    return numbers + zstandard.ZstdCompressor(level=3).compress(letters) if letters else numbers


def _unpacked(data: bytes, n: int, dtypes: tuple[str, ...]) -> tuple[list[np.ndarray], bytes]:
    """The arrays of ``n`` values each, and the letters that follow them."""
    expand, at, out = zstandard.ZstdDecompressor().decompressobj(), 0, []
    raw = expand.decompress(data)
    for t in dtypes:
        size = n * np.dtype(t).itemsize
        planes = np.frombuffer(raw[at : at + size], dtype=np.uint8).reshape(-1, n)
        out.append(np.ascontiguousarray(planes.T).view(t).reshape(n))
        at += size
    return out, zstandard.ZstdDecompressor().decompress(expand.unused_data) if expand.unused_data else b""


def _packets(rows: list[tuple[int, int, bool, bytes]]) -> pa.RecordBatch:
    columns = [pa.array(list(c), t.type) for c, t in zip(zip(*rows, strict=True), PACKET_SCHEMA, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=PACKET_SCHEMA)


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches a few rows at a time, so that no task holds many texts unpacked."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _answers(bucket: int, buckets: int, place: list[np.ndarray]) -> list[tuple[int, int, bool, bytes]]:
    """Places already decided, as packets that only pass through; dealt over the buckets from ``bucket`` on, so that a task
    that goes on where it stopped gives all buckets alike."""
    cuts = range(0, len(place[0]), 4096)
    parts = [[x[a : a + 4096] for x in place] for a in cuts]
    return [((bucket + i) % buckets, len(p[0]), False, _packed(p)) for i, p in enumerate(parts)]


def _places(d: np.ndarray, o: np.ndarray, first: np.ndarray, last: np.ndarray) -> pa.RecordBatch:
    columns = [pa.array(x.astype(np.int64)) for x in (d, o)] + [pa.array(x.astype(np.int32)) for x in (first, last)]
    return pa.RecordBatch.from_arrays(columns, names=["d", "o", "first", "last"])


def _breaks(group: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1]])) if len(group) else np.empty(0, dtype=np.int64)


def _several(group: np.ndarray, d: np.ndarray, led: np.ndarray | None = None) -> np.ndarray:
    """Whether each row's group holds more than one document, or a row that is ``led``."""
    order = np.argsort(group, kind="stable")
    starts, ranked = _breaks(group[order]), d[order]
    many = np.minimum.reduceat(ranked, starts) != np.maximum.reduceat(ranked, starts)
    if led is not None:
        many |= np.logical_or.reduceat(led[order], starts)
    out = np.empty(len(group), dtype=bool)
    out[order] = np.repeat(many, np.diff(np.append(starts, len(group))))
    return out


def _shared(key: np.ndarray, left: np.ndarray, right: np.ndarray, d: np.ndarray, led: np.ndarray | None = None) -> np.ndarray:
    """Whether a trigger occurs in several documents with the same bytes on its left, or on its right."""
    sides = [(key << np.uint64(8)) | side for side in (left, right)]
    return _several(sides[0], d, led) | _several(sides[1], d, led)


def _spread(hashes: np.ndarray) -> np.ndarray:
    """Trigger hashes one to one on numbers that are even over all 64 bits: as smallest of their windows, triggers have
    small hashes, which would give the first buckets many times the phrases of the others."""
    return hashes * MIX


def shared_triggers(docs: DataFrame, buckets: int) -> DataFrame:
    """Places (d, o, first, last) of the phrases that can hold a string of another document."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = TaskContext.get().partitionId()
        for batch in _slices(batches, 2_000):
            ids, rows = batch.column("d").to_numpy(), batch.column("o").to_numpy()
            for found in phrases(batch.column("t").to_pylist()):
                key = _spread(found["hash"]) >> np.uint64(64 - KEY_BITS)
                order = np.argsort(key, kind="stable")
                key, left, right, first = (x[order] for x in (key, found["left"], found["right"], found["first"].astype(np.int32)))
                length = (found["last"] - found["first"])[order].astype(np.uint8)
                d, o = ids[found["text"][order]], rows[found["text"][order]]
                many = _shared(key, left, right, d)
                # Of phrases known to be shared one tells the others, for each trigger with its sides; none needs an answer.
                sides = (key << np.uint64(16)) | (left.astype(np.uint64) << np.uint64(8)) | right
                lead = np.zeros(len(key), dtype=bool)
                known = np.flatnonzero(many)
                lead[known[np.unique(sides[known], return_index=True)[1]]] = True
                go = np.flatnonzero(~many | lead)
                bucket = (key[go] * np.uint64(buckets) >> np.uint64(KEY_BITS)).astype(np.int64)
                starts, out = _breaks(bucket), []
                marked = np.where(lead, length + LEAD, length).astype(np.uint8)
                for a, b in zip(starts, [*starts[1:], len(go)], strict=True):
                    at = go[a:b]
                    step = np.diff(key[at], prepend=np.uint64(0))  # ascending, so steps are short numbers
                    sent = [step, left[at], right[at], d[at], o[at], first[at], marked[at]]
                    out.append((int(bucket[a]), len(at), True, _packed(sent)))
                answers = _answers(dealt, buckets, [x[many] for x in (d, o, first, length)])
                dealt += len(answers)
                yield _packets(out + answers)

    def meet(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        for batch in _slices(batches, 1):
            for r in batch.to_pylist():
                arrays, _ = _unpacked(r["data"], r["n"], (("<u8", "u1", "u1", *PLACE) if r["keyed"] else PLACE))
                if r["keyed"]:
                    arrays[0] = np.cumsum(arrays[0])
                    held.append(arrays)
                else:
                    d, o, first, length = arrays
                    yield _places(d, o, first, first + length)
        if not held:
            return
        key, left, right, d, o, first, length = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        lead = length >= LEAD
        at = np.flatnonzero(_shared(key, left, right, d, lead) & ~lead)
        yield _places(d[at], o[at], first[at], first[at] + length[at])

    return docs.mapInArrow(pack, PACKET).groupBy("bucket").applyInArrow(meet, PLACES)


def _runs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Window starts [first, last] joined where they touch; sorted by first."""
    if not len(first):
        return first, last
    order = np.argsort(first, kind="stable")
    first, last = first[order], np.maximum.accumulate(last[order])
    new = np.concatenate([[True], first[1:] > last[:-1] + 1])
    return first[new], last[np.append(np.flatnonzero(new)[1:] - 1, len(last) - 1)]


def _ends(places: pa.ListScalar) -> tuple[np.ndarray, np.ndarray]:
    """First and last windows of the places of a document, as ``_joined`` gives them."""
    both = places.values.to_numpy()
    return both >> 32, both & 0xFFFFFFFF


def _phrase_rows(text: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bytes of each phrase, filled up with zeros."""
    grid = np.arange(PHRASE_BYTES)
    at = np.minimum(first[:, None] + grid, len(text) - 1)
    return np.where(grid < length[:, None], text[at], 0).astype(np.uint8)


def _whole(rows: np.ndarray) -> np.ndarray:
    rows = np.ascontiguousarray(rows)
    return rows.view(np.dtype((np.void, rows.shape[1]))).reshape(len(rows))


def _least(rows: np.ndarray, length: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the distinct phrases: the first document and a row of each; of the rows: their phrase's number."""
    _, entry, of = np.unique(_whole(np.hstack([rows, length.astype(np.uint8)[:, None]])), return_index=True, return_inverse=True)
    least = np.full(len(entry), NO_ID)
    np.minimum.at(least, of, d)
    return least, entry, of


def _first_windows(rows: np.ndarray, length: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, window) of every window of dictionary entries that an entry of a smaller document holds too.

    The suffixes long enough are sorted to ``MATCH`` bytes; in that order equal windows stand together.
    """
    n_windows = length - MATCH + 1
    row = np.repeat(np.arange(len(rows)), n_windows)
    window = np.arange(len(row)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows)
    views = np.lib.stride_tricks.sliding_window_view(rows, MATCH, axis=1)
    suffixes = _whole(views[row, window])
    order = np.argsort(suffixes)
    ranked = suffixes[order]
    starts = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
    least = np.minimum.reduceat(d[row[order]], starts)
    later = d[row[order]] > np.repeat(least, np.diff(np.append(starts, len(order))))
    hit = order[later]
    return row[hit], window[hit]


def removals(docs: DataFrame, buckets: int) -> DataFrame:
    """Window starts [first, last] to remove, as places (d, o, first, last).

    ``docs``: d, o, z (compressed text) and ``places``, those of its phrases that can be shared.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand, dealt = zstandard.ZstdDecompressor(), TaskContext.get().partitionId()
        for batch in batches:
            ids, numbers = batch.column("d").to_numpy(), batch.column("o").to_numpy()
            column, places, held, size = batch.column("z"), batch.column("places"), [], 0
            for i in range(batch.num_rows):
                text = np.frombuffer(expand.decompress(column[i].as_py()), dtype=np.uint8)
                first, last = _ends(places[i])
                length = last - first + MATCH
                for a in range(0, len(first), 20_000):
                    part = slice(a, a + 20_000)
                    n = len(first[part])
                    rows = _phrase_rows(text, first[part], length[part])
                    held.append((np.full(n, ids[i]), np.full(n, numbers[i]), first[part], length[part], rows))
                    size += n
                    if size >= FLUSH:
                        sent, answers = packets(held, dealt)
                        dealt += answers
                        yield sent
                        held, size = [], 0
            if held:
                sent, answers = packets(held, dealt)
                dealt += answers
                yield sent

    def packets(held: list, dealt: int) -> tuple[pa.RecordBatch, int]:
        """The phrases as packets, and how many of these are answers, dealt from ``dealt`` on."""
        d, o, first, length, rows = (np.concatenate(x) for x in zip(*held, strict=True))
        least, _, of = _least(rows, length, d)
        go = np.flatnonzero(d == least[of])  # of each phrase here, the places in its first document
        code = _trigger_codes(rows[go])
        order = np.argsort(code)
        go, code = go[order], code[order]
        bucket = ((code >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        starts, out = _breaks(bucket), []
        for a, b in zip(starts, [*starts[1:], len(go)], strict=True):
            at = go[a:b]
            sent = [np.diff(code[a:b], prepend=np.uint64(0)), d[at], o[at], first[at].astype(np.int32), length[at].astype(np.uint8)]
            letters = rows[at][np.arange(PHRASE_BYTES) < length[at][:, None]].tobytes()
            out.append((int(bucket[a]), len(at), True, _packed(sent, letters)))
        later = d > least[of]
        windows = (length - MATCH).astype(np.uint8)
        answers = _answers(dealt, buckets, [x[later] for x in (d, o, first.astype(np.int32), windows)])
        return _packets(out + answers), len(answers)

    def settle(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in _slices(batches, 1):
            for r in batch.to_pylist():
                arrays, letters = _unpacked(r["data"], r["n"], (("<u8", *PLACE) if r["keyed"] else PLACE))
                if r["keyed"]:
                    code, d, o, first, length = arrays
                    rows = np.zeros((r["n"], PHRASE_BYTES), dtype=np.uint8)
                    rows[np.arange(PHRASE_BYTES) < length[:, None]] = np.frombuffer(letters, dtype=np.uint8)
                    held.append((np.cumsum(code), d, o, first, length.astype(np.int64), rows))
                else:
                    d, o, first, windows = arrays
                    yield _places(d, o, first, first + windows)
        if not held:
            return
        code, d, o, first, length, rows = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        at = np.flatnonzero(_several(code, d))  # a trigger that turned out to be of one document has nothing to remove
        if not len(at):
            return
        code, d, o, first, length, rows = (x[at] for x in (code, d, o, first, length, rows))
        least, entry, of = _least(rows, length, d)
        later = d > least[of]
        yield _places(d[later], o[later], first[later], (first + length - MATCH)[later])
        # Distinct phrases of triggers that have several, in chunks that keep a trigger whole.
        codes = code[entry]
        by = np.argsort(codes, kind="stable")
        starts = np.flatnonzero(np.concatenate([[True], codes[by][1:] != codes[by][:-1]]))
        sizes = np.diff(np.append(starts, len(by)))
        open_ = by[np.repeat(sizes > 1, sizes)]
        ends = np.flatnonzero(np.concatenate([codes[open_][1:] != codes[open_][:-1], [True]])) + 1 if len(open_) else []
        members = np.argsort(of, kind="stable")
        bounds = np.searchsorted(of[members], np.arange(len(entry) + 1))
        a = 0
        while a < len(open_):
            b = int(ends[min(np.searchsorted(ends, a + WINDOWS_OF), len(ends) - 1)])
            part = open_[a:b]
            row, window = _first_windows(rows[entry[part]], length[entry[part]], least[part])
            # To every place of the phrase in its first document.
            e = part[row]
            n_holders = bounds[e + 1] - bounds[e]
            window = np.repeat(window, n_holders)
            ahead = np.arange(n_holders.sum()) - np.repeat(np.cumsum(n_holders) - n_holders, n_holders)
            holder = members[np.repeat(bounds[e], n_holders) + ahead]
            keep = d[holder] == least[of[holder]]
            holder, window = holder[keep], window[keep]
            order = np.lexsort((window, holder))
            holder, window = holder[order], window[order]
            if len(holder):
                new = np.concatenate([[True], (holder[1:] != holder[:-1]) | (window[1:] != window[:-1] + 1)])
                ends_at = np.append(np.flatnonzero(new)[1:] - 1, len(holder) - 1)
                h = holder[new]
                yield _places(d[h], o[h], first[h] + window[new], first[h] + window[ends_at])
            a = b

    return docs.mapInArrow(pack, PACKET).groupBy("bucket").applyInArrow(settle, PLACES)


def _trigger_codes(rows: np.ndarray) -> np.ndarray:
    """A number for the trigger of each phrase: its first window's smallest rolling hash, spread."""
    out = np.empty(len(rows), dtype=np.uint64)
    for a in range(0, len(rows), 10_000):
        part = rows[a : a + 10_000]
        h, _ = rolling_hashes(part.reshape(-1))
        h = np.append(h, np.zeros(TRIGGER - 1, dtype=np.uint64)).reshape(len(part), -1)
        out[a : a + 10_000] = h[:, : MATCH - TRIGGER + 1].min(axis=1)
    return _spread(out)


def _joined(docs: DataFrame, places: DataFrame, how: str) -> DataFrame:
    # Both ends in one number: a struct in an array takes four times the room.
    both = F.shiftleft(F.col("first").cast("long"), 32) + F.col("last")
    found = places.groupBy("d", "o").agg(F.collect_list(both).alias("places"))
    found = found.select(F.col("d").alias("pd"), F.col("o").alias("po"), "places").hint("shuffle_hash")
    return docs.join(found, (F.col("d") == F.col("pd")) & (F.col("o") == F.col("po")), how).drop("pd", "po")


def _compressed(rows: DataFrame) -> DataFrame:
    """(d, o, z): texts compressed for their one way over the network, dealt by document."""

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3)
        for batch in _slices(batches):
            z = pa.array([press.compress(t) for t in batch.column("t").to_pylist()], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("o"), z], names=["d", "o", "z"])

    squeezed = rows.mapInArrow(squeeze, "d long, o long, z binary")
    return squeezed.repartition(shuffle_partitions(rows.sparkSession), "d", "o")


def without_repeats(docs: DataFrame) -> DataFrame:
    """Per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes).

    Every byte goes that lies in a 50-byte string which also starts in a document with a smaller doc_id. Strings are
    judged on the input, and matches never cross documents. NULL texts are empty, shorter texts stay whole. A NULL
    doc_id ranks after every number; all rows with one doc_id are one document, so repeated rows come back alike.
    """
    buckets = 4 * shuffle_partitions(docs.sparkSession)
    every = texts(docs).withColumn("d", F.coalesce("d", F.lit(NO_ID)))
    repeated = bool(every.groupBy("d").count().filter("count > 1").head(1))
    # Where ids repeat, their rows are told apart by the text's fingerprint, and equal rows are worked on once.
    rows = every.dropDuplicates(["d", "rid"]) if repeated else every
    rows = rows.select("d", (F.col("rid") if repeated else F.lit(0).cast("long")).alias("o"), F.col("t").cast("binary").alias("t"))
    shared = stored(shared_triggers(rows, buckets), "shared-triggers")
    dealt = _compressed(rows)
    gone = removals(_joined(dealt, shared, "inner"), max(buckets, shared.count() // BUCKET_PHRASES))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for batch in _slices(batches):
            out: list[list] = [[], [], [], [], []]
            for i in range(batch.num_rows):
                text, places = expand.decompress(batch.column("z")[i].as_py()), batch.column("places")[i]
                kept, removed, spans = text, 0, 0
                if places.is_valid:
                    first, last = _ends(places)
                    # Strings that touch or overlap remove one run of bytes.
                    start, end = _runs(first, last + MATCH - 1)
                    bounds = [0, *np.column_stack([start, end + 1]).reshape(-1).tolist(), len(text)]
                    kept = b"".join(text[a:b] for a, b in zip(bounds[::2], bounds[1::2], strict=True))
                    removed, spans = len(text) - len(kept), len(start)
                values = (len(text), removed, spans, hashlib.sha256(kept).hexdigest(), kept)
                for column, x in zip(out, values, strict=True):
                    column.append(x)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            columns = [pa.array(x, t) for x, t in zip(out, types, strict=True)]
            names = ["d", "o", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
            yield pa.RecordBatch.from_arrays([batch.column("d"), batch.column("o"), *columns], names=names)

    schema = "d long, o long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    done = _joined(dealt, gone, "left").select("d", "o", "z", "places").mapInArrow(cut, schema)
    if repeated:
        keys = every.select(F.col("d").alias("ed"), F.col("rid").alias("eo"))
        done = keys.join(done, (F.col("ed") == F.col("d")) & (F.col("eo") == F.col("o"))).drop("ed", "eo")
    return done.select(F.nullif("d", F.lit(NO_ID)).alias("doc_id"), *[c for c in done.columns if c not in ("d", "o")])
