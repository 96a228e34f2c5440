"""Prefix-free parsing of bytes: triggers, and the phrases between them with the context that a match needs.

A trigger is a string of ``TRIGGER`` bytes whose rolling hash is the smallest among the ``MATCH - TRIGGER + 1`` strings
of some window of ``MATCH`` bytes (the leftmost, if several are smallest). So every window of ``MATCH`` bytes belongs to
exactly one trigger in it, equal windows to equal triggers at the same place, and the windows of one trigger follow each
other. A phrase is what those windows cover: it starts where the first of them starts and ends where the last one ends.
Neighbouring phrases overlap, no phrase is a prefix of another's continuation, and every window lies in one phrase.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

MATCH, TRIGGER = 50, 24
SPAN = MATCH - TRIGGER + 1  # triggers a window could belong to
SIDE = (MATCH - TRIGGER) // 2
SEGMENT = 1 << 20  # a longer text is parsed in pieces that overlap by MATCH - 1 bytes
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX = np.uint64(0xD6E8FEB86659FD93)


def rolling_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the ``TRIGGER`` bytes and of the 8 bytes at every position; ``data``: bytes."""
    powers = {1: BASE}
    for n in (2, 4, 8):
        with np.errstate(over="ignore"):
            powers[n] = powers[n // 2] * powers[n // 2]
    h = data.astype(np.uint64) + np.uint64(1)
    parts, n = {}, 1
    while n < 16:
        h = h[:-n] * powers[n] + h[n:]
        n *= 2
        parts[n] = h
    with np.errstate(over="ignore"):
        h = h[:-8] * powers[8] + parts[8][16:]  # 16 bytes and 8 more
    h ^= h >> np.uint64(32)
    h *= MIX
    h ^= h >> np.uint64(29)
    return h, parts[8]


def triggers_of_windows(hashes: np.ndarray) -> np.ndarray:
    """For the window at each position, where its trigger starts."""
    low, at, n = hashes, np.arange(len(hashes), dtype=np.int32), 1
    while n < SPAN:
        step = min(n, SPAN - n)
        right = low[step:] < low[:-step]
        low = np.where(right, low[step:], low[:-step])
        at = np.where(right, at[step:], at[:-step])
        n += step
    return at


def segments(texts: list[bytes]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts joined up to about ``SEGMENT`` bytes: (bytes, text numbers, offsets in the text, starts in the bytes)."""
    held: list[tuple[int, int, bytes]] = []
    size = 0

    def joined() -> tuple:
        lengths = np.array([len(b) for _, _, b in held])
        starts = np.concatenate([[0], np.cumsum(lengths)])
        return b"".join(b for _, _, b in held), np.array([i for i, _, _ in held]), np.array([o for _, o, _ in held]), starts

    for i, text in enumerate(texts):
        for offset in range(0, max(1, len(text) - MATCH + 1), SEGMENT):
            piece = text[offset : offset + SEGMENT + MATCH - 1]
            if len(piece) >= MATCH:
                held.append((i, offset, piece))
                size += len(piece)
                if size >= SEGMENT:
                    yield joined()
                    held, size = [], 0
    if held:
        yield joined()


def _side(eights: np.ndarray, start: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """A byte hashed from the ``SIDE`` bytes at ``start``, 0 where they aren't there."""
    at = np.where(ok, start, 0)
    mixed = (eights[at] * BASE + eights[at + SIDE - 8]) * MIX
    return np.where(ok, mixed >> np.uint64(56), 0).astype(np.uint8)


def phrases(texts: list[bytes]) -> Iterator[dict[str, np.ndarray]]:
    """Arrays ``text`` (number), ``first`` and ``last`` (window starts in the text), ``hash`` (of the trigger), in order,
    and ``left`` and ``right``, a byte hashed from the ``SIDE`` bytes on either side of the trigger.

    A window has ``SIDE`` bytes or more on one side of its trigger, so equal windows agree in ``left`` or ``right``.
    """
    for data, numbers, offsets, starts in segments(texts):
        buffer = np.frombuffer(data, dtype=np.uint8)
        hashes, eights = rolling_hashes(buffer)
        at = triggers_of_windows(hashes)  # one for each window of the joined bytes
        piece = np.repeat(np.arange(len(numbers), dtype=np.int32), np.diff(starts))[: len(at)]
        inside = np.arange(len(at)) + MATCH <= starts[1:][piece]
        windows = np.flatnonzero(inside)
        at = at[windows]
        change = np.flatnonzero(np.concatenate([[True], (np.diff(at) != 0) | (np.diff(piece[windows]) != 0)]))
        first, last = windows[change], windows[np.concatenate([change[1:], [len(windows)]]) - 1]
        of = piece[first]
        shift = offsets[of] - starts[of]
        trigger = at[change].astype(np.int64)
        before, after = trigger - SIDE, trigger + TRIGGER
        yield {
            "text": numbers[of],
            "first": first + shift,
            "last": last + shift,
            "hash": hashes[trigger],
            "left": _side(eights, before, before >= starts[of]),
            "right": _side(eights, after, after + SIDE <= starts[1:][of]),
        }
