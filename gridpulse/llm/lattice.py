"""Sum over all segmentations of a word into vocabulary pieces, in log space, many words of a length at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

START = 0x20  # stands before every word; no word holds a space
BASE = np.uint64(0x100000001B3)
MIX = np.uint64(0x9E3779B97F4A7C15)
FILTER_BITS = 22
LONGEST = 64  # longer words go one by one


class Lattice:
    """Pieces (byte strings, ``START`` first where a word begins) with natural-log probabilities."""

    def __init__(self, pieces: list[bytes], log_p: np.ndarray):
        self.pieces, self.log_p = pieces, log_p
        self.max_len = max(map(len, pieces))
        hashes = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        self.order = np.argsort(hashes)
        self.keys = hashes[self.order]
        self.known = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.known[self._slot(hashes)] = True
        self.ids = {p: i for i, p in enumerate(pieces)}

    @staticmethod
    def _hash(piece: bytes) -> int:
        h = 0
        for c in piece:
            h = (h * int(BASE) + c + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    @staticmethod
    def _slot(hashes: np.ndarray) -> np.ndarray:
        return (hashes * MIX) >> np.uint64(64 - FILTER_BITS)

    def _arcs(self, letters: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """(start, end, rows, pieces) for every piece found, by start; ``letters``: one row a position."""
        n, m = letters.shape
        for i in range(n):
            h = np.zeros(m, dtype=np.uint64)
            for j in range(i, min(n, i + self.max_len)):
                h = h * BASE + letters[j]
                rows = np.flatnonzero(self.known[self._slot(h)])
                if rows.size:
                    at = np.minimum(np.searchsorted(self.keys, h[rows]), len(self.keys) - 1)
                    found = self.keys[at] == h[rows]
                    if found.any():
                        yield i, j + 1, rows[found], self.order[at[found]]

    def _forward(self, arcs: list, n: int, m: int) -> np.ndarray:
        alpha = np.full((n + 1, m), -np.inf)
        alpha[0] = 0.0
        for i, j, rows, ids in arcs:
            alpha[j, rows] = np.logaddexp(alpha[j, rows], alpha[i, rows] + self.log_p[ids])
        return alpha

    def _groups(self, words: list[bytes]) -> Iterator[tuple[np.ndarray, list, int]]:
        """(positions in ``words``, arcs, length) for words of one length."""
        lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
        for n in np.unique(lengths):
            at = np.flatnonzero(lengths == n)
            for part in np.array_split(at, max(1, len(at) * (int(n) + 1) // 2_000_000)) if n <= LONGEST else at[:, None]:
                flat = np.frombuffer(b"".join(words[k] for k in part), dtype=np.uint8).reshape(len(part), n)
                letters = np.empty((n + 1, len(part)), dtype=np.uint64)
                letters[0], letters[1:] = START + 1, flat.T.astype(np.uint64) + np.uint64(1)
                if n <= LONGEST:
                    yield part, list(self._arcs(letters)), n + 1
                else:
                    yield part, self._arcs_of_one(words[part[0]]), n + 1

    def _arcs_of_one(self, word: bytes) -> list:
        text, arcs, zero = bytes([START]) + word, [], np.zeros(1, dtype=np.int64)
        for i in range(len(text)):
            for j in range(i + 1, min(len(text), i + self.max_len) + 1):
                k = self.ids.get(text[i:j])
                if k is not None:
                    arcs.append((i, j, zero, np.array([k])))
        return arcs

    def log_likelihood(self, words: list[bytes]) -> np.ndarray:
        """Natural log of each word's marginal probability."""
        out = np.empty(len(words))
        for part, arcs, n in self._groups(words):
            out[part] = self._forward(arcs, n, len(part))[n]
        return out

    def expected_counts(self, words: list[bytes], counts: np.ndarray) -> np.ndarray:
        """How often each piece is expected in ``words``, a word ``counts`` times."""
        total = np.zeros(len(self.pieces))
        for part, arcs, n in self._groups(words):
            alpha = self._forward(arcs, n, len(part))
            beta = np.full((n + 1, len(part)), -np.inf)
            beta[n] = 0.0
            for i, j, rows, ids in reversed(arcs):
                through = self.log_p[ids] + beta[j, rows]
                share = np.exp(alpha[i, rows] + through - alpha[n, rows]) * counts[part[rows]]
                total += np.bincount(ids, weights=share, minlength=len(total))
                beta[i, rows] = np.logaddexp(beta[i, rows], through)
        return total
