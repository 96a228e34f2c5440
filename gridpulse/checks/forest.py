"""A small forest as a table of nodes, made by a rule, and the SQL that walks the same table."""

from __future__ import annotations

DEPTH, TREES = 3, 32


def _tree(t: int) -> list[tuple]:
    """A full tree: features take turns, thresholds lie where embeddings do, leaves differ by eighths."""
    inner, rows = (1 << DEPTH) - 1, []
    for node in range(2 * inner + 1):
        if node < inner:
            feature = (t + node) % 2
            threshold = (0.25 + (t * 7 + node * 3) % 16 / 64) * (1 if feature == 0 else -1)
            rows.append((t, node, feature, threshold, 2 * node + 1, 2 * node + 2, 0.5))
        else:
            rows.append((t, node, None, None, -1, -1, (t * 5 + node * 3) % 9 / 8))
    return rows


# tree, node, feature (0: largest, 1: smallest value), threshold, left, right, chance
NODES = [row for t in range(TREES) for row in _tree(t)]


def sql_chance(features: tuple[str, ...]) -> str:
    """The mean chance over all trees, by the same table."""
    by_place = {row[:2]: row for row in NODES}

    def walk(t: int, node: int) -> str:
        _, _, feature, threshold, left, right, chance = by_place[t, node]
        if left < 0:
            return f"{chance!r}::DOUBLE"
        return f"CASE WHEN {features[feature]} <= {threshold!r}::DOUBLE THEN {walk(t, left)} ELSE {walk(t, right)} END"

    return "(" + " + ".join(walk(t, 0) for t in range(TREES)) + f") / {TREES}"
