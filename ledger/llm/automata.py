"""Weighted acyclic automata: count transducers over sequences of labels.

An arc has a label, a count and a target; the count is that of the sequence that ends with
the arc, 0 where none ends there.  States with equal arcs are one state, so sequences share
their beginnings and, where the counts agree, their endings.  State 0 has no arcs.

Sequences come as rows of label numbers, padded by -1, in sorted order: all arcs of a depth
are worked on together, from the longest sequences to the root.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Sequence

import numpy as np

Rows = np.ndarray  # n x depth label numbers (32 bits), -1 behind the end


def in_order(rows: Rows) -> np.ndarray:
    """Places of the rows in sorted order."""
    wide = rows.astype(np.uint64) + np.uint64(1)
    if rows.size and rows.shape[1] <= 6 and int(rows.max()) < (1 << 21) - 1:
        packed = [np.zeros(len(rows), np.uint64), np.zeros(len(rows), np.uint64)]
        for k in range(6):
            packed[k // 3] = packed[k // 3] << np.uint64(21) | (wide[:, k] if k < rows.shape[1] else np.uint64(0))
        return np.lexsort((packed[1], packed[0]))
    return np.lexsort(wide.T[::-1])


def summed(rows: Rows, counts: np.ndarray) -> tuple[Rows, np.ndarray]:
    """The distinct rows in order, with the sums of their counts."""
    if not len(rows):
        return rows, counts
    order = in_order(rows)
    rows, counts = rows[order], counts[order]
    new = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[new], np.add.reduceat(counts, new)


def padded(rows: Rows, depth: int) -> Rows:
    return rows if rows.shape[1] == depth else np.hstack([rows, np.full((len(rows), depth - rows.shape[1]), -1, np.int32)])


class Automaton:
    def __init__(self, labels: list[str], root: int, first: np.ndarray, label: np.ndarray, count: np.ndarray, target: np.ndarray):
        self.labels, self.root, self.first, self.label, self.count, self.target = labels, root, first, label, count, target

    @classmethod
    def of_sorted(cls, labels: list[str], rows: Rows, counts: np.ndarray) -> Automaton:
        """Built from sorted distinct rows.  ``labels`` are sorted too; those not used go."""
        used = np.unique(rows[rows >= 0]) if rows.size else np.zeros(0, np.int32)
        labels = [labels[k] for k in used.tolist()]
        rows = np.where(rows >= 0, np.searchsorted(used, rows), -1).astype(np.int32)
        # Arcs of a depth: where the first so many labels differ from those of the row before.
        arcs, sizes = [], (rows >= 0).sum(axis=1)
        for k in range(1, rows.shape[1] + 1):
            have = np.flatnonzero(sizes >= k)
            if not len(have):
                break
            head = rows[have, :k]
            at = have[np.append(True, (head[1:] != head[:-1]).any(axis=1))]
            arcs.append((at, rows[at, k - 1], np.where(sizes[at] == k, counts[at], 0)))
        register: dict[bytes, int] = {b"": 0}
        finished: list[bytes] = [b""]
        target, root = np.zeros(len(arcs[-1][0]), np.int64) if arcs else None, 0
        for k in range(len(arcs) - 1, -1, -1):
            at, label, count = arcs[k]
            packed = np.stack([label.astype(np.int64), count.astype(np.int64), target], axis=1).tobytes()
            # Arcs of one state stand side by side: they have the same arc before them.
            above = np.searchsorted(arcs[k - 1][0], at, "right") - 1 if k else np.zeros(len(at), np.int64)
            begin = np.flatnonzero(np.append(True, above[1:] != above[:-1]))
            bounds = np.append(begin, len(at)) * 24
            states = []
            for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                state = packed[a:b]
                number = register.get(state)
                if number is None:
                    number = register[state] = len(finished)
                    finished.append(state)
                states.append(number)
            if k:
                target = np.zeros(len(arcs[k - 1][0]), np.int64)
                target[above[begin]] = states
            else:
                root = states[0]
        table = np.frombuffer(b"".join(finished), np.int64).reshape(-1, 3)
        first = np.cumsum([0, *(len(s) // 24 for s in finished)])
        return cls(labels, root, first, table[:, 0].astype(np.int32), table[:, 1].copy(), table[:, 2].astype(np.int32))

    def rows(self) -> tuple[Rows, np.ndarray]:
        """All sequences in sorted order, with their counts."""
        states, heads, found = np.array([self.root]), np.zeros((1, 0), np.int32), []
        while len(states):
            size = self.first[states + 1] - self.first[states]
            own = np.repeat(np.arange(len(states)), size)
            arc = np.arange(len(own)) - np.repeat(np.cumsum(size) - size, size) + self.first[states[own]]
            heads = np.hstack([heads[own], self.label[arc, None]])
            ends = self.count[arc] > 0
            found.append((heads[ends], self.count[arc][ends]))
            on = self.target[arc] > 0
            states, heads = self.target[arc][on], heads[on]
        depth = max(len(found), 1)
        rows, counts = np.vstack([padded(r, depth) for r, _ in found]), np.concatenate([c for _, c in found])
        order = in_order(rows)
        return rows[order], counts[order]

    def items(self) -> Iterator[tuple[tuple[str, ...], int]]:
        rows, counts = self.rows()
        for row, c in zip(rows.tolist(), counts.tolist()):
            yield tuple(self.labels[k] for k in row if k >= 0), c

    @classmethod
    def union(cls, parts: Sequence[Automaton], least: int = 0) -> Automaton:
        """The sum of several automata; sequences of two labels or more whose sum is below
        ``least`` go."""
        labels = sorted(set().union(*(p.labels for p in parts)))
        place = {label: k for k, label in enumerate(labels)}
        read = [p.rows() for p in parts]
        depth = max((r.shape[1] for r, _ in read), default=1)
        moved = []
        for p, (r, _) in zip(parts, read):
            number = np.array([*(place[label] for label in p.labels), -1], np.int32)
            moved.append(padded(number[r], depth))
        rows, counts = summed(np.vstack(moved), np.concatenate([c for _, c in read])) if read else (np.zeros((0, 1), np.int32), np.zeros(0, np.int64))
        kept = counts >= least
        kept |= (rows >= 0).sum(axis=1) < 2
        return cls.of_sorted(labels, rows[kept], counts[kept])

    def look_up(self, labels: Sequence[str], rows: Rows) -> np.ndarray:
        """Counts of the sequences, 0 where there are none: all walk on together, label by label."""
        place = {label: k for k, label in enumerate(self.labels)}
        number = np.array([*(place.get(label, -2) for label in labels), -1])
        rows = number[rows]
        width = len(self.labels) + 1
        arcs = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)) * width + self.label
        state, out = np.full(len(rows), self.root, np.int64), np.zeros(len(rows), np.int64)
        walking = np.arange(len(rows))
        for k in range(rows.shape[1]):
            label = rows[walking, k]
            walking, label = walking[label >= 0], label[label >= 0]
            key = state[walking] * width + label
            arc = np.searchsorted(arcs, key)
            hit = arc < len(arcs)
            hit[hit] = arcs[arc[hit]] == key[hit]
            out[rows[:, k] != -1] = 0
            walking, arc = walking[hit], arc[hit]
            out[walking], state[walking] = self.count[arc], self.target[arc]
        return out

    def compose(self, asked: Automaton) -> Automaton:
        """The sequences of ``asked`` that this automaton counts, with its counts."""
        rows, _ = asked.rows()
        counts = self.look_up(asked.labels, rows)
        return Automaton.of_sorted(asked.labels, rows[counts > 0], counts[counts > 0])

    def dumps(self) -> bytes:
        return pickle.dumps((self.labels, self.root, *(x.tobytes() for x in (self.first.astype(np.int64), self.label, self.count, self.target))), 5)

    @classmethod
    def loads(cls, data: bytes) -> Automaton:
        labels, root, first, label, count, target = pickle.loads(data)
        return cls(labels, root, np.frombuffer(first, np.int64), np.frombuffer(label, np.int32), np.frombuffer(count, np.int64), np.frombuffer(target, np.int32))
