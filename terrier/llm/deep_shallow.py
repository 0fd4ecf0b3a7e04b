"""Deep-shallow sorting of byte strings: multikey quicksort to a shallow depth, blind tries below it.

Strings come in groups that are sorted apart. Eight bytes at a time are the key of the multikey
quicksort, in which all parts that are still equal are partitioned together by array operations. What
is equal to the shallow depth is put into a blind trie (a Patricia trie that stores only where strings
part and by which byte): a string is led down without comparing, compared once with the string found
there, and added where the two part.
"""

from __future__ import annotations

import numpy as np

WORD = 8


def quicksort(rows: np.ndarray, group: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the rows within their groups by their first ``depth`` bytes, and the parts that are equal in them.

    ``rows`` is a matrix of bytes, ``group`` the number of each row's group. Parts are numbered along the order.
    """
    order = np.argsort(group, kind="stable")
    part = group[order]
    for at in range(0, depth, WORD):
        key = np.ascontiguousarray(rows[order, at : at + WORD]).view(">u8").ravel().astype(np.uint64)
        alone = np.ones(len(order) + 1, dtype=bool)
        alone[1:-1] = part[1:] != part[:-1]
        if (alone[1:] & alone[:-1]).all():
            break  # every part is a single string
        inner = np.lexsort((key, part))
        order, key = order[inner], key[inner]
        part = np.cumsum(np.concatenate(([0], (part[1:] != part[:-1]) | (key[1:] != key[:-1]))))
    return order, part


def _shared(a: bytes, b: bytes) -> int:
    """Length of the common beginning of two different strings, neither of which need be the shorter."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


class BlindTrie:
    """Strings by the bytes at which they part; an inner node is ``(depth, {byte: node})``, a leaf ``(string, [members])``.

    The end of a string counts as a byte before all others.
    """

    def __init__(self) -> None:
        self.root: tuple | None = None

    @staticmethod
    def _byte(string: bytes, depth: int) -> int:
        return string[depth] if depth < len(string) else -1

    def add(self, string: bytes, member: int) -> None:
        node = self.root
        if node is None:
            self.root = (string, [member])
            return
        while isinstance(node[1], dict):  # blindly to a leaf
            node = node[1].get(self._byte(string, node[0])) or next(iter(node[1].values()))
        if node[0] == string:
            node[1].append(member)
            return
        depth = _shared(string, node[0])
        above, node = None, self.root
        while isinstance(node[1], dict) and node[0] < depth:
            above, node = node, node[1][self._byte(string, node[0])]
        leaf = (string, [member])
        if isinstance(node[1], dict) and node[0] == depth:
            node[1][self._byte(string, depth)] = leaf
            return
        other = node
        while isinstance(other[1], dict):
            other = next(iter(other[1].values()))
        inner = (depth, {self._byte(other[0], depth): node, self._byte(string, depth): leaf})
        if above is None:
            self.root = inner
        else:
            above[1][self._byte(string, above[0])] = inner

    def sorted(self) -> list[tuple[int, int]]:
        """``(member, length shared with the one before)`` in order; equal strings share their whole length."""
        out: list[tuple[int, int]] = []
        todo = [(self.root, 0)] if self.root is not None else []
        while todo:
            node, shared = todo.pop()
            if isinstance(node[1], dict):
                below = sorted(node[1].items(), reverse=True)
                first = len(below) - 1
                todo += [(child, shared if i == first else node[0]) for i, (_, child) in enumerate(below)]
            else:
                out.append((node[1][0], shared))
                out += [(member, len(node[0])) for member in node[1][1:]]
        return out


def sort(rows: np.ndarray, lengths: np.ndarray, group: np.ndarray, shallow: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the strings within their groups, and the bytes each shares with the one before it.

    A string is the first ``lengths`` bytes of its row, which is filled up with zeros. Strings of
    different groups share -1 bytes. A string stands before those that it begins.
    """
    shallow = min(shallow, rows.shape[1])
    order, part = quicksort(rows, group, shallow)
    n = len(order)
    shared = np.full(n, -1, dtype=np.int64)
    if not n:
        return order, shared
    differ = rows[order[1:], :shallow] != rows[order[:-1], :shallow]
    some = differ.any(axis=1)
    shared[1:] = np.where(some, differ.argmax(axis=1), shallow)
    edges = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1], [True])))
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if last - first < 2:
            continue
        members = order[first:last]
        members = members[np.argsort(lengths[members], kind="stable")]
        trie, data, width = BlindTrie(), rows[members].tobytes(), rows.shape[1]
        for i, (member, length) in enumerate(zip(members.tolist(), lengths[members].tolist())):
            trie.add(data[i * width + shallow : i * width + max(length, shallow)], member)
        inside = trie.sorted()
        order[first:last] = [member for member, _ in inside]
        shared[first + 1 : last] = [shallow + common for _, common in inside[1:]]
    shared[1:] = np.minimum(shared[1:], np.minimum(lengths[order[1:]], lengths[order[:-1]]))
    shared[1:][group[order[1:]] != group[order[:-1]]] = -1
    return order, shared
