"""Compressed (radix) tries over byte strings.

An edge carries a whole byte run, so texts that share a beginning share its
bytes; a terminal holds the least id inserted with its text and the rows that
came with it.
"""

from __future__ import annotations

from collections.abc import Iterator


def common(a: bytes, b: bytes, at: int = 0) -> int:
    """Length of the common beginning of ``a`` and ``b[at:]``."""
    if b.startswith(a, at):
        return len(a)
    low, high = 0, min(len(a), len(b) - at)
    while low < high:  # the longest equal beginning, by halving
        mid = (low + high + 1) // 2
        if b.startswith(a[:mid], at):
            low = mid
        else:
            high = mid - 1
    return low


class Node:
    __slots__ = ("run", "below", "least", "rows")

    def __init__(self, run: bytes):
        self.run, self.below, self.least, self.rows = run, None, None, None


class Trie:
    """``size`` counts the bytes on edges."""

    def __init__(self):
        self.root, self.size = Node(b""), 0

    def insert(self, text: bytes, ident: int, row) -> None:
        node, at = self.root, 0
        while at < len(text):
            if node.below is None:
                node.below = {}
            child = node.below.get(text[at])
            if child is None:
                child = node.below[text[at]] = Node(text[at:])
                self.size += len(child.run)
                node, at = child, len(text)
                continue
            n = common(child.run, text, at)
            if n < len(child.run):  # the texts part inside the edge: split it
                fork = Node(child.run[:n])
                child.run = child.run[n:]
                fork.below = {child.run[0]: child}
                node.below[text[at]] = child = fork
            node, at = child, at + n
        if node.rows is None:
            node.rows = []
        if node.least is None or ident < node.least:
            node.least = ident
        node.rows.append((ident, row))

    def terminals(self) -> Iterator[tuple[bytes, int, list]]:
        """(text, least id, rows) of every terminal, in the order of the texts."""
        held = [(self.root, b"")]
        while held:
            node, text = held.pop()
            text += node.run
            if node.rows is not None:
                yield text, node.least, node.rows
            if node.below:
                held += [(node.below[k], text) for k in sorted(node.below, reverse=True)]
