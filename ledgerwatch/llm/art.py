"""Adaptive radix tree over byte keys: inner nodes grow from 4 to 16, 48 and 256 places, single paths are compressed."""

from __future__ import annotations

from collections.abc import Iterator


class Leafless:
    """A place for one key; it becomes an inner node when a second key passes through it."""

    __slots__ = ("path", "key")
    children = ()

    def __init__(self, path: bytes, key: int):
        self.path, self.key = path, key

    def find(self, byte: int):
        return None


class Small:
    """Up to ``room`` children: their bytes in a row, searched from left to right, children beside them."""

    __slots__ = ("path", "key", "bytes", "nodes")
    room = 4

    def __init__(self, path: bytes, key: int = -1):
        self.path, self.key = path, key
        self.bytes, self.nodes = bytearray(), []

    def find(self, byte: int):
        at = self.bytes.find(byte)
        return None if at < 0 else self.nodes[at]

    def put(self, byte: int, node) -> bool:
        at = self.bytes.find(byte)
        if at >= 0:
            self.nodes[at] = node
            return True
        if len(self.nodes) == self.room:
            return False
        self.bytes.append(byte)
        self.nodes.append(node)
        return True

    @property
    def children(self) -> Iterator[tuple[int, object]]:
        return iter(sorted(zip(self.bytes, self.nodes), key=lambda child: child[0]))


class Medium(Small):
    __slots__ = ()
    room = 16


class Indexed:
    """Up to 48 children behind an index of 256 bytes."""

    __slots__ = ("path", "key", "index", "nodes")
    room = 48

    def __init__(self, path: bytes, key: int = -1):
        self.path, self.key = path, key
        self.index, self.nodes = bytearray(256), []

    def find(self, byte: int):
        at = self.index[byte]
        return self.nodes[at - 1] if at else None

    def put(self, byte: int, node) -> bool:
        at = self.index[byte]
        if at:
            self.nodes[at - 1] = node
            return True
        if len(self.nodes) == self.room:
            return False
        self.nodes.append(node)
        self.index[byte] = len(self.nodes)
        return True

    @property
    def children(self) -> Iterator[tuple[int, object]]:
        return ((byte, self.nodes[at - 1]) for byte, at in enumerate(self.index) if at)


class Full:
    """One place for each byte."""

    __slots__ = ("path", "key", "nodes")

    def __init__(self, path: bytes, key: int = -1):
        self.path, self.key = path, key
        self.nodes = [None] * 256

    def find(self, byte: int):
        return self.nodes[byte]

    def put(self, byte: int, node) -> bool:
        self.nodes[byte] = node
        return True

    @property
    def children(self) -> Iterator[tuple[int, object]]:
        return ((byte, node) for byte, node in enumerate(self.nodes) if node is not None)


_NEXT = {Leafless: Small, Small: Medium, Medium: Indexed, Indexed: Full}


def _grown(node):
    """The node in the next larger layout."""
    bigger = _NEXT[type(node)](node.path, node.key)
    for byte, child in node.children:
        bigger.put(byte, child)
    return bigger


def _common(a: bytes, b: bytes, at: int) -> int:
    """How many bytes of ``a`` equal those of ``b`` from ``at`` on."""
    n = min(len(a), len(b) - at)
    if a[:n] == b[at : at + n]:
        return n
    low, high = 0, n  # a[:low] agrees, a[:high] doesn't
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[at + low : at + middle]:
            low = middle
        else:
            high = middle
    return low


class RadixTree:
    """Keys of bytes with a number each (0 or more); a key may be the beginning of others."""

    def __init__(self):
        self.root = Small(b"")

    def insert(self, key: bytes, number: int) -> None:
        parent, edge, node, at = None, -1, self.root, 0
        while True:
            same = _common(node.path, key, at)
            if same < len(node.path):  # the path parts here
                fork = Small(node.path[:same])
                fork.put(node.path[same], node)
                node.path = node.path[same + 1 :]
                parent.put(edge, fork)
                node = fork
            at += same
            if at == len(key):
                node.key = number
                return
            child = node.find(key[at])
            if child is None:
                leaf = Leafless(key[at + 1 :], number)
                if type(node) is Leafless or not node.put(key[at], leaf):
                    node = _grown(node)
                    node.put(key[at], leaf)
                    if parent is None:
                        self.root = node
                    else:
                        parent.put(edge, node)
                return
            parent, edge, node, at = node, key[at], child, at + 1

    def walk(self) -> Iterator[tuple[int, int, int, int]]:
        """Nodes before their children, in the order of bytes: number of the parent node, first and last depth, key or -1.

        Nodes are numbered as they come. A node spans the byte depths above ``first`` (its parent's last) up to ``last``.
        """
        stack, number = [(-1, 0, 0, self.root)], 0
        while stack:
            parent, top, at, node = stack.pop()
            last = at + len(node.path)
            yield parent, top, last, node.key
            stack.extend((number, last, last + 1, child) for _, child in reversed(list(node.children)))
            number += 1
