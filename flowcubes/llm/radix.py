"""An adaptive radix tree over byte strings.

Inner nodes grow with their children: up to 4 and up to 16 sorted bytes beside
their children, up to 48 children behind a table of 256 slots, and 256 children
by byte. Paths without branches are kept in the node below them.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class Sorted:
    """Up to ``most`` children: their bytes in order, and they beside them."""

    __slots__ = ("bytes", "below", "most")

    def __init__(self, most: int = 4):
        self.bytes, self.below, self.most = bytearray(), [], most

    def get(self, byte: int) -> Node | None:
        i = self.bytes.find(byte)
        return self.below[i] if i >= 0 else None

    def put(self, byte: int, node: Node) -> Layout:
        i = bisect_left(self.bytes, byte)
        if i < len(self.bytes) and self.bytes[i] == byte:
            self.below[i] = node
            return self
        if len(self.bytes) == self.most:
            return self.grown().put(byte, node)
        self.bytes.insert(i, byte)
        self.below.insert(i, node)
        return self

    def grown(self) -> Layout:
        if self.most == 4:
            wider: Layout = Sorted(16)
            wider.bytes, wider.below = self.bytes, self.below
            return wider
        wider = Slotted()
        for byte, node in zip(self.bytes, self.below):
            wider.put(byte, node)
        return wider

    def children(self) -> Iterator[Node]:
        return iter(self.below)


class Slotted:
    """Up to 48 children, found by a slot number for each byte."""

    __slots__ = ("slot", "below")

    def __init__(self) -> None:
        self.slot, self.below = bytearray(256), []

    def get(self, byte: int) -> Node | None:
        i = self.slot[byte]
        return self.below[i - 1] if i else None

    def put(self, byte: int, node: Node) -> Layout:
        i = self.slot[byte]
        if i:
            self.below[i - 1] = node
            return self
        if len(self.below) == 48:
            return Full(self).put(byte, node)
        self.below.append(node)
        self.slot[byte] = len(self.below)
        return self

    def children(self) -> Iterator[Node]:
        return (self.below[i - 1] for i in self.slot if i)


class Full:
    """A child for each byte."""

    __slots__ = ("below",)

    def __init__(self, of: Slotted):
        self.below = [of.get(b) for b in range(256)]

    def get(self, byte: int) -> Node | None:
        return self.below[byte]

    def put(self, byte: int, node: Node) -> Layout:
        self.below[byte] = node
        return self

    def children(self) -> Iterator[Node]:
        return (n for n in self.below if n is not None)


Layout = Sorted | Slotted | Full


class Node:
    """``path``: the bytes from the parent's end to this node's; ``values``: of
    the keys that end here."""

    __slots__ = ("path", "values", "layout")

    def __init__(self, path: bytes, values: list | None = None):
        self.path, self.values, self.layout = path, values or [], None

    def children(self) -> Iterator[Node]:
        return self.layout.children() if self.layout else iter(())

    def attach(self, node: Node) -> None:
        self.layout = (self.layout or Sorted()).put(node.path[0], node)


class Tree:
    def __init__(self) -> None:
        self.root = Node(b"")

    def insert(self, key: bytes, value: object) -> None:
        above, at = self.root, 0
        while True:
            if at == len(key):
                above.values.append(value)
                return
            node = above.layout.get(key[at]) if above.layout else None
            if node is None:
                above.attach(Node(key[at:], [value]))
                return
            path = node.path
            if key.startswith(path, at):
                above, at = node, at + len(path)
                continue
            same = 1
            while same < len(path) and at + same < len(key) and path[same] == key[at + same]:
                same += 1
            split = Node(path[:same])
            node.path = path[same:]
            split.attach(node)
            above.attach(split)
            above, at = split, at + same
