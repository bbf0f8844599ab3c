"""An adaptive radix tree: keys of bytes, nodes that grow with their children, compressed paths."""

from __future__ import annotations

from bisect import bisect
from collections.abc import Iterator


class Sorted:
    """Up to 4 or 16 children, in the order of their bytes."""

    __slots__ = ("room", "bytes", "nodes")

    def __init__(self, room: int = 4):
        self.room, self.bytes, self.nodes = room, bytearray(), []

    def get(self, byte: int) -> Node | None:
        at = self.bytes.find(byte)
        return self.nodes[at] if at >= 0 else None

    def put(self, byte: int, node: Node) -> Layout:
        if len(self.bytes) < self.room:
            at = bisect(self.bytes, byte)
            self.bytes.insert(at, byte)
            self.nodes.insert(at, node)
            return self
        wider = Sorted(16) if self.room == 4 else Indexed()
        for b, n in self.items():
            wider.put(b, n)
        return wider.put(byte, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        return zip(self.bytes, self.nodes)


class Indexed:
    """Up to 48 children, found by a table of 256 places."""

    __slots__ = ("places", "nodes")
    NONE = 255

    def __init__(self):
        self.places, self.nodes = bytearray([self.NONE]) * 256, []

    def get(self, byte: int) -> Node | None:
        at = self.places[byte]
        return None if at == self.NONE else self.nodes[at]

    def put(self, byte: int, node: Node) -> Layout:
        if len(self.nodes) < 48:
            self.places[byte] = len(self.nodes)
            self.nodes.append(node)
            return self
        wider = Direct()
        for b, n in self.items():
            wider.put(b, n)
        return wider.put(byte, node)

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, self.nodes[at]) for b, at in enumerate(self.places) if at != self.NONE)


class Direct:
    """A place for each of the 256 bytes."""

    __slots__ = ("nodes",)

    def __init__(self):
        self.nodes: list[Node | None] = [None] * 256

    def get(self, byte: int) -> Node | None:
        return self.nodes[byte]

    def put(self, byte: int, node: Node) -> Layout:
        self.nodes[byte] = node
        return self

    def items(self) -> Iterator[tuple[int, Node]]:
        return ((b, n) for b, n in enumerate(self.nodes) if n is not None)


Layout = Sorted | Indexed | Direct


class Node:
    """path: the bytes between the byte under which the parent holds this node and its own children;
    value: what was put in under the key that ends here."""

    __slots__ = ("path", "value", "children")

    def __init__(self, path: bytes, value: tuple | None = None, children: Layout | None = None):
        self.path, self.value, self.children = path, value, children


def _common(a: bytes, b: bytes) -> int:
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[:middle] == b[:middle] else (low, middle - 1)
    return low


class AdaptiveRadixTree:
    """Keys with values; values of equal keys, and those below a node, are merged by merge(a, b)."""

    def __init__(self, merge):
        self.merge = merge
        self.root: Node | None = None

    def put(self, key: bytes, value: tuple) -> None:
        node, at = self.root, 0
        if node is None:
            self.root = Node(key, value)
            return
        while True:
            path = node.path
            if not key.startswith(path, at):
                shared = _common(path, key[at : at + len(path)])
                lower = Node(path[shared + 1 :], node.value, node.children)
                node.path, node.value, node.children = path[:shared], None, Sorted().put(path[shared], lower)
            at += len(node.path)
            if at == len(key):
                node.value = value if node.value is None else self.merge(node.value, value)
                return
            byte = key[at]
            child = node.children.get(byte) if node.children else None
            if child is None:
                node.children = (node.children or Sorted()).put(byte, Node(key[at + 1 :], value))
                return
            node, at = child, at + 1

    def levels(self, first: int, width: int) -> Iterator[tuple[bytes, int, tuple]]:
        """(key, from, value) of each node: its whole key, of which the bytes from `from` on are its
        own (a compressed path may pass several levels), and the merged values of all keys below.

        Only nodes whose own bytes reach a level come, that is a depth first + k * width.
        """
        if self.root is None:
            return
        order: list[tuple[Node, int, bytes, int]] = [(self.root, -1, self.root.path, 0)]
        at = 0
        while at < len(order):
            node, _, key, _ = order[at]
            for byte, child in node.children.items() if node.children else ():
                order.append((child, at, key + bytes([byte]) + child.path, len(key)))
            at += 1
        sums: list[tuple | None] = [node.value for node, _, _, _ in order]
        for k in range(len(order) - 1, 0, -1):
            up = order[k][1]
            sums[up] = sums[k] if sums[up] is None else self.merge(sums[up], sums[k])
        for (_, up, key, start), value in zip(order, sums):
            reached = (len(key) - first) // width * width + first
            if reached >= first and (reached > start or up < 0):
                yield key, start if up >= 0 else -1, value
