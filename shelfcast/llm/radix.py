"""An adaptive radix tree over byte strings: nodes change their layout as they fill up, single-child paths are one edge."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator


class _Sorted:
    """Up to 4, then up to 16 children beside their bytes, in order."""

    __slots__ = ("bytes", "kids", "room")

    def __init__(self) -> None:
        self.bytes, self.kids, self.room = bytearray(), [], 4

    def get(self, byte: int):
        at = self.bytes.find(byte)
        return self.kids[at] if at >= 0 else None

    def put(self, byte: int, kid):
        if len(self.kids) == self.room:
            if self.room == 16:
                return _Indexed(self).put(byte, kid)
            self.room = 16
        at = bisect_left(self.bytes, byte)
        self.bytes.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def __iter__(self) -> Iterator:
        return iter(self.kids)


class _Indexed:
    """Up to 48 children in the order they came, found through a table of 256 places."""

    __slots__ = ("kids", "place")

    def __init__(self, full: _Sorted) -> None:
        self.place, self.kids = bytearray(256), list(full.kids)
        for n, byte in enumerate(full.bytes, 1):
            self.place[byte] = n

    def get(self, byte: int):
        n = self.place[byte]
        return self.kids[n - 1] if n else None

    def put(self, byte: int, kid):
        if len(self.kids) == 48:
            return _Direct(self).put(byte, kid)
        self.kids.append(kid)
        self.place[byte] = len(self.kids)
        return self

    def __iter__(self) -> Iterator:
        return (self.kids[n - 1] for n in self.place if n)


class _Direct:
    """A place for each byte."""

    __slots__ = ("kids",)

    def __init__(self, full: _Indexed) -> None:
        self.kids = [full.get(byte) for byte in range(256)]

    def get(self, byte: int):
        return self.kids[byte]

    def put(self, byte: int, kid):
        self.kids[byte] = kid
        return self

    def __iter__(self) -> Iterator:
        return (kid for kid in self.kids if kid is not None)


class Node:
    """`path` leads on from the byte that leads here; `value` belongs to the key that ends after it."""

    __slots__ = ("below", "path", "value")

    def __init__(self, path: bytes, value=None) -> None:
        self.path, self.value, self.below = path, value, _Sorted()


def _common(path: bytes, key: bytes, at: int) -> int:
    """Bytes that `path` and what follows `at` in `key` begin with alike."""
    if key.startswith(path, at):
        return len(path)
    low, high = 0, min(len(path), len(key) - at)
    while low < high:  # the longest that fits
        middle = (low + high + 1) // 2
        if key.startswith(path[:middle], at):
            low = middle
        else:
            high = middle - 1
    return low


def insert(root: Node | None, key: bytes, value) -> Node:
    """Puts a key into the tree; the root stays the same object once there is one."""
    if root is None:
        return Node(key, value)
    node, at = root, 0
    while True:
        same = _common(node.path, key, at)
        if same < len(node.path):
            rest = Node(node.path[same + 1 :], node.value)
            rest.below = node.below
            byte, node.path, node.value, node.below = node.path[same], node.path[:same], None, _Sorted()
            node.below = node.below.put(byte, rest)
        at += same
        if at == len(key):
            node.value = value
            return root
        kid = node.below.get(key[at])
        if kid is None:
            node.below = node.below.put(key[at], Node(key[at + 1 :], value))
            return root
        node, at = kid, at + 1


def ascending(root: Node) -> Iterator[tuple[Node, int, int]]:
    """(node, bytes before its edge, bytes up to its end) of all nodes, each after those below it, -1 before the root's edge."""
    todo = [(root, -1, len(root.path), False)]
    while todo:
        node, start, end, seen = todo.pop()
        if seen:
            yield node, start, end
            continue
        todo.append((node, start, end, True))
        todo.extend((kid, end, end + 1 + len(kid.path), False) for kid in node.below)
