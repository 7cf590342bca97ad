"""An adaptive radix tree over byte keys whose width is a multiple of a fixed step.

Inner nodes change their layout as they fill: up to 4 and up to 16 children stand beside their sorted bytes, up
to 48 behind a table of 256 slots, more in a table of 256 children. A node's ``path`` holds the bytes that all
keys below it share (path compression); a key that shares no more with others is one node with its whole rest.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator
from typing import Any


class Beside:
    """Children beside their sorted bytes: room for 4, then for 16."""

    __slots__ = ("room", "marks", "kids")

    def __init__(self, room: int, marks: bytes = b"", kids: list | None = None):
        self.room, self.marks, self.kids = room, bytearray(marks), kids or []

    def get(self, byte: int) -> Node | None:
        at = self.marks.find(byte)
        return None if at < 0 else self.kids[at]

    def put(self, byte: int, kid: Node) -> Beside | Slots:
        """Adds a child for a new byte; gives the layout that now holds all."""
        if len(self.kids) == self.room:
            larger = Beside(16, self.marks, self.kids) if self.room == 4 else Slots(self.marks, self.kids)
            return larger.put(byte, kid)
        at = bisect_left(self.marks, byte)
        self.marks.insert(at, byte)
        self.kids.insert(at, kid)
        return self

    def all(self) -> list[Node]:
        return self.kids


class Slots:
    """Up to 48 children behind a table from byte to place."""

    __slots__ = ("place", "kids")

    def __init__(self, marks: bytes, kids: list):
        self.place, self.kids = bytearray(b"\xff" * 256), list(kids)
        for i, byte in enumerate(marks):
            self.place[byte] = i

    def get(self, byte: int) -> Node | None:
        at = self.place[byte]
        return None if at == 255 else self.kids[at]

    def put(self, byte: int, kid: Node) -> Slots | Direct:
        if len(self.kids) == 48:
            table: list[Node | None] = [self.get(b) for b in range(256)]
            return Direct(table).put(byte, kid)
        self.place[byte] = len(self.kids)
        self.kids.append(kid)
        return self

    def all(self) -> list[Node]:
        return [self.kids[p] for p in self.place if p != 255]


class Direct:
    """A child for each byte."""

    __slots__ = ("table",)

    def __init__(self, table: list):
        self.table = table

    def get(self, byte: int) -> Node | None:
        return self.table[byte]

    def put(self, byte: int, kid: Node) -> Direct:
        self.table[byte] = kid
        return self

    def all(self) -> list[Node]:
        return [k for k in self.table if k is not None]


class Node:
    """Shared bytes, the entries whose keys end behind them, and the children."""

    __slots__ = ("path", "entries", "kids")

    def __init__(self, path: bytes, entries: list | None = None, kids: Beside | Slots | Direct | None = None):
        self.path, self.entries, self.kids = path, entries, kids

    def hang(self, byte: int, kid: Node) -> None:
        self.kids = (self.kids or Beside(4)).put(byte, kid)


def shared_bytes(a: bytes, b: bytes) -> int:
    """Length of the common start of two byte strings."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    differ = int.from_bytes(a[:n], "big") ^ int.from_bytes(b[:n], "big")
    return n - (differ.bit_length() + 7) // 8


class Tree:
    """Keys to lists of entries."""

    def __init__(self):
        self.root = Node(b"")

    def insert(self, key: bytes, entry: Any) -> None:
        node, at = self.root, 0
        while True:
            path = node.path
            if not key.startswith(path, at):
                same = shared_bytes(path, key[at : at + len(path)])
                below = Node(path[same + 1 :], node.entries, node.kids)
                node.path, node.entries, node.kids = path[:same], None, None
                node.hang(path[same], below)
            at += len(node.path)
            if at == len(key):
                if node.entries is None:
                    node.entries = []
                node.entries.append(entry)
                return
            kid = node.kids.get(key[at]) if node.kids is not None else None
            if kid is None:
                node.hang(key[at], Node(key[at + 1 :], [entry]))
                return
            node, at = kid, at + 1

    def fold(self, head: int, step: int, begin: Callable, merge: Callable, rise: Callable) -> None:
        """Bottom-up over the byte depths head + step, head + 2 * step, ...: only these are told.

        ``begin(entry)`` is the state of a key at its end, ``merge(a, b)`` joins states, and
        ``rise(state, k, ended)`` sees the state of all keys with the same first k steps (``ended``: those that
        end there) and gives the state that goes up. A compressed path rises once for every step in it.
        """
        stack: list[list] = [[self.root, 0, None, None]]
        while stack:
            frame = stack[-1]
            node, start, todo, state = frame
            end = start + len(node.path)
            if todo is None:
                frame[2] = todo = iter(node.kids.all() if node.kids is not None else ())
            kid = next(todo, None)
            if kid is not None:
                stack.append([kid, end + 1, None, None])
                continue
            for entry in node.entries or ():
                own = begin(entry)
                state = own if state is None else merge(state, own)
            stack.pop()
            if state is None:
                continue
            # the byte that led to this node stands before its path
            first = max(start - 1, head) - head
            for k in range((end - head) // step, first // step, -1):
                state = rise(state, k, node.entries or () if head + k * step == end else ())
            if stack:
                above = stack[-1]
                above[3] = state if above[3] is None else merge(above[3], state)


def sizes(tree: Tree) -> Iterator[tuple[str, int]]:
    """Layout name and number of children of every inner node."""
    todo = [tree.root]
    while todo:
        node = todo.pop()
        if node.kids is not None:
            kids = node.kids.all()
            yield type(node.kids).__name__, len(kids)
            todo += kids
