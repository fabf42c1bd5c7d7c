"""Viterbi with early output: a backpointer tree of the surviving paths.

Every step gives edges ``(from, to, cost, label)`` with one edge at most per
pair of states.  Of the paths into a state the cheapest survives, of equally
cheap ones that whose labels are least, compared in their order.  The tree holds the survivors
and nothing else: nodes count their children, a path that dies takes along
what only it used, and what all survivors share is given out and forgotten, so
memory follows the part on which the survivors still differ.

``detour[i][j]`` bounds what it costs more to end from state j as some path
ends from i.  A survivor that is dearer than another one by more than that can
not win or tie any more and dies; else a hopeless one would keep the others
from ever sharing all they agree on.

Ties compare the complete labels since that shared ancestor.  Survivors keep
their places in that order, and a step appends to each, so two paths compare
by their places; that needs labels of which none that leaves a state at a step
is a prefix of another one, which the callers' labels satisfy (each ends in
its only non-insert, or is a row-aligned string of such).  A label is anything
that can be compared.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any

Edge = tuple[int, int, int, Any]


class Node:
    __slots__ = ("parent", "label", "children", "heirs")

    def __init__(self, parent: Node | None, label: Any) -> None:
        self.parent, self.label, self.children, self.heirs = parent, label, 0, None


class Survivors:
    """The surviving paths from one start state."""

    def __init__(self, start: int, detour: dict[int, dict[int, int]] | None = None) -> None:
        self.root = Node(None, "")
        self.detour = detour or {}
        #: state -> (cost, place in the order of labels, leaf)
        self.best: dict[int, tuple[int, int, Node]] = {start: (0, 0, self.root)}
        self.nodes = 1

    def step(self, edges: Iterable[Edge]) -> Iterator[Any]:
        """Take one step; yields the labels that are certain now."""
        best, found = self.best, {}
        for i, j, cost, label in edges:
            if i in best:
                c, place, _ = best[i]
                key = (c + cost, place, label, i)
                if j not in found or key < found[j]:
                    found[j] = key
        for i in [i for i in found if any(j in found and found[i][0] > found[j][0] + more
                                          for j, more in self.detour.get(i, {}).items())]:
            del found[i]
        order = sorted(found, key=lambda j: found[j][1:3])
        new = {}
        for place, j in enumerate(order):
            cost, _, label, i = found[j]
            parent = best[i][2]
            leaf = Node(parent, label)
            parent.children += 1
            parent.heirs = leaf if parent.children == 1 else None
            self.nodes += 1
            new[j] = (cost, place, leaf)
        for i, (_, _, leaf) in best.items():
            self._release(leaf)
        self.best = new
        yield from self._certain()

    def _release(self, node: Node) -> None:
        """Drop a leaf that no survivor came from, and all that only it held."""
        while node.children == 0 and node is not self.root:
            node, gone = node.parent, node
            gone.parent = None
            node.children -= 1
            self.nodes -= 1
            if node.children == 1:
                node.heirs = None  # which of the children is left is found on the way down from a leaf

    def _certain(self) -> Iterator[Any]:
        leaves = [leaf for _, _, leaf in self.best.values()]
        while self.root.children == 1 and all(x is not self.root for x in leaves):
            child = self.root.heirs
            if child is None or child.parent is not self.root:
                child = leaves[0]
                while child.parent is not self.root:
                    child = child.parent
            self.root, child.parent = child, None
            self.nodes -= 1
            yield child.label

    def tails(self) -> dict[int, tuple[int, int, list[Any]]]:
        """Per state: cost, place in the order, and the labels not given out yet."""
        out = {}
        for state, (cost, place, leaf) in self.best.items():
            labels = []
            while leaf is not self.root:
                labels.append(leaf.label)
                leaf = leaf.parent
            out[state] = (cost, place, labels[::-1])
        return out
