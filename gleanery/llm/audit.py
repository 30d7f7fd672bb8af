"""Cheapest edits of a turn structure, as persistent strings.

An audit is the string of the edits' initials. Audits that begin alike share their beginning:
each is a node that links to the node of all its letters but the last. A node knows its
ancestors at distances that are powers of two and a rolling hash of its whole string, so that two
audits are compared by searching for their longest common prefix, and the prefix is then verified
letter by letter.
"""

from __future__ import annotations

import functools

_PRIME = (1 << 61) - 1
_BASE = 0x1F3D5B79A2C4E681 % _PRIME

ROOT = 0


class Audits:
    """A tree of strings; ``ROOT`` is the empty one."""

    def __init__(self, base: int = _BASE, prime: int = _PRIME):
        self.base, self.prime = base, prime
        self.letters, self.depths, self.hashes = [""], [0], [0]
        self.ancestors: list[tuple[int, ...]] = [()]  # at distances 1, 2, 4, ...
        self.children: dict[tuple[int, str], int] = {}

    def add(self, node: int, letter: str) -> int:
        """The string of ``node`` and one more letter; the same node each time."""
        child = self.children.get((node, letter))
        if child is None:
            child = self.children[node, letter] = len(self.letters)
            lifted, at, k = [node], node, 0
            while k < len(self.ancestors[at]):
                at = self.ancestors[at][k]
                lifted.append(at)
                k += 1
            self.letters.append(letter)
            self.depths.append(self.depths[node] + 1)
            self.hashes.append((self.hashes[node] * self.base + ord(letter)) % self.prime)
            self.ancestors.append(tuple(lifted))
        return child

    def extend(self, node: int, letters: str) -> int:
        for letter in letters:
            node = self.add(node, letter)
        return node

    def _lift(self, node: int, depth: int) -> int:
        distance, k = self.depths[node] - depth, 0
        while distance:
            if distance & 1:
                node = self.ancestors[node][k]
            distance >>= 1
            k += 1
        return node

    def text(self, node: int) -> str:
        found = []
        while node != ROOT:
            found.append(self.letters[node])
            node = self.ancestors[node][0]
        return "".join(reversed(found))

    def _first_difference(self, a: int, b: int) -> tuple[int, int] | None:
        """The ancestors-or-selves of two nodes of one depth at the first letter where they differ; None if nowhere."""
        top_a, top_b = a, b
        if self.hashes[a] != self.hashes[b]:
            # longest prefixes with unequal hashes are left behind from the end, by powers of two
            for k in reversed(range(len(self.ancestors[a]))):
                if k < len(self.ancestors[a]):
                    up_a, up_b = self.ancestors[a][k], self.ancestors[b][k]
                    if self.hashes[up_a] != self.hashes[up_b]:
                        a, b = up_a, up_b
            found, a, b = (a, b), self.ancestors[a][0], self.ancestors[b][0]
        else:
            found = None
        # equal hashes may be a collision: the prefix is verified up to where both strings share a node
        while a != b:
            if self.letters[a] != self.letters[b]:
                found = (a, b)
            a, b = self.ancestors[a][0], self.ancestors[b][0]
        if found is None and top_a != top_b:
            raise AssertionError("equal strings share a node")
        return found

    def less(self, a: int, b: int) -> bool:
        """Whether the string of ``a`` sorts before that of ``b``; a prefix sorts before what it begins."""
        if a == b:
            return False
        depth = min(self.depths[a], self.depths[b])
        differ = self._first_difference(self._lift(a, depth), self._lift(b, depth))
        if differ is None:
            return self.depths[a] < self.depths[b]
        return self.letters[differ[0]] < self.letters[differ[1]]

    def better(self, one: tuple[int, int] | None, other: tuple[int, int] | None) -> tuple[int, int] | None:
        """The cheaper of two (cost, node); of equally cheap ones the string that sorts first."""
        if one is None or other is None:
            return one or other
        if one[0] != other[0]:
            return min(one, other)
        return other if self.less(other[1], one[1]) else one


# Costs of the edits, and what the turns that stay must look like.
RELABEL, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
# The states of the pattern (s?(ua)+)?: nothing yet, behind the system turn, behind a user's, behind an assistant's.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
FINAL = (START, ASSISTANT)
_KEEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
_SPOKEN = {START: USER, SYSTEM: USER, ASSISTANT: USER, USER: ASSISTANT}

Heads = list  # of (cost, node) or None by state


def insert(audits: Audits, heads: Heads) -> Heads:
    """Heads once turns may have been inserted: a user's behind any state but a user's, an assistant's behind that."""
    heads = list(heads)
    for before, behind in ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT)):
        if heads[before] is not None:
            cost, node = heads[before]
            if heads[behind] is None or cost + INSERT <= heads[behind][0]:
                heads[behind] = audits.better(heads[behind], (cost + INSERT, audits.add(node, "I")))
    return heads


def step(audits: Audits, heads: Heads, initial: str, fault: str) -> Heads:
    """Heads behind a turn: ``initial`` of its role, ``fault`` b (blank), d (duplicate), t (truncated) or k (none)."""
    found: Heads = [None] * 4
    for state, head in enumerate(insert(audits, heads)):
        if head is None:
            continue
        cost, node = head
        edits = [(cost + DELETE, state, "D")]
        if fault not in "bd":
            open_end = TRUNCATED if fault == "t" else 0
            kept, spoken = _KEEP.get((state, initial)), _SPOKEN[state]
            if kept is not None:
                edits.append((cost + open_end, kept, "K"))
            if kept != spoken:
                edits.append((cost + RELABEL + open_end, spoken, "R"))
        for total, behind, letter in edits:
            if found[behind] is None or total <= found[behind][0]:
                found[behind] = audits.better(found[behind], (total, audits.add(node, letter)))
    return found


def _paths(initials: str, faults: str, entry: int) -> list[tuple[int, str] | None]:
    audits = Audits()
    heads: Heads = [None] * 4
    heads[entry] = (0, ROOT)
    for initial, fault in zip(initials, faults, strict=True):
        heads = step(audits, heads, initial, fault)
    return [None if h is None else (h[0], audits.text(h[1])) for h in heads]


_short_paths = functools.lru_cache(maxsize=1 << 14)(_paths)
_SHORT = 64


def paths(initials: str, faults: str, entry: int) -> list[tuple[int, str] | None]:
    """Cheapest (cost, audit) of a stretch of turns from state ``entry`` to each state; inserts behind its end are not in it.

    Stretches compose: of equally cheap audits of one stretch between the same states none is a
    prefix of another (it would have inserts more, which cost), so the one that sorts first stays first
    whatever follows.
    """
    return (_short_paths if len(initials) <= _SHORT else _paths)(initials, faults, entry)


def join(stretches) -> tuple[int, str]:
    """Cheapest (cost, audit) of whole conversation; ``stretches`` yields a function from entry state to ``paths`` for each stretch."""
    audits = Audits()
    heads: Heads = [(0, ROOT), None, None, None]
    for known in stretches:
        found: Heads = [None] * 4
        for entry, head in enumerate(heads):
            if head is None:
                continue
            for behind, path in enumerate(known(entry)):
                total = None if path is None else head[0] + path[0]
                if total is not None and (found[behind] is None or total <= found[behind][0]):
                    found[behind] = audits.better(found[behind], (total, audits.extend(head[1], path[1])))
        heads = found
    heads = insert(audits, heads)
    best = audits.better(heads[START], heads[ASSISTANT])
    return best[0], audits.text(best[1])
