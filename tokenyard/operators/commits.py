"""Which merges of one round's candidates can be committed, though they overlap, with bounds on their counts.

A round knows the exact counts of its k best pairs, that every other pair counts at most as much as the last of them
(the cut), and for each best pair how often each token stands to its left and right (all neighbours of ``floor``
occurrences or more). From these the driver follows one-by-one learning as long as the winner is certain.

Every pair in play has an interval that holds its count. Committing ``(a, b)`` touches only pairs that share a token
with it, the edges ``(x, a)`` and ``(b, y)`` of the conflict graph: of ``(b, y)`` the occurrences that follow an ``a``
become ``(ab, y)``. Their number is the count of the triple ``a b y``. It is known exactly as long as no earlier commit
of the round could take its ends away, and else lies between zero and the least of the counts that contain it, so the
old pair loses an interval and the new pair gets one. A pair that is not in play counts at most the cut, and so do all
pairs that merges make of it. A pair is committed when its lower bound beats every other upper bound and the cut.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

Pair = tuple[str, str]


@dataclass
class Candidate:
    """A pair of tokens (hex), its count, and how often each token stands before and after it."""

    left: str
    right: str
    n: int
    before: Mapping[str, int] = field(default_factory=dict)
    after: Mapping[str, int] = field(default_factory=dict)


class _Triples:
    """Upper bounds and exact counts of token triples of the state at the start of the round."""

    def __init__(self, candidates: Sequence[Candidate], floor: int):
        self.known = {(c.left, c.right): c for c in candidates}
        self.missing = max(floor, 1) - 1  # the most that a neighbour not listed can count

    def at_most(self, x: str, y: str, z: str) -> int | None:
        found = []
        if (x, y) in self.known:
            found.append(self.known[x, y].after.get(z, self.missing))
        if (y, z) in self.known:
            found.append(self.known[y, z].before.get(x, self.missing))
        return min(found, default=None)

    def exactly(self, x: str, y: str, z: str) -> int | None:
        for n in ((self.known[x, y].after.get(z) if (x, y) in self.known else None),
                  (self.known[y, z].before.get(x) if (y, z) in self.known else None)):
            if n is not None:
                return n
        return 0 if self.missing == 0 and ((x, y) in self.known or (y, z) in self.known) else None


def commit_overlapping(candidates: Sequence[Candidate], k: int, floor: int, existing: set[str], budget: int) -> list[Pair]:
    """The merges that one-by-one learning makes next, as far as the bounds decide it; at least one.

    ``candidates``: the best pairs in learner order (count, then greatest bytes), at most ``k``; fewer mean that there
    are no others. Neighbours below ``floor`` occurrences may be left out. A merge whose bytes are a token already is
    committed alone, as it may feed counts of that token's pairs.
    """
    if not candidates:
        return []
    cut = candidates[-1].n if len(candidates) >= k else 0
    triples = _Triples(candidates, floor)
    play: dict[Pair, tuple[int, int]] = {(c.left, c.right): (c.n, c.n) for c in candidates}
    atoms: dict[str, tuple[str, ...]] = {}  # tokens made in this round, in tokens of its start
    committed: list[Pair] = []
    lefts: set[str] = set()
    rights: set[str] = set()

    def parts(token: str) -> tuple[str, ...]:
        return atoms.get(token, (token,))

    def triple(x: str, y: str, z: str, *upper: int) -> tuple[int, int]:
        """Bounds on the occurrences of three tokens in a row, of which ``upper`` are bounds too."""
        high = min(upper)
        line = parts(x) + parts(y) + parts(z)
        for i in range(len(line) - 2):
            n = triples.at_most(*line[i:i + 3])
            if n is not None:
                high = min(high, n)
        low = 0
        if len(line) == 3 and x != y and y != z and x != z and x not in rights and z not in lefts:
            low = min(triples.exactly(x, y, z) or 0, high)
        return low, high

    while len(committed) < budget and play:
        if committed:
            best = max(play, key=lambda p: (play[p][0], p))
            low = play[best][0]
            if low <= cut or any((play[p][1], p) > (low, best) for p in play if p != best):
                break
        else:
            best = (candidates[0].left, candidates[0].right)
        a, b = best
        new = a + b
        if new in existing or new in atoms:
            if not committed:
                committed.append(best)
            break
        total = play.pop(best)[1]
        made: dict[Pair, tuple[int, int]] = {}
        for (left, right), (low, high) in list(play.items()):
            if left == b and right == a:  # in a b a b both of its ends may go
                after, before = triple(a, b, a, total, high)[1], triple(b, a, b, total, high)[1]
                made |= {(new, a): (0, after), (b, new): (0, before), (new, new): (0, min(after, before))}
                play[left, right] = (max(0, low - after - before), high)
            elif left == b:
                lost = triple(a, b, right, total, high)
                made[new, right] = (0 if a == b else lost[0], lost[1])
                play[left, right] = (max(0, low - lost[1]), high - made[new, right][0])
            elif right == a:
                lost = triple(left, a, b, total, high)
                made[left, new] = (0 if a == b else lost[0], lost[1])
                play[left, right] = (max(0, low - lost[1]), high - made[left, new][0])
        if a == b:  # runs of one token: aaa, aaaa
            run = triple(a, a, a, total)[1]
            made |= {(new, a): (0, run), (new, new): (0, run)}
        play |= made
        play = {p: bounds for p, bounds in play.items() if bounds[1] > cut}
        committed.append(best)
        atoms[new] = parts(a) + parts(b)
        lefts.add(a)
        rights.add(b)
    return committed
