"""Bin completion: the fewest bins of equal room for items that are given as a count of each length.

A branch-and-bound search. Each step takes the greatest length that is left and fills a bin around it; only fillings that
no other filling dominates are tried, those of least waste first, and a filling is used as often as the counts allow
before it is used less often. A branch ends where its waste and a bound of the waste still to come leave no better packing
than the best one known. The first one known is that of best fit in decreasing order, and a branch that meets the limit of
steps is closed by best fit too, so there is a packing at any limit. Work depends on the number of lengths, at most
``room``, and not on the number of items.
"""

from __future__ import annotations

from collections.abc import Iterator

#: (length, how many) pairs of one bin, greatest length first.
Filling = tuple[tuple[int, int], ...]
#: Fillings tried before the search gives up proving that its best packing is the least.
STEPS = 20_000


def best_fit(counts: dict[int, int], room: int) -> list[tuple[Filling, int]]:
    """(filling, times): each item, greatest first, in the fullest bin that has room for it."""
    bins: dict[int, dict[Filling, int]] = {}  # by free room
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            free = min((r for r in bins if r >= length), default=room)
            if free == room:
                filling, there = (), -(-left // (room // length))
            else:
                filling, there = bins[free].popitem()
                if not bins[free]:
                    del bins[free]
            each = free // length
            whole = min(there, left // each)
            rest = left - whole * each if there > whole else 0
            rest = min(rest, each - 1)
            for k, times in ((each, whole), (rest, 1 if rest else 0), (0, there - whole - (1 if rest else 0))):
                if times:
                    new = (*filling, (length, k)) if k else filling
                    if new:
                        group = bins.setdefault(free - k * length, {})
                        group[new] = group.get(new, 0) + times
            left -= whole * each + rest
    return [(f, n) for group in bins.values() for f, n in group.items()]


def waste_bound(counts: dict[int, int], room: int) -> int:
    """Free room that every packing has: what small items cannot fill beside items of over half a bin."""
    lengths = sorted(counts)
    waste = pool = small = 0
    for length in reversed(lengths):
        if 2 * length <= room:
            break
        free = room - length
        while small < len(lengths) and lengths[small] <= free:
            pool += lengths[small] * counts[lengths[small]]
            small += 1
        need = counts[length] * free
        waste += max(0, need - pool)
        pool = max(0, pool - need)
    return waste


def _dilated(sums: int, by: int) -> int:
    """Bit i is set where one of the bits i - by to i is."""
    done = 0
    while done < by:
        step = min(done + 1, by - done)
        sums |= sums << step
        done += step
    return sums


class _Search:
    def __init__(self, counts: dict[int, int], room: int, steps: int):
        self.counts, self.room, self.steps = dict(counts), room, steps
        self.lengths = sorted(counts)
        self.total = sum(x * n for x, n in counts.items())
        #: ``self.sums[i]``: sums that the first i lengths can make, as bits; the first ``self.known`` are up to date
        self.sums, self.used, self.known = [1] * (len(self.lengths) + 1), [0] * len(self.lengths), 0

    def _reach(self, top: int) -> None:
        """Bring ``sums`` up to date for the first ``top`` lengths."""
        mask = (1 << (self.room + 1)) - 1
        for i in range(top):
            length = self.lengths[i]
            copies = min(self.counts.get(length, 0), self.room // length)
            if i < self.known and self.used[i] == copies:
                continue
            self.known, self.used[i] = i, copies
            sums, size = self.sums[i], 1
            while copies:
                take = min(size, copies)
                sums |= (sums << (take * length)) & mask
                copies -= take
                size *= 2
            self.sums[i + 1], self.known = sums, i + 1

    def _exact(self, free: int, top: int) -> Iterator[Filling]:
        """Fillings of sum ``free`` from the first ``top`` lengths, greatest lengths first."""
        stack: list[tuple[int, int, Filling]] = [(free, top, ())]
        while stack:
            left, i, chosen = stack.pop()
            if not left:
                yield chosen
                continue
            while i and (self.lengths[i - 1] > left or not self.counts.get(self.lengths[i - 1])):
                i -= 1
            if not i or not self.sums[i] >> left & 1:
                continue
            length = self.lengths[i - 1]
            for k in range(min(self.counts[length], left // length) + 1):  # the last one comes off the stack first
                if self.sums[i - 1] >> (left - k * length) & 1:
                    stack.append((left - k * length, i - 1, (*chosen, (length, k)) if k else chosen))

    def _dominated(self, filling: Filling, spare: int) -> bool:
        """Whether an item left out could take the place of a part of the filling, or of nothing, and waste no more."""
        taken = dict(filling)
        one = many = 0
        for length, k in filling[1:]:
            for _ in range(k):
                many |= (one | many) << length
                one |= 1 << length
        out = 0
        for length in self.lengths:
            if length > self.room - filling[0][0]:
                break
            if self.counts.get(length, 0) > taken.get(length, 0):
                out |= 1 << length
        better = _dilated(many, spare)
        if spare:
            better |= _dilated((1 | one) << 1, spare - 1)
        return bool(better & out)

    def fillings(self, allowed: int) -> Iterator[tuple[Filling, int]]:
        """(filling, waste) around the greatest length left, least waste first."""
        greatest = max(self.counts)
        free = self.room - greatest
        self.counts[greatest] -= 1
        top = sum(1 for x in self.lengths if x <= free)
        self._reach(top)
        sums = self.sums[top]
        self.counts[greatest] += 1
        for waste in range(min(free, allowed) + 1):
            if not sums >> (free - waste) & 1:
                continue
            self.counts[greatest] -= 1
            self._reach(top)
            found = self._exact(free - waste, top)
            self.counts[greatest] += 1
            while True:
                self.counts[greatest] -= 1
                rest = next(found, None)
                self.counts[greatest] += 1
                if rest is None:
                    break
                self.steps -= 1
                if rest and rest[0][0] == greatest:
                    filling = ((greatest, rest[0][1] + 1), *rest[1:])
                else:
                    filling = ((greatest, 1), *rest)
                if not self._dominated(filling, waste):
                    yield filling, waste
                elif self.steps <= 0:
                    return

    def _use(self, filling: Filling, times: int) -> None:
        for length, k in filling:
            self.counts[length] = self.counts.get(length, 0) - k * times
            if not self.counts[length]:
                del self.counts[length]

    def run(self) -> list[tuple[Filling, int]]:
        best = best_fit(self.counts, self.room)
        size = sum(n for _, n in best)
        least = -(-(self.total + waste_bound(self.counts, self.room)) // self.room)
        waste, done, stack = 0, [], []
        entering = True
        while size > least:
            if entering:
                allowed = (size - 1) * self.room - self.total - waste
                if not self.counts or self.steps <= 0:
                    closed = [*done, *best_fit(self.counts, self.room)]
                    if sum(n for _, n in closed) < size:
                        best, size = closed, sum(n for _, n in closed)
                    if self.steps <= 0:
                        break
                    options = iter(())
                elif waste_bound(self.counts, self.room) > allowed:
                    options = iter(())
                else:
                    options = self._options(allowed)
                stack.append(options)
            option = next(stack[-1], None)
            if option is None:
                stack.pop()
                if not stack:
                    break
                filling, times = done.pop()
                waste -= (self.room - sum(x * k for x, k in filling)) * times
                self._use(filling, -times)
                entering = False
            else:
                filling, times = option
                self._use(filling, times)
                waste += (self.room - sum(x * k for x, k in filling)) * times
                done.append(option)
                entering = True
        return best

    def _options(self, allowed: int) -> Iterator[tuple[Filling, int]]:
        """Fillings with how often to use each: as often as there are items and waste for, then less often."""
        for filling, waste in self.fillings(allowed):
            most = min(self.counts[length] // k for length, k in filling)
            if waste:
                most = min(most, allowed // waste)
            for times in range(most, 0, -1):
                yield filling, times


def pack(counts: dict[int, int], room: int, steps: int = STEPS) -> list[tuple[Filling, int]]:
    """(filling, times) of a packing of all items into bins of ``room``: the fewest found within ``steps``.

    ``counts`` maps a length from 1 to ``room`` to its number of items; no items need no bins.
    """
    counts = {int(x): int(n) for x, n in counts.items() if n}
    if any(not 1 <= x <= room for x in counts):
        raise ValueError(f"lengths must be from 1 to {room}")
    return _Search(counts, room, steps).run() if counts else []
