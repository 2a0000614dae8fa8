"""Bin completion branch-and-bound over a histogram of item sizes.

Items of one size are alike, so the search works on counts by size. A node takes the largest size
left and enumerates undominated fillings around it; the chosen filling is repeated as often as the
counts allow. Best-fit decreasing gives the first incumbent, and a branch is cut when the space it
has wasted leaves no room for one bin fewer than the incumbent. Its cost depends on the number of
sizes, never on the number of items.
"""

from __future__ import annotations

import bisect
import itertools
from collections import Counter
from collections.abc import Iterator

#: A filling: pairs of a size and how many items of it, and how many bins have it.
Pattern = tuple[tuple[tuple[int, int], ...], int]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Martello and Toth's second bound: no packing has fewer bins."""
    sizes = sorted(counts)
    best = -(-sum(s * n for s, n in counts.items()) // capacity)
    for k in [0, *(s for s in sizes if 2 * s <= capacity)]:
        large = sum(counts[s] for s in sizes if s > capacity - k)
        half = [(s, counts[s]) for s in sizes if capacity < 2 * s and s <= capacity - k]
        small = sum(s * counts[s] for s in sizes if k <= s and 2 * s <= capacity)
        bins = sum(n for _, n in half)
        room = bins * capacity - sum(s * n for s, n in half)
        best = max(best, large + bins + max(0, -(-(small - room) // capacity)))
    return best


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing, whole groups of equal bins at a time."""
    done: list[Pattern] = []
    open_: dict[int, list[list]] = {}  # by space left: fillings and how many bins have them
    spaces: list[int] = []

    def put(space: int, filling: tuple, bins: int) -> None:
        if bins and not space:
            done.append((filling, bins))
        elif bins:
            if space not in open_:
                open_[space] = []
                bisect.insort(spaces, space)
            open_[space].append([filling, bins])

    for size in sorted(counts, reverse=True):
        left = counts[size]
        while left:
            at = bisect.bisect_left(spaces, size)
            if at < len(spaces):
                space = spaces[at]
                filling, bins = open_[space].pop()
                if not open_[space]:
                    del open_[space], spaces[at]
            else:
                space, filling, bins = capacity, (), left
            each = space // size
            full = min(bins, left // each)
            put(space - each * size, (*filling, (size, each)), full)
            left -= full * each
            bins -= full
            if left and bins and left < each:
                put(space - left * size, (*filling, (size, left)), 1)
                left, bins = 0, bins - 1
            if filling:
                put(space, filling, bins)
    return done + [(filling, bins) for group in open_.values() for filling, bins in group]


class _Work:
    """What is left of a search's budget, in steps of its innermost loops."""

    def __init__(self, steps: int):
        self.left = steps


def _sums(
    sizes: list[int], counts: dict[int, int], total: int, items: int, work: _Work
) -> Iterator[tuple[int, ...]]:
    """Choices of just ``items`` items, largest first, that add up to ``total``."""
    least = sizes[0]

    def first(most: int, rest: int, more: int) -> int:
        return min(most, bisect.bisect_right(sizes, rest - (more - 1) * least) - 1)

    chosen: list[int] = []
    runs: list[int] = []  # how many items in a row have the size so far
    stack = [[first(len(sizes) - 1, total, items), total, items]]
    while stack and work.left > 0:
        at, rest, more = stack[-1]
        if at < 0 or sizes[at] * more < rest:
            stack.pop()
            if chosen:
                chosen.pop()
                runs.pop()
            continue
        work.left -= 1
        stack[-1][0] = at - 1
        size = sizes[at]
        run = 1 + (runs[-1] if chosen and chosen[-1] == size else 0)
        if counts[size] < run:
            continue
        if more == 1:
            yield (*chosen, size)
        elif more == 2:
            other = rest - size
            if counts.get(other, 0) > (run if other == size else 0):
                yield (*chosen, size, other)
        else:
            chosen.append(size)
            runs.append(run)
            stack.append([first(at, rest - size, more - 1), rest - size, more - 1])


def _dominated(
    chosen: tuple[int, ...], counts: dict[int, int], sizes: list[int], space: int, work: _Work
) -> bool:
    """Whether something left fits beside, or instead of, one or two of the chosen items."""
    if not space:
        return False
    left = Counter(chosen)

    def there(low: int, high: int) -> bool:
        at = bisect.bisect_left(sizes, low)
        while at < len(sizes) and sizes[at] <= high:
            if counts[sizes[at]] > left[sizes[at]]:
                return True
            at += 1
        return False

    if there(1, space) or any(there(size + 1, size + space) for size in left):
        return True
    distinct = list(left)
    work.left -= len(distinct) ** 2 // 2
    sums = {x + y for i, x in enumerate(distinct) for y in distinct[i + (left[x] < 2) :]}
    return any(there(both, both + space) for both in sums)


def fillings(
    counts: dict[int, int], sizes: list[int], space: int, waste: int, items: int | None, work: _Work
) -> Iterator[tuple[int, ...]]:
    """Undominated choices for ``space`` that waste at most ``waste``, the least waste, the fewest and
    the largest items first. Choices of more than ``items`` items, if that is given, are left to their
    first ones: the rest of the space goes to the largest items that fit, one after the other.

    ``sizes`` are the sizes there are, in order.
    """
    sizes = sizes[: bisect.bisect_right(sizes, space)]
    if not sizes:
        if space <= waste:
            yield ()
        return
    seen = set()
    for lost in range(min(space, waste) + 1):
        if lost == space:
            if not _dominated((), counts, sizes, lost, work):
                yield ()
            return
        total = space - lost
        most = total // sizes[0]
        for many in range(-(-total // sizes[-1]), (most if items is None else min(most, items)) + 1):
            work.left -= 1
            for chosen in _sums(sizes, counts, total, many, work):
                if chosen not in seen and not _dominated(chosen, counts, sizes, lost, work):
                    seen.add(chosen)
                    yield chosen
            if work.left <= 0:
                return
        if lost == 0:
            greedy, room = [], space
            for size in reversed(sizes):
                take = min(counts[size], room // size)
                greedy += [size] * take
                room -= take * size
                if not room:
                    break
            if items is not None and len(greedy) > items and room <= waste and tuple(greedy) not in seen:
                seen.add(tuple(greedy))
                yield tuple(greedy)


def complete(
    histogram: dict[int, int],
    capacity: int,
    steps: int = 1_000_000,
    width: int | None = None,
    items: int | None = None,
) -> list[Pattern]:
    """Fillings for all items in as few bins as the search finds.

    The result is optimal if its bins reach :func:`lower_bound` or the search ends by itself, unless
    ``width`` (fillings tried at a node) or ``items`` (of a filling besides its largest) bound it.
    After ``steps`` steps the best incumbent is taken, at worst the best-fit one; the bins chosen so
    far, with best fit for what is left, are one more.
    """
    counts = {s: n for s, n in histogram.items() if n}
    if any(s < 1 or s > capacity for s in counts):
        raise ValueError("sizes lie between one and the capacity")
    best = best_fit(counts, capacity)
    bins_of = lambda plan: sum(n for _, n in plan)
    least, total = lower_bound(counts, capacity), sum(s * n for s, n in counts.items())
    if bins_of(best) <= least:
        return best

    work = _Work(steps)
    sizes = sorted(counts)
    plan: list[Pattern] = []
    lost = 0

    def allowed() -> int:
        return (bins_of(best) - 1) * capacity - total - lost

    def change(size: int, by: int) -> None:
        before = counts[size]
        counts[size] = before + by
        if not before:
            bisect.insort(sizes, size)
        elif not counts[size]:
            del sizes[bisect.bisect_left(sizes, size)]

    def children() -> Iterator[tuple[int, ...]]:
        # Whenever a child is asked for, the counts are those of this node again.
        largest = sizes[-1]
        change(largest, -1)
        found = fillings(counts, sizes, capacity - largest, allowed(), items, work)
        for chosen in itertools.islice(found, width):
            change(largest, 1)
            yield (largest, *chosen)
            change(largest, -1)
        change(largest, 1)

    stack = [children()]
    while stack and work.left > 0:
        work.left -= 1
        chosen = next(stack[-1], None)
        if chosen is None:
            stack.pop()
            if plan:
                filling, bins = plan.pop()
                lost -= bins * (capacity - sum(s * k for s, k in filling))
                for size, each in filling:
                    change(size, bins * each)
            continue
        filling = tuple(sorted(Counter(chosen).items(), reverse=True))
        waste = capacity - sum(chosen)
        bins = min(counts[size] // each for size, each in filling)
        if waste:
            bins = min(bins, allowed() // waste)
        if bins < 1:
            continue
        for size, each in filling:
            change(size, -bins * each)
        plan.append((filling, bins))
        lost += bins * waste
        if not sizes:
            if bins_of(plan) < bins_of(best):
                best = list(plan)
                if bins_of(best) <= least:
                    return best
            stack.append(iter(()))
        else:
            stack.append(children())
    if stack:
        begun = plan + best_fit({size: n for size, n in counts.items() if n}, capacity)
        if bins_of(begun) < bins_of(best):
            best = begun
    return best
