"""Price levels of one contract with their best prices at hand."""

from collections.abc import Iterable
from heapq import heapify, heappop, heappush

Level = tuple[int, float]


class LevelIndex:
    """Sizes by side and price, and a heap of prices per side.

    A level that runs empty stays in its heap until it comes to the top, and a level is in it once
    at most. So a change takes the logarithm of the number of levels, and so does finding the best
    price, spread over the changes; a list in price order, as it is kept in state, is a heap
    already.
    """

    def __init__(self, levels: Iterable[tuple[int, float, int]] = ()) -> None:
        self.sizes: dict[Level, int] = {(side, price): size for side, price, size in levels}
        # Bids with the sign turned, so that the best price is the least on either side.
        self.heaps: dict[int, list[float]] = {1: [], -1: []}
        for side, price in self.sizes:
            self.heaps[side].append(-side * price)
        for heap in self.heaps.values():
            heapify(heap)
        self.held = set(self.sizes)

    def apply(self, level: Level, total: int, low: int) -> None:
        """Add ``total``, which on its way was down to ``low``; the size never falls below zero."""
        size = self.sizes.get(level, 0)
        size += total - min(0, size + low)
        if size <= 0:
            self.sizes.pop(level, None)
            return
        self.sizes[level] = size
        if level not in self.held:
            self.held.add(level)
            heappush(self.heaps[level[0]], -level[0] * level[1])

    def best(self, side: int) -> float | None:
        heap = self.heaps[side]
        while heap:
            level = (side, -side * heap[0])
            if level in self.sizes:
                return level[1]
            heappop(heap)
            self.held.discard(level)
        return None

    def rows(self) -> list[tuple[int, float, int]]:
        """Side, price and size of every level, the best of each side first."""
        order = sorted(self.sizes, key=lambda x: (x[0], -x[0] * x[1]))
        return [(*level, self.sizes[level]) for level in order]
