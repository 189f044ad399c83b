"""K-way merge of sorted runs by a tree of losers."""

from __future__ import annotations

from collections.abc import Iterator, Sequence


class LoserTree:
    """Merges sorted sequences; each inner node keeps the loser of its match, so a step replays one path of the tree.

    Equal entries come in the order of their runs.
    """

    def __init__(self, runs: Sequence[Sequence]):
        self.runs = runs
        self.at = [0] * len(runs)
        # losers[0] is the overall winner.
        self.losers = [-1] * max(1, len(runs))
        for run in range(len(runs)):
            self._enter(run)

    def _before(self, one: int, two: int) -> bool:
        """Whether run ``one`` gives its entry before run ``two``; runs that are used up come last."""
        if self.at[one] >= len(self.runs[one]):
            return False
        if self.at[two] >= len(self.runs[two]):
            return True
        a, b = self.runs[one][self.at[one]], self.runs[two][self.at[two]]
        return a < b or (one < two and not b < a)

    def _enter(self, run: int) -> None:
        """First match of a run: it stays at the first free node on its way up."""
        node = (run + len(self.runs)) // 2
        while node:
            other = self.losers[node]
            if other < 0:
                self.losers[node] = run
                return
            if self._before(other, run):
                self.losers[node], run = run, other
            node //= 2
        self.losers[0] = run

    def __iter__(self) -> Iterator[tuple[int, int]]:
        """Run and place in it of every entry, in order."""
        k = len(self.runs)
        for _ in range(sum(map(len, self.runs))):
            run = self.losers[0]
            yield run, self.at[run]
            self.at[run] += 1
            node = (run + k) // 2
            while node:
                other = self.losers[node]
                if self._before(other, run):
                    self.losers[node], run = run, other
                node //= 2
            self.losers[0] = run
