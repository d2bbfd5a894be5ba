"""Two chained tables of what words come to.

The first words met, the frequent ones among them, are in a small table that the processor's cache holds; what it lacks is
looked up in a large one without a step in Python between; what that lacks is worked out, and kept while there's room.
"""

from __future__ import annotations

from collections.abc import Callable, Hashable

HOT_WORDS, COLD_WORDS = 100_000, 1_000_000


class _Cold(dict):
    def __init__(self, work: Callable, hot_words: int, longest: int):
        self.work, self.hot_words, self.longest = work, hot_words, longest
        self.hot: dict = {}

    def __missing__(self, word):
        out = self.work(word)
        if len(word) <= self.longest:
            (self.hot if len(self.hot) < self.hot_words else self)[word] = out
        return out


class Words:
    """find(word) is work(word), looked up where it's known. Words over longest are worked out each time."""

    def __init__(self, work: Callable[[Hashable], bytes], hot_words: int | None = None, longest: int = 64):
        self.cold = _Cold(work, HOT_WORDS if hot_words is None else hot_words, longest)
        self.cold.hot = type("Hot", (dict,), {"__missing__": self.cold.__getitem__})()
        self.find = self.cold.hot.__getitem__

    def trim(self) -> None:
        """Forgets the large table where it has grown too large; to be called between texts."""
        if len(self.cold) > COLD_WORDS:
            self.cold.clear()
