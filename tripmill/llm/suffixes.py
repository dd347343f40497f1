"""All entries of a vocabulary that end at each place of a word, and stores of recent words."""

from __future__ import annotations

from collections.abc import Hashable, Iterable, Sequence


class Suffixes:
    """An automaton over a vocabulary: one step a symbol, then the entries that end there, longest first.

    A state is the longest end of what was read that begins an entry. Symbols are
    integers: bytes, or code points of characters.
    """

    def __init__(self, entries: Sequence[Sequence[int]]):
        self.goto: dict[int, int] = {}
        depth, own = [0], [-1]
        for number, entry in enumerate(entries):
            state = 0
            for symbol in entry:
                key = state << 21 | symbol
                state = self.goto.get(key, 0)
                if not state:
                    state = self.goto[key] = len(depth)
                    depth.append(depth[key >> 21] + 1)
                    own.append(-1)
            own[state] = number
        self.fail = [0] * len(depth)
        self.ends: list[tuple[int, ...]] = [()] * len(depth)
        for key, state in sorted(self.goto.items(), key=lambda item: depth[item[1]]):
            parent = key >> 21
            if parent:
                self.fail[state] = self.step(self.fail[parent], key & 0x1FFFFF)
            longer = self.ends[self.fail[state]]
            self.ends[state] = longer if own[state] < 0 else (own[state], *longer)

    def step(self, state: int, symbol: int) -> int:
        goto = self.goto
        found = goto.get(state << 21 | symbol)
        while found is None:
            if not state:
                return 0
            state = self.fail[state]
            found = goto.get(state << 21 | symbol)
        return found


class Recent:
    """What was used lately, in two generations of about ``limit`` bytes each.

    ``young`` holds what was asked for since the last turn, so a word in steady
    use is never computed anew.
    """

    def __init__(self, limit: int):
        self.limit, self.weight = limit, 0
        self.young: dict = {}
        self.old: dict = {}

    def turn(self) -> None:
        if self.weight > self.limit:
            self.young, self.old, self.weight = {}, self.young, 0

    def find(self, keys: list) -> list:
        """The values of the keys, None for those that ``missing`` has not brought in."""
        return list(map(self.young.get, keys))

    def missing(self, keys: Iterable[Hashable]) -> list:
        """Of keys that are not young, the distinct ones that the old generation lacks too; the others become young."""
        lacking = []
        for key in set(keys):
            value = self.old.get(key)
            if value is None:
                lacking.append(key)
            else:
                self.keep(key, value)
        return lacking

    def keep(self, key, value) -> None:
        self.young[key] = value
        self.weight += 180 + len(key) + (len(value) if isinstance(value, bytes) else 0)
