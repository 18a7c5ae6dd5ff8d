"""Which members of clusters a name can score high against, found without scoring it against all.

Every condition here is necessary for the score that it stands for, so what is found holds all members that reach it.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator

from ..functions.fuzzy import _tokens


class Near:
    """Texts whose ratio with another can be `percent` or more.

    So near, two texts of lengths a and b differ in (1 - r) * (a + b) single letters at most, r being the least ratio that rounds to
    `percent`.  Each of those spoils `q` grams at most, so the rarest gram that both keep is among the first of either in any
    order of grams.  Grams are padded with spaces, and repeated ones are numbered.
    """

    def __init__(self, percent: int, q: int, often: Counter[str]):
        self.least, self.q, self.often = (percent - 0.5) / 100, q, often
        self.texts: dict[str, list[int]] = {}
        self.every: dict[str, frozenset[tuple[str, int]]] = {}
        self.at: dict[tuple[str, int], list[str]] = defaultdict(list)

    @staticmethod
    def grams(text: str, q: int) -> list[str]:
        padded = " " * (q - 1) + text + " " * (q - 1)
        return [padded[i : i + q] for i in range(len(padded) - q + 1)]

    def _leading(self, text: str) -> tuple[list[tuple[str, int]], frozenset[tuple[str, int]]]:
        """Grams by one of which a text is met, and all of them."""
        longest = len(text) * (2 - self.least) / self.least  # of the texts that are still so near
        seen: Counter[str] = Counter()
        numbered = []
        for g in self.grams(text, self.q):
            numbered.append((g, seen[g]))
            seen[g] += 1
        numbered.sort(key=lambda x: (self.often[x[0]], x))
        return numbered[: self.q * self._spoilt(len(text) + longest) + 1], frozenset(numbered)

    def _spoilt(self, letters: float) -> int:
        """Single letters in which two texts of so many letters together can differ."""
        return int((1 - self.least) * letters + 1e-9)

    def add(self, text: str, member: int) -> None:
        if text in self.texts:
            self.texts[text].append(member)
            return
        self.texts[text] = [member]
        leading, self.every[text] = self._leading(text)
        for g in leading:
            self.at[g].append(text)

    def find(self, text: str) -> Iterator[int]:
        low, high = len(text) * self.least / (2 - self.least) - 1e-9, len(text) * (2 - self.least) / self.least + 1e-9
        leading, every = self._leading(text)
        for t in {t for g in leading for t in self.at.get(g, ()) if low <= len(t) <= high}:
            # All grams but the spoilt ones are common.
            if len(every & self.every[t]) >= max(len(every), len(self.every[t])) - self.q * self._spoilt(len(text) + len(t)):
                yield from self.texts[t]


def _initials(words: Iterable[str]) -> frozenset[str]:
    return frozenset(w[:1] for w in words)


class Words:
    """Members with a word in common, but for a slip, which only words of `SLIP` letters or more can have."""

    SLIP = 11

    def __init__(self, often: Counter[str]):
        self.at: dict[object, list[int]] = defaultdict(list)
        self.long = Near(96, 3, often)

    def add(self, words: Iterable[str], member: int, *with_: object) -> None:
        for w in set(words):
            self.at[(w, *with_)].append(member)
            if len(w) >= self.SLIP:
                self.long.add(w, member)

    def find(self, words: Iterable[str], *with_: object) -> Iterator[int]:
        for w in set(words):
            yield from self.at.get((w, *with_), ())
            if len(w) >= self.SLIP:
                yield from self.long.find(w)


class Members:
    """Members of clusters, and those that a name can reach `percent` against; `names` are all that will be asked for, as the index puts their rare parts first."""

    def __init__(self, names: Iterable[str], percent: int, persons: bool, containment: bool = False):
        self.percent, self.persons, self.containment = percent, persons, containment
        self.of: list[tuple[int, str]] = []  # cluster and text of each member
        self.exact: dict[str, list[int]] = defaultdict(list)
        self.empty: list[int] = []
        grams, pairs, self.words_often = Counter[str](), Counter[str](), Counter[str]()
        for n in names:
            grams.update(Near.grams(n, 3))
            pairs.update(Near.grams(" ".join(sorted(set(_tokens(n)))), 2))
            self.words_often.update({*_tokens(n), *n.split(" ")})
        self.plain, self.ordered, self.bags = Near(percent, 3, grams), Near(percent, 3, grams), Near(percent, 2, pairs)
        self.initials, self.leading, self.words, self.rarest = Words(grams), Words(grams), Words(grams), Words(grams)

    def add(self, text: str, cluster: int, cleaned: str) -> None:
        """A member; `cleaned` is how the score writes it for comparing whole names."""
        member = len(self.of)
        self.of.append((cluster, text))
        self.exact[text].append(member)
        if not text:
            self.empty.append(member)
        self.plain.add(cleaned if self.persons else text, member)
        self.ordered.add(" ".join(sorted(_tokens(text))), member)
        if self.persons:
            words = text.split(" ")
            self.initials.add((w for w in words if len(w) >= 3), member, _initials(words))
            tokens = set(_tokens(text))
            self.bags.add(" ".join(sorted(tokens)), member)
            self.leading.add(self._rare(tokens), member)
            self.words.add(tokens | set(words), member)
            self.rarest.add([min(words, key=lambda w: (self.words_often[w], w))], member)

    def _rare(self, tokens: set[str]) -> list[str]:
        """The rarest words that make up more of a name than may be missing from the other one's."""
        least = (self.percent - 0.5) / 100
        may_miss = (1 - least / (2 - least)) * (sum(map(len, tokens)) + len(tokens) - 1)
        out, before = [], 0
        for w in sorted(tokens, key=lambda w: (self.words_often[w], w)):
            if before > may_miss:
                break
            out.append(w)
            before += len(w)  # without its space: rather one word too many
        return out

    def reached(self, own: str, has_initial: bool, has_several: bool) -> set[int]:
        """Numbers of all members that can score `percent` or more against a name, and of some that cannot."""
        found = set(self.exact.get(own, ()))
        if not self.persons or not (has_initial or has_several):
            found.update(self.plain.find(" ".join(sorted(own.split(" "))) if self.persons else own))
            found.update(self.ordered.find(" ".join(sorted(_tokens(own)))))
        if not self.persons:
            return found
        words = own.split(" ")
        if has_initial:
            found.update(self.initials.find((w for w in words if len(w) >= 3), _initials(words)))
        elif has_several:
            tokens = set(_tokens(own))
            found.update(self.bags.find(" ".join(sorted(tokens))))
            # Common words make up nearly all of either name: some are among its rarest.
            found.update(self.words.find(self._rare(tokens)))
            found.update(self.leading.find(tokens))
        elif self.containment:
            # The empty name is contained in all.
            found.update(self.empty if own else range(len(self.of)))
            found.update(self.words.find([min(words, key=lambda w: (self.words_often[w], w))]))
            found.update(self.rarest.find(words))
        return found
