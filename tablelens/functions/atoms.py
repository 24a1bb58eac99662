"""What one query word asks of a token array: an exact word, a prefix, or a near spelling."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Word:
    text: str

    def accepts(self, token: Column) -> Column:
        return token == self.text

    def present(self, tokens: Column) -> Column:
        return F.array_contains(tokens, self.text)

    def frequency(self, tokens: Column) -> Column:
        return F.size(tokens) - F.size(F.array_remove(tokens, self.text))


class _Pattern:
    def present(self, tokens: Column) -> Column:
        return F.exists(tokens, self.accepts)

    def frequency(self, tokens: Column) -> Column:
        return F.size(F.filter(tokens, self.accepts))


@dataclass(frozen=True)
class Prefix(_Pattern):
    text: str

    def accepts(self, token: Column) -> Column:
        return token.startswith(self.text)


@dataclass(frozen=True)
class Fuzzy(_Pattern):
    """Within ``distance`` edits, sharing the first ``prefix_length`` characters."""

    text: str
    distance: int
    prefix_length: int = 0

    def accepts(self, token: Column) -> Column:
        near = F.levenshtein(token, F.lit(self.text), self.distance) >= 0
        near = near & (token != "")
        if self.prefix_length:
            near = token.startswith(self.text[: self.prefix_length]) & near
        return near


@dataclass(frozen=True, eq=False)
class OneOf(_Pattern):
    """The same test, restricted to an array of accepted terms."""

    test: object
    terms: Column

    def accepts(self, token: Column) -> Column:
        return F.array_contains(self.terms, token)

    def __str__(self):
        return f"expanded {self.test}"

    def __eq__(self, other):
        return isinstance(other, OneOf) and other.test == self.test

    def __hash__(self):
        return hash(self.test)


def auto_distance(word: str) -> int:
    """The usual automatic edit distance: 0 up to two characters, 1 up to five, then 2."""
    return 0 if len(word) < 3 else 1 if len(word) < 6 else 2


def _all(columns) -> Column:
    return reduce(lambda a, b: a & b, columns)


def bind(value: Column, body) -> Column:
    """``body`` of a value that is computed once.

    A column used inside a lambda may be inlined there and computed again per element; a lambda
    variable is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def phrase_count(tokens: Column, parts: list[tuple[int, object]]) -> Column:
    """Occurrences of the parts at exactly these distances from each other."""
    span = parts[-1][0] + 1

    def count(t: Column) -> Column:
        starts = F.filter(
            F.sequence(F.lit(1), F.size(t) - span + 1),
            lambda at: _all([part.accepts(F.get(t, at - 1 + gap)) for gap, part in parts]),
        )
        return F.when(F.size(t) >= span, F.size(starts)).otherwise(0)

    return bind(tokens, count)


def phrase_present(tokens: Column, parts: list[tuple[int, object]]) -> Column:
    adjacent = [gap for gap, _ in parts] == list(range(len(parts)))
    if adjacent and all(isinstance(part, (Word, Prefix)) for _, part in parts[-1:]) and all(
        isinstance(part, Word) for _, part in parts[:-1]
    ):
        # One substring test over the joined tokens; tokens hold no spaces.
        needle = " " + " ".join(part.text for _, part in parts)
        if isinstance(parts[-1][1], Word):
            needle += " "
        return F.concat(F.lit(" "), F.array_join(tokens, " "), F.lit(" ")).contains(needle)
    return phrase_count(tokens, parts) > 0


def _positions(tokens: Column, part) -> Column:
    at = F.transform(tokens, lambda t, i: F.when(part.accepts(t), i))
    return F.filter(at, lambda p: p.isNotNull())


def sloppy_phrase(tokens: Column, parts: list[tuple[int, object]], slop: int) -> Column:
    """Some choice of distinct positions moves by at most ``slop`` relative to the phrase.

    With position minus offset as a word's shift, the shifts must fit in a window of ``slop``.
    A word asked for several times takes its positions greedily from left to right.
    """
    by_part: dict[object, list[int]] = {}
    for gap, part in parts:
        by_part.setdefault(part, []).append(gap)
    found = {part: f"p{i}" for i, part in enumerate(by_part)}
    positions = bind(tokens, lambda t: F.struct(*[_positions(t, part).alias(n) for part, n in found.items()]))

    def present(p: Column) -> Column:
        anchors = [
            F.transform(p[found[part]], lambda at: at - gap) for part, gaps in by_part.items() for gap in gaps
        ]

        def fits(low: Column) -> Column:
            tests = []
            for part, gaps in by_part.items():
                if len(gaps) == 1:
                    near = F.exists(p[found[part]], lambda at: (at - gaps[0]).between(low, low + slop))
                    tests.append(near)
                    continue
                wanted = F.array(*[F.lit(g) for g in gaps])
                placed = F.aggregate(
                    p[found[part]],
                    F.lit(0),
                    lambda n, at: F.when(
                        (n < len(gaps)) & (at - F.get(wanted, n)).between(low, low + slop), n + 1
                    ).otherwise(n),
                )
                tests.append(placed == len(gaps))
            return _all(tests)

        everywhere = _all([F.size(p[n]) >= len(by_part[part]) for part, n in found.items()])
        return everywhere & F.exists(F.array_distinct(F.concat(*anchors)), fits)

    return bind(positions, present)
