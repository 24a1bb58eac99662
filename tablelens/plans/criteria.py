"""The condition vocabulary shared by searches and their sub-groups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column

from tablelens.plans import conditions as C


class Criteria:
    """A list of conditions that must all hold."""

    def __init__(self):
        self.conditions: list[C.Condition] = []

    def _add(self, condition: C.Condition | None):
        if condition is not None:
            self.conditions.append(condition)
        return self

    # Values

    def term(self, field: str, value):
        """The exact value; any element of an array; any token of a text (the value is not analyzed)."""
        return self._add(C.Term(field, value))

    def range(self, field: str, operator: str, value):
        """One of ``> >= < <= gt gte lt lte between``; ``between`` takes a pair, either side may be None."""
        return self._add(C.Range.parse(field, operator, value))

    def exists(self, field: str):
        return self._add(C.Exists(field))

    def wildcard(self, field: str, pattern: str):
        return self._add(C.Wildcard(field, pattern))

    def terms_set(self, field: str, terms: list, minimum: int | str | None = None):
        return self._add(C.TermsSet(field, terms, minimum))

    def raw_condition(self, expression: Column | str):
        return self._add(C.Raw(expression))

    # Text

    def match(
        self,
        field: str,
        phrase: str,
        operator: str = "or",
        boost: float = 1.0,
        minimum_should_match: int | str | None = None,
        fuzziness: int | str | None = None,
        prefix_length: int = 0,
        max_expansions: int | None = None,
    ):
        return self._add(
            C.Match(field, phrase, operator, boost, minimum_should_match, fuzziness, prefix_length, max_expansions)
        )

    def match_phrase(self, field: str, phrase: str, slop: int = 0, boost: float = 1.0):
        return self._add(C.Phrase(field, phrase, slop, False, boost))

    def match_phrase_prefix(self, field: str, phrase: str, slop: int = 0, boost: float = 1.0):
        return self._add(C.Phrase(field, phrase, slop, True, boost))

    def match_boosted_phrase(
        self, field: str, phrase: str, operators=("exact", "and"), weights=(1, 3, 5)
    ):
        """Any of: the exact phrase, all words, any word; each adds its weighted score."""
        branches = []
        for i, operator in enumerate(operators):
            weight = weights[i] if i < len(weights) and isinstance(weights[i], (int, float)) else 1
            if operator == "exact":
                branches.append(C.Phrase(field, phrase, boost=weight))
            elif operator in ("and", "or"):
                branches.append(C.Match(field, phrase, operator, weight))
        return self._add(C.Or(branches) if branches else None)

    def token_prefix(self, field: str, prefix: str):
        return self._add(C.TokenPrefix(field, prefix))

    def sounds_like(self, field: str, phrase: str):
        return self._add(C.Phonetic(field, phrase))

    def text_expression(self, field: str, expression: "TextExpression"):
        """Words, prefixes, phrases and fuzzy words over one field, combined with ``& | ~``."""
        return self._add(expression.on(field))

    def more_like_this(
        self,
        field: str,
        like: str,
        min_term_freq: int = 2,
        min_doc_freq: int = 5,
        max_query_terms: int = 25,
        minimum_should_match: int | str = "30%",
    ):
        return self._add(
            C.MoreLikeThis(field, like, min_term_freq, min_doc_freq, max_query_terms, minimum_should_match)
        )

    # Groups

    def should(self, branches: list[Callable[["Criteria"], object]], minimum_should_match: int | str = 1):
        """At least ``minimum_should_match`` branches; a branch without conditions is left out."""
        groups = [g for g in (collect(b) for b in branches) if g]
        children = [g[0] if len(g) == 1 else C.And(g) for g in groups]
        return self._add(C.Or(children, minimum_should_match))

    def must_not(self, branch: Callable[["Criteria"], object]):
        """None of the branch's conditions holds."""
        return self._add(C.NoneOf(collect(branch)))

    def nested(
        self,
        path: str,
        branch: Callable[["Criteria"], object],
        score_mode: str = "avg",
        inner_hits: str | bool | None = None,
        inner_size: int = 3,
        ignore_unmapped: bool = False,
    ):
        """One element of the array at ``path`` satisfies the whole branch."""
        if score_mode not in C.SCORE_MODES:
            raise ValueError(f"score_mode is one of {', '.join(C.SCORE_MODES)}")
        name = f"{path}_hits" if inner_hits is True else inner_hits or None
        return self._add(C.Nested(path, collect(branch), score_mode, name, inner_size, ignore_unmapped))


def collect(branch: Callable[[Criteria], object]) -> list[C.Condition]:
    criteria = Criteria()
    branch(criteria)
    return criteria.conditions


class TextExpression:
    """A boolean combination of text tests, bound to a field later."""

    def __init__(self, make: Callable[[str], C.Condition]):
        self.on = make

    def __and__(self, other: "TextExpression"):
        return TextExpression(lambda f: C.And([self.on(f), other.on(f)]))

    def __or__(self, other: "TextExpression"):
        return TextExpression(lambda f: C.Or([self.on(f), other.on(f)]))

    def __invert__(self):
        return TextExpression(lambda f: C.NoneOf([self.on(f)]))


def word(text: str, boost: float = 1.0) -> TextExpression:
    return TextExpression(lambda f: C.Match(f, text, boost=boost))


def phrase(text: str, slop: int = 0) -> TextExpression:
    return TextExpression(lambda f: C.Phrase(f, text, slop))


def prefix(text: str) -> TextExpression:
    return TextExpression(lambda f: C.TokenPrefix(f, text))


def fuzzy(text: str, distance: int | str = "AUTO") -> TextExpression:
    return TextExpression(lambda f: C.Match(f, text, fuzziness=distance))
