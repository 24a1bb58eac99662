"""Conditions: each gives a filter, its null-safe complement, and a score.

``hit`` may be null, which counts as false; leaving it raw lets Spark push it to the scan.
``miss`` is written out per condition for the same reason, so negations are pushed too.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.functions.atoms import Fuzzy, OneOf, Prefix, Word, auto_distance, bind, phrase_count, phrase_present, sloppy_phrase
from tablelens.functions.text import phonetic_match
from tablelens.plans.scope import ElementScope, Scope, field_type, safe_name

def all_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, columns) if columns else F.lit(True)


def any_of(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, columns) if columns else F.lit(False)


def is_true(col: Column) -> Column:
    return F.coalesce(col, F.lit(False))


class Condition:
    def hit(self, scope: Scope) -> Column:
        raise NotImplementedError

    def miss(self, scope: Scope) -> Column:
        return ~is_true(self.hit(scope))

    def score(self, scope: Scope) -> Column:
        return F.lit(1.0)

    def text_fields(self) -> list[str]:
        return []

    def uses_text(self, scope: Scope) -> bool:
        return bool(self.text_fields())

    def reads_table_only(self, scope: Scope) -> bool:
        """The filter needs no prepared column and no collection statistics."""
        return all(scope.reads_table_only(f) for f in self.text_fields())


@dataclass
class Term(Condition):
    field: str
    value: object

    def uses_text(self, scope):
        return scope.is_text(self.field)

    def reads_table_only(self, scope):
        return scope.reads_table_only(self.field)

    def hit(self, scope):
        kind = scope.type_of(self.field)
        if kind is None:
            return F.lit(False)
        if scope.is_text(self.field):
            return all_of(
                [*scope.prefilter(self.field, [str(self.value)]),
                 F.array_contains(scope.tokens(self.field), str(self.value))]
            )
        col = scope.column(self.field)
        return F.array_contains(col, self.value) if isinstance(kind, T.ArrayType) else col == F.lit(self.value)

    def miss(self, scope):
        kind = scope.type_of(self.field)
        if kind is None:
            return F.lit(True)
        if scope.is_text(self.field) or isinstance(kind, T.ArrayType):
            return super().miss(scope)
        return ~scope.column(self.field).eqNullSafe(F.lit(self.value))


# Accepted spellings of the range operators.
RANGE_OPERATORS = {
    "<": "lt", "lt": "lt", "<=": "lte", "lte": "lte",
    ">": "gt", "gt": "gt", ">=": "gte", "gte": "gte", "between": "between",
}
_COMPARE = {
    "lt": (lambda c, v: c < v), "lte": (lambda c, v: c <= v),
    "gt": (lambda c, v: c > v), "gte": (lambda c, v: c >= v),
}
_OPPOSITE = {"lt": "gte", "lte": "gt", "gt": "lte", "gte": "lt"}


@dataclass
class Range(Condition):
    """Every bound holds for the value, or for one value of an array."""

    field: str
    bounds: list[tuple[str, object]]

    @staticmethod
    def parse(field: str, operator: str, value) -> "Range | None":
        op = RANGE_OPERATORS.get(operator.lower())
        if op is None:
            raise TypeError(f"{operator!r} is no bound; use one of {', '.join(RANGE_OPERATORS)}")
        if op != "between":
            return Range(field, [(op, value)])
        if not isinstance(value, (list, tuple)) or len(value) != 2:
            raise TypeError(f"a range between two bounds takes both of them, None for an open one, not {value!r}")
        bounds = [(o, v) for o, v in zip(("gte", "lte"), value) if v is not None]
        return Range(field, bounds) if bounds else None

    def _inside(self, col: Column) -> Column:
        return all_of([_COMPARE[op](col, F.lit(v)) for op, v in self.bounds])

    def hit(self, scope):
        kind = scope.type_of(self.field)
        if kind is None:
            return F.lit(False)
        col = scope.column(self.field)
        return F.exists(col, self._inside) if isinstance(kind, T.ArrayType) else self._inside(col)

    def miss(self, scope):
        kind = scope.type_of(self.field)
        if kind is None or isinstance(kind, T.ArrayType):
            return super().miss(scope)
        col = scope.column(self.field)
        return any_of([col.isNull(), *[_COMPARE[_OPPOSITE[op]](col, F.lit(v)) for op, v in self.bounds]])


@dataclass
class Exists(Condition):
    field: str

    def hit(self, scope):
        kind = scope.type_of(self.field)
        if kind is None:
            return F.lit(False)
        col = scope.column(self.field)
        return F.exists(col, lambda v: v.isNotNull()) if isinstance(kind, T.ArrayType) else col.isNotNull()

    def miss(self, scope):
        kind = scope.type_of(self.field)
        if kind is None:
            return F.lit(True)
        return super().miss(scope) if isinstance(kind, T.ArrayType) else scope.column(self.field).isNull()


@dataclass
class Wildcard(Condition):
    """``*`` is any run of characters and ``?`` is one; the whole value must match."""

    field: str
    pattern: str

    def _like(self) -> str:
        escaped = "".join("\\" + ch if ch in "\\%_" else ch for ch in self.pattern)
        return escaped.replace("*", "%").replace("?", "_")

    def hit(self, scope):
        kind = scope.type_of(self.field)
        if kind is None:
            return F.lit(False)
        col, like = scope.column(self.field), self._like()
        return F.exists(col, lambda v: v.like(like)) if isinstance(kind, T.ArrayType) else col.like(like)


@dataclass
class TermsSet(Condition):
    """At least ``minimum`` of the terms; a string is a Spark SQL expression and may read row columns.

    In an expression, ``num_terms`` is the number of terms given.
    """

    field: str
    terms: list
    minimum: int | str | None = None

    def hit(self, scope):
        if scope.type_of(self.field) is None:
            return F.lit(False)
        terms = list(dict.fromkeys(self.terms))
        wanted = F.array(*[F.lit(t) for t in terms])
        values = scope.tokens(self.field) if scope.is_text(self.field) else scope.column(self.field)
        if not isinstance(scope.type_of(self.field), T.ArrayType) and not scope.is_text(self.field):
            values = F.array(values)
        need = 1 if self.minimum is None else self.minimum
        if isinstance(need, str):
            need = F.expr(re.sub(r"(?<![`.\w])num_terms(?![`\w])", str(len(self.terms)), need))
        return F.size(F.array_intersect(values, wanted)) >= need

    def uses_text(self, scope):
        return scope.is_text(self.field)

    def reads_table_only(self, scope):
        return scope.reads_table_only(self.field)


@dataclass
class Raw(Condition):
    """Any boolean column or SQL expression."""

    expression: Column | str

    def hit(self, scope):
        return F.expr(self.expression) if isinstance(self.expression, str) else self.expression


def required(minimum, count: int) -> int:
    """A count, a negative count (that many may miss), or either as a percentage rounded down."""
    if isinstance(minimum, str) and minimum.strip().endswith("%"):
        share = float(minimum.strip()[:-1])
        need = int(math.floor(count * abs(share) / 100))
        return max(count - need if share < 0 else need, 0)
    need = int(minimum)
    return max(count + need if need < 0 else need, 0)


class TextCondition(Condition):
    def text_fields(self):
        return [self.field]


@dataclass
class Match(TextCondition):
    """Any word (default) or all words of the phrase."""

    field: str
    phrase: str
    operator: str = "or"
    boost: float = 1.0
    minimum_should_match: int | str | None = None
    fuzziness: int | str | None = None
    prefix_length: int = 0
    max_expansions: int | None = None

    def reads_table_only(self, scope):
        return super().reads_table_only(scope) and not (self.fuzziness is not None and self.max_expansions)

    def parts(self, scope):
        """One test per distinct word.

        With ``max_expansions`` a fuzzy word accepts only that many nearest vocabulary terms;
        without it, every term within the distance.
        """
        parts = []
        for word in scope.analyzer(self.field).query(self.phrase):
            if not word:
                continue
            part = Word(word)
            if self.fuzziness is not None:
                auto = str(self.fuzziness).upper() == "AUTO"
                distance = auto_distance(word) if auto else int(self.fuzziness)
                if distance:
                    part = Fuzzy(word, distance, self.prefix_length)
                if distance and self.max_expansions:
                    part = OneOf(part, scope.expansions(self.field, part, self.max_expansions))
            if part not in parts:
                parts.append(part)
        return parts

    def hit(self, scope):
        parts = self.parts(scope)
        if not parts or scope.type_of(self.field) is None:
            return F.lit(False)
        need = 1
        if self.operator.lower() == "and":
            need = len(parts)
        elif self.minimum_should_match is not None:
            need = max(required(self.minimum_should_match, len(parts)), 1)
        if need > len(parts):
            return F.lit(False)
        tokens = scope.tokens(self.field)
        if all(isinstance(p, Word) for p in parts):
            words = [p.text for p in parts]
            wanted = F.array(*[F.lit(w) for w in words])
            cheap = scope.prefilter(self.field, words)
            if need == len(parts):
                found = F.size(F.array_except(wanted, tokens)) == 0
                return all_of([*cheap, found])
            if need == 1:
                return all_of([*([any_of(cheap)] if cheap else []), F.arrays_overlap(tokens, wanted)])
            return F.size(F.array_intersect(wanted, tokens)) >= need
        if need == 1:
            return any_of([p.present(tokens) for p in parts])
        if need == len(parts):
            return all_of([p.present(tokens) for p in parts])
        return sum((is_true(p.present(tokens)).cast("int") for p in parts), F.lit(0)) >= need

    def score(self, scope):
        tokens = scope.scored_tokens(self.field)
        total = F.lit(0.0)
        for part in self.parts(scope):
            count = scope.counted(self.field, part, tokens)
            total = total + scope.relevance(self.field, tokens, count, scope.idf(self.field, part))
        return total * float(self.boost)


@dataclass
class Phrase(TextCondition):
    """The words in order; ``slop`` allows that many position moves; the last may be a prefix."""

    field: str
    phrase: str
    slop: int = 0
    prefix: bool = False
    boost: float = 1.0

    def parts(self, scope) -> list[tuple[int, object]]:
        words = scope.analyzer(self.field).query(self.phrase)
        kept = [(i, w) for i, w in enumerate(words) if w]
        first = kept[0][0] if kept else 0
        parts = [(i - first, Word(w)) for i, w in kept]
        if self.prefix and parts:
            last = self.phrase.split()[-1] if self.phrase.split() else ""
            raw = scope.analyzer(self.field).prefix_form(last)
            parts[-1] = (parts[-1][0], Prefix(raw or parts[-1][1].text))
        return parts

    def hit(self, scope):
        parts = self.parts(scope)
        if not parts or scope.type_of(self.field) is None:
            return F.lit(False)
        words = [p.text for _, p in parts]
        tokens = scope.tokens(self.field)
        if self.slop:
            found = sloppy_phrase(tokens, parts, self.slop)
        elif len(parts) == 1:
            found = parts[0][1].present(tokens)
        else:
            found = phrase_present(tokens, parts)
        return all_of([*scope.prefilter(self.field, words), found])

    def score(self, scope):
        parts = self.parts(scope)
        if not parts:
            return F.lit(0.0)
        tokens = scope.scored_tokens(self.field)
        weight = sum((scope.idf(self.field, p) for _, p in parts), F.lit(0.0))
        if self.slop:
            # A sloppy match counts once.
            count = is_true(sloppy_phrase(tokens, parts, self.slop)).cast("int")
        elif len(parts) == 1:
            count = parts[0][1].frequency(tokens)
        else:
            count = phrase_count(tokens, parts)
        count = scope.once(f"__phrase_{safe_name(self.field)}_{self.slop}_{parts}", count)
        return scope.relevance(self.field, tokens, count, weight) * float(self.boost)


@dataclass
class TokenPrefix(TextCondition):
    """Some token starts with the prefix; scores a constant, as multi-term conditions do."""

    field: str
    prefix: str

    def hit(self, scope):
        if scope.type_of(self.field) is None:
            return F.lit(False)
        return all_of(
            [*scope.prefilter(self.field, [self.prefix.lower()]),
             Prefix(self.prefix.lower()).present(scope.tokens(self.field))]
        )


@dataclass
class Phonetic(TextCondition):
    field: str
    phrase: str

    def hit(self, scope):
        if scope.type_of(self.field) is None:
            return F.lit(False)
        return phonetic_match(scope.tokens(self.field), self.phrase, scope.analyzer(self.field))


@dataclass
class MoreLikeThis(TextCondition):
    """Shares enough of the given text's most telling terms, which are chosen by tf-idf.

    The choice needs document frequencies, so it is made in the plan: the statistics row yields the
    chosen terms as one small array.
    """

    field: str
    like: str
    min_term_freq: int = 2
    min_doc_freq: int = 5
    max_query_terms: int = 25
    minimum: int | str = "30%"

    def _chosen(self, scope) -> Column | None:
        counts: dict[str, int] = {}
        for w in scope.analyzer(self.field).query(self.like):
            if w:
                counts[w] = counts.get(w, 0) + 1
        terms = [(w, n) for w, n in counts.items() if n >= self.min_term_freq]
        if not terms:
            return None
        scope.preload(self.field, [w for w, _ in terms])
        rows = []
        for w, n in terms:
            found_in = scope.frequency(self.field, Word(w))
            total = scope.documents(self.field)
            telling = F.round(n * (F.log((total + 1) / (found_in + 1)) + 1), 9)
            row = F.struct(
                (-telling).alias("order"), F.lit(w).alias("term"), scope.idf(self.field, Word(w)).alias("weight")
            )
            rows.append(F.when(found_in >= self.min_doc_freq, row))
        return F.slice(F.array_sort(F.array_compact(F.array(*rows))), 1, self.max_query_terms)

    def parts(self, scope) -> list[Word]:
        """Whatever of the given text may be chosen."""
        words = [w for w in scope.analyzer(self.field).query(self.like) if w]
        return [Word(w) for w in dict.fromkeys(words) if words.count(w) >= self.min_term_freq]

    def _needed(self, count: Column) -> Column:
        if isinstance(self.minimum, str) and self.minimum.endswith("%"):
            return F.greatest(F.floor(count * float(self.minimum[:-1]) / 100).cast("int"), F.lit(1))
        return F.lit(int(self.minimum))

    def reads_table_only(self, scope):
        return False

    def hit(self, scope):
        chosen = self._chosen(scope)
        if chosen is None or scope.type_of(self.field) is None:
            return F.lit(False)
        words = F.transform(chosen, lambda c: c["term"])
        shared = F.size(F.array_intersect(words, scope.tokens(self.field)))
        return (F.size(chosen) > 0) & (shared >= self._needed(F.size(chosen)))

    def score(self, scope):
        chosen = self._chosen(scope)
        if chosen is None:
            return F.lit(0.0)
        tokens = scope.scored_tokens(self.field)

        def total(bound: Column) -> Column:
            def add(so_far: Column, c: Column) -> Column:
                count = F.size(bound) - F.size(F.array_remove(bound, c["term"]))
                return so_far + scope.relevance(self.field, tokens, count, c["weight"])

            return F.aggregate(chosen, F.lit(0.0), add)

        return bind(tokens, total)


class Group(Condition):
    children: list[Condition]

    def text_fields(self):
        return [f for c in self.children for f in c.text_fields()]

    def uses_text(self, scope):
        return any(c.uses_text(scope) for c in self.children)

    def reads_table_only(self, scope):
        return all(c.reads_table_only(scope) for c in self.children)


@dataclass
class And(Group):
    children: list[Condition]

    def hit(self, scope):
        return all_of([c.hit(scope) for c in self.children])

    def miss(self, scope):
        return any_of([c.miss(scope) for c in self.children])

    def score(self, scope):
        if not self.children:
            return F.lit(1.0)
        return sum((c.score(scope) for c in self.children[1:]), self.children[0].score(scope))


@dataclass
class Or(Group):
    """At least ``minimum`` of the branches; no branch at all matches everything."""

    children: list[Condition]
    minimum: int | str = 1

    def _need(self) -> int:
        return required(self.minimum, len(self.children)) if self.children else 0

    def hit(self, scope):
        need = self._need()
        if need <= 0:
            return F.lit(True)
        hits = [c.hit(scope) for c in self.children]
        if need == 1:
            return any_of(hits)
        return sum((is_true(h).cast("int") for h in hits), F.lit(0)) >= need

    def miss(self, scope):
        if self._need() == 1:
            return all_of([c.miss(scope) for c in self.children])
        return super().miss(scope)

    def score(self, scope):
        if not self.children:
            return F.lit(1.0)
        return sum(
            (F.when(is_true(c.hit(scope)), c.score(scope)).otherwise(0.0) for c in self.children), F.lit(0.0)
        )


@dataclass
class NoneOf(Group):
    children: list[Condition]

    def hit(self, scope):
        return all_of([c.miss(scope) for c in self.children])

    def miss(self, scope):
        return is_true(any_of([c.hit(scope) for c in self.children]))

    def score(self, scope):
        return F.lit(0.0)


SCORE_MODES = ("avg", "sum", "min", "max", "none")


@dataclass
class Nested(Group):
    """One element of the array at ``path`` satisfies every child condition."""

    path: str
    children: list[Condition]
    score_mode: str = "avg"
    inner_hits: str | None = None
    inner_size: int = 3
    ignore_unmapped: bool = False

    def _element_scope(self, scope: Scope) -> ElementScope | None:
        if field_type(scope.schema, self.path) is None:
            if self.ignore_unmapped:
                return None
            raise ValueError(f"no nested field {self.path}")
        inner = ElementScope(scope, self.path)
        for f in self.text_fields():
            inner.use_text(f)
        for c in self.children:
            if c.uses_text(inner) and isinstance(c, (Term, TermsSet)):
                inner.use_text(c.field)
        return inner

    def reads_table_only(self, scope):
        return False

    def uses_text(self, scope):
        if field_type(scope.schema, self.path) is None:
            return False
        return super().uses_text(ElementScope(scope, self.path))

    @staticmethod
    def _on(inner: ElementScope, make):
        def body(element):
            inner.element = element
            return make()

        return body

    def hit(self, scope):
        inner = self._element_scope(scope)
        if inner is None:
            return F.lit(False)
        test = self._on(inner, lambda: is_true(And(self.children).hit(inner)))
        return F.exists(inner.elements(), test)

    def matching(self, scope) -> Column:
        inner = self._element_scope(scope)
        test = self._on(inner, lambda: is_true(And(self.children).hit(inner)))
        return F.transform(F.filter(inner.elements(), test), lambda e: e["value"])

    def score(self, scope):
        inner = self._element_scope(scope)
        if inner is None or self.score_mode == "none":
            return F.lit(0.0)
        test = self._on(inner, lambda: is_true(And(self.children).hit(inner)))
        value = self._on(inner, lambda: And(self.children).score(inner).cast("double"))
        scores = F.transform(F.filter(inner.elements(), test), value)
        total = F.aggregate(scores, F.lit(0.0), lambda acc, s: acc + s)
        out = {
            "sum": total,
            "avg": total / F.size(scores),
            "min": F.array_min(scores),
            "max": F.array_max(scores),
        }[self.score_mode]
        return F.when(F.size(scores) > 0, out).otherwise(0.0)
