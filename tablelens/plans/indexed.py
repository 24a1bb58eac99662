"""Searching what a text index holds: tokens of the asked terms and statistics, instead of the texts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.functions.atoms import Word
from tablelens.plans import conditions as C
from tablelens.plans.scope import Scope, Statistics, safe_name

# Blank positions kept between two asked terms; no phrase may reach further.
LONGEST_GAP = 1000


def held_fields(conditions, scope: Scope, index) -> set[str]:
    """Fields of which every condition needs no more than the positions of its own terms; all others read their texts."""
    if index is None:
        return set()
    held = set(index.analyzers)
    for condition in conditions:
        held -= _unheld(condition, scope)
    return held & {f for c in conditions for f in c.text_fields()}


def _unheld(condition, scope: Scope) -> set[str]:
    if not condition.uses_text(scope):
        return set()
    if isinstance(condition, (C.And, C.Or, C.NoneOf)):
        return {f for c in condition.children for f in _unheld(c, scope)}
    if isinstance(condition, (C.Match, C.Phrase, C.TokenPrefix, C.MoreLikeThis)) and getattr(condition, "slop", 0) < LONGEST_GAP:
        return set()
    return set(condition.text_fields()) or {getattr(condition, "field", "")}


class IndexStatistics(Statistics):
    """Statistics read from the index, each as a scalar subquery over its own few rows."""

    def __init__(self, index):
        super().__init__()
        self.index = index
        self.known: dict[tuple[str, str], int] = {}
        self.sizes: dict[tuple[str, str], float] = {}

    def preload(self, field: str, words: list[str]) -> None:
        """Frequencies of a query's words and the field's size by one read of their rows; from then on they are constants of the plan."""
        rows = self.index.terms.filter((F.col("field") == field) & F.col("term").isin(words)).select("term", "df").collect()
        size = self.index.fields.filter(F.col("field") == field).select("documents", "average").head()
        self.sizes.update({(field, n): size[n] for n in ("documents", "average")} if size else {})
        self.known.update({(field, w): 0 for w in words} | {(field, r["term"]): r["df"] for r in rows})

    def _field(self, field: str, column: str) -> Column:
        if (field, column) in self.sizes:
            return F.lit(self.sizes[field, column])
        return self.index.fields.filter(F.col("field") == field).select(F.max(column)).scalar()

    def documents(self, field, units, many):
        return F.coalesce(self._field(field, "documents"), F.lit(0))

    def length(self, field, units, many):
        return self._field(field, "average") * self.documents(field, units, many)

    def frequency(self, field, part, units, many):
        test = (F.col("field") == field) & part.accepts(F.col("term"))
        if isinstance(part, Word) and (field, part.text) in self.known:
            return F.lit(self.known[field, part.text])
        if isinstance(part, Word):
            return self.index.terms.filter(test).select(F.coalesce(F.sum("df"), F.lit(0))).scalar()
        return self.index.postings.filter(test).select(F.count_distinct("id")).scalar()

    def expansions(self, field, part, limit, units, many):
        near = self.index.near_spellings(field, part.text, part.distance, part.prefix_length, limit)
        terms = [r["term"] for r in near.collect()]  # at most ``limit``
        return F.array(*[F.lit(t) for t in terms]).cast("array<string>")


class IndexScope(Scope):
    """A row whose indexed fields have only the asked terms, at their places."""

    def __init__(self, schema, analyzers, stored, index, fields):
        super().__init__(schema, analyzers, stored)
        self.index, self.fields = index, fields
        self.statistics: Statistics = IndexStatistics(index)

    def _held(self, field: str) -> bool:
        return field in self.fields

    def preload(self, field, words):
        if self._held(field):
            self.statistics.preload(field, words)

    def tokens(self, field):
        return F.col(f"__found_{safe_name(field)}") if self._held(field) else super().tokens(field)

    def scored_tokens(self, field):
        return self.tokens(field) if self._held(field) else super().scored_tokens(field)

    def length(self, field, tokens):
        return F.col(f"__words_{safe_name(field)}") if self._held(field) else super().length(field, tokens)

    def reads_table_only(self, field):
        return self._held(field) or super().reads_table_only(field)

    def prefilter(self, field, words):
        return [] if self._held(field) else super().prefilter(field, words)


def covered(conditions, scope: Scope, index, field: str) -> tuple[list, list[tuple[str, str]]] | None:
    """Single words and pairs of frequent neighbours that hold all a field's phrases; None when more than exact phrases is asked."""
    leaves, rest = [], list(conditions)
    while rest:
        condition = rest.pop()
        if isinstance(condition, C.Group):
            rest.extend(condition.children)
        elif getattr(condition, "field", None) == field:
            leaves.append(condition)
    if index.pairs is None or any(not isinstance(c, C.Phrase) or c.slop or c.prefix for c in leaves):
        return None
    phrases = [c.parts(scope) for c in leaves]
    frequent = index.frequent_of(field, sorted({w.text for parts in phrases for _, w in parts}))
    single, pairs = {}, {}
    for parts in phrases:
        beside = [
            later == at + 1 and {word.text, following.text} <= frequent for (at, word), (later, following) in zip(parts, parts[1:])
        ]
        pairs |= {(parts[i][1].text, parts[i + 1][1].text): None for i, held in enumerate(beside) if held}
        single |= {w.text: w for i, (_, w) in enumerate(parts) if not any(beside[max(i - 1, 0) : i + 1])}
    return (list(single.values()), list(pairs)) if pairs else None


def with_found(rows: DataFrame, row_id: str, index, field: str, parts: list, required: bool, pairs: list[tuple[str, str]] = ()) -> DataFrame:
    """The rows with the field's asked terms and its length; only rows with such a term when ``required``.

    Terms of the ``pairs`` come from the lists of neighbours, those of ``parts`` from their own.
    """
    name = safe_name(field)

    def place(at: Column, term: str) -> Column:
        return F.struct(at.alias("at"), F.col(term).alias("term"))

    sources = []
    if parts or not pairs:
        wanted = reduce(lambda a, b: a | b, [p.accepts(F.col("term")) for p in parts], F.lit(False))
        held = index.postings.filter((F.col("field") == field) & wanted)
        sources.append(held.select("id", "length", F.transform("positions", lambda p: place(p, "term")).alias("at")))
    if pairs:
        wanted = reduce(lambda a, b: a | b, [(F.col("first") == a) & (F.col("second") == b) for a, b in pairs])
        held = index.pairs.filter((F.col("field") == field) & wanted)
        both = F.flatten(F.transform("positions", lambda p: F.array(place(p, "first"), place(p + 1, "second"))))
        sources.append(held.select("id", "length", both.alias("at")))
    held = reduce(DataFrame.unionByName, sources)
    places = F.flatten(F.collect_list("at"))
    # neighbouring pairs name their common term twice
    places = F.array_sort(F.array_distinct(places) if pairs else places)
    found = held.groupBy("id").agg(places.alias("__at"), F.max("length").alias(f"__words_{name}"))
    places = F.col("__at")

    def spaced(place, i):
        gap = place["at"] - F.coalesce(F.when(i > 0, F.get(places, i - 1)["at"]), place["at"] - 1) - 1
        return F.concat(F.array_repeat(F.lit(""), F.least(gap, F.lit(LONGEST_GAP))), F.array(place["term"]))

    found = found.select(F.col("id").alias("__id"), F.flatten(F.transform(places, spaced)).alias(f"__found_{name}"), f"__words_{name}")
    joined = rows.join(found, F.col(row_id) == F.col("__id"), "inner" if required else "left").drop("__id")
    if required:
        return joined
    empty = F.array().cast("array<string>")
    return joined.withColumns({f"__found_{name}": F.coalesce(f"__found_{name}", empty), f"__words_{name}": F.coalesce(f"__words_{name}", F.lit(0))})

