"""Where a condition is evaluated: on a whole row, or on one element of a nested array."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.functions.scoring import bm25, idf
from tablelens.functions.text import STANDARD, Analyzer, token_count


def field_type(schema: T.DataType, path: str) -> T.DataType | None:
    """Type of a dotted path; crossing an array of structs makes the result an array."""
    crossed = False
    for part in path.split("."):
        if isinstance(schema, T.ArrayType) and isinstance(schema.elementType, T.StructType):
            schema, crossed = schema.elementType, True
        if not isinstance(schema, T.StructType) or part not in schema.fieldNames():
            return None
        schema = schema[part].dataType
    return T.ArrayType(schema) if crossed and not isinstance(schema, T.ArrayType) else schema


def safe_name(field: str) -> str:
    return field.replace(".", "__")


class Statistics:
    """Collection statistics of the scored fields as one row, read through a scalar subquery.

    A field inside a nested array counts its elements as its documents.
    """

    COLUMN = "__stats"

    def __init__(self):
        self._parts: dict[str, Column] = {}
        self._expansions: dict[str, tuple] = {}

    def _use(self, name: str, value: Column) -> Column:
        self._parts.setdefault(name, value)
        return F.col(f"{self.COLUMN}.`{name}`")

    @property
    def empty(self) -> bool:
        return not self._parts

    def table(self, documents):
        """All statistics over the documents as one row."""
        return documents.agg(F.struct(*[v.alias(n) for n, v in self._parts.items()]).alias(self.COLUMN))

    def expansions(self, field: str, part, limit: int, units: Column, many: bool) -> Column:
        name = f"near|{field}|{part}|{limit}"
        self._expansions.setdefault(name, (part, limit, units, many))
        return F.col(f"`{name}`")

    def expansion_columns(self, documents) -> dict[str, Column]:
        """For each fuzzy word, its nearest vocabulary terms as a one-row subquery."""
        out = {}
        for name, (part, limit, units, many) in self._expansions.items():
            tokens = F.flatten(units) if many else units
            terms = documents.select(F.explode_outer(tokens).alias("term")).filter(part.accepts(F.col("term")))
            terms = terms.groupBy("term").agg(F.count("*").alias("n"))
            away = F.levenshtein("term", F.lit(part.text))
            nearest = terms.select("term", "n", away.alias("away")).orderBy("away", F.desc("n"), "term").limit(limit)
            out[name] = nearest.agg(F.collect_list("term").alias("terms")).scalar()
        return out

    def _counted(self, units: Column, per_unit: bool, test) -> Column:
        if per_unit:
            return F.sum(F.size(F.filter(units, lambda t: F.coalesce(test(t), F.lit(False)))))
        return F.count_if(test(units))

    def documents(self, field: str, units: Column, many: bool) -> Column:
        return self._use(f"n|{field}", self._counted(units, many, lambda t: token_count(t) > 0))

    def length(self, field: str, units: Column, many: bool) -> Column:
        per_row = (
            F.aggregate(units, F.lit(0), lambda acc, t: acc + token_count(t)) if many else token_count(units)
        )
        return self._use(f"len|{field}", F.sum(per_row))

    def frequency(self, field: str, part, units: Column, many: bool) -> Column:
        return self._use(f"df|{field}|{part}", self._counted(units, many, part.present))


# Empty positions between the elements of a multi-valued text, so phrases do not span two of them.
ELEMENT_GAP = 100


def joined(lists: Column) -> Column:
    """One token list of the lists of a multi-valued text."""
    return F.flatten(F.transform(lists, lambda t: F.concat(t, F.array_repeat(F.lit(""), ELEMENT_GAP))))


class Scope:
    def __init__(self, schema: T.StructType, analyzers: dict[str, Analyzer], stored: dict[str, str] | None = None):
        self.schema = schema
        self.analyzers = analyzers
        self.stored = stored or {}
        self.prepared: dict[str, Column] = {}
        self.derived: dict[str, Column] = {}
        self.statistics = Statistics()

    # Fields -----------------------------------------------------------------

    def type_of(self, field: str) -> T.DataType | None:
        # A field with stored tokens may be searched without its text.
        return field_type(self.schema, field) or (T.StringType() if field in self.stored else None)

    def column(self, field: str) -> Column:
        return F.col(field)

    def full(self, field: str) -> str:
        return field

    def is_text(self, field: str) -> bool:
        return field in self.analyzers

    def analyzer(self, field: str) -> Analyzer:
        return self.analyzers.get(field, STANDARD)

    def tokens(self, field: str) -> Column:
        if field in self.stored:
            return F.col(self.stored[field])
        analyzer = self.analyzer(field)
        if isinstance(self.type_of(field), T.ArrayType):
            expr = joined(analyzer.token_lists(self.column(field)))
        else:
            expr = analyzer.tokens(self.column(field))
        if analyzer.runs_in_jvm:
            return expr
        name = f"__tokens_{safe_name(field)}"
        self.prepared.setdefault(name, expr)
        return F.col(name)

    def analyzed(self, field: str) -> Column:
        """Tokens for rows outside the filter, such as those of a page."""
        return F.col(self.stored[field]) if field in self.stored else self.analyzer(field).tokens(self.column(field))

    def scored_tokens(self, field: str) -> Column:
        """Tokens as a column of their own, so several uses share one evaluation."""
        if field in self.stored:
            return F.col(self.stored[field])
        tokens = self.tokens(field)
        name = f"__tokens_{safe_name(field)}"
        self.prepared.setdefault(name, tokens)
        return F.col(name)

    def use_text(self, field: str) -> None:
        self.tokens(field)

    def reads_table_only(self, field: str) -> bool:
        """The field's tokens are stored or are an expression of its text."""
        return field in self.stored or self.analyzer(field).runs_in_jvm

    # Relevance ---------------------------------------------------------------

    def _units(self, field: str) -> tuple[Column, bool]:
        return self.scored_tokens(field), False

    def documents(self, field: str) -> Column:
        return self.statistics.documents(self.full(field), *self._units(field))

    def frequency(self, field: str, part) -> Column:
        return self.statistics.frequency(self.full(field), part, *self._units(field))

    def preload(self, field: str, words: list[str]) -> None:
        """Announce words whose frequencies will be asked for."""

    def idf(self, field: str, part) -> Column:
        return idf(self.documents(field), self.frequency(field, part))

    def expansions(self, field: str, part, limit: int) -> Column:
        """The nearest vocabulary terms a fuzzy word accepts, as a small array."""
        units, many = self._units(field)
        return self.statistics.expansions(self.full(field), part, limit, units, many)

    def relevance(self, field: str, tokens: Column, frequency: Column, weight: Column) -> Column:
        """BM25 of one part; a frequency of 0 gives 0."""
        name = self.full(field)
        units, many = self._units(field)
        average = self.statistics.length(name, units, many) / self.statistics.documents(name, units, many)
        return F.coalesce(bm25(frequency.cast("double"), self.length(field, tokens), average, weight), F.lit(0.0))

    def once(self, name: str, value: Column) -> Column:
        """A value derived from prepared columns that several expressions use."""
        self.derived.setdefault(name, value)
        return F.col(f"`{name}`")

    def length(self, field: str, tokens: Column) -> Column:
        return self.once(f"__length_{safe_name(field)}", token_count(tokens))

    def counted(self, field: str, part, tokens: Column) -> Column:
        return self.once(f"__tf_{safe_name(field)}_{part}", part.frequency(tokens))

    def prefilter(self, field: str, words: list[str]) -> list[Column]:
        """Cheap substring tests implied by the presence of the words."""
        analyzer = self.analyzer(field)
        if field in self.stored or analyzer != STANDARD or not isinstance(self.type_of(field), T.StringType):
            return []
        return [F.lower(self.column(field)).contains(w) for w in words]


class ElementScope(Scope):
    """One struct of a nested array; ``element`` is the lambda variable."""

    def __init__(self, row: Scope, path: str):
        super().__init__(row.schema, row.analyzers)
        self.row, self.path = row, path
        self.prepared, self.statistics = row.prepared, row.statistics
        self.element: Column | None = None
        self._lists: list[str] = []

    def full(self, field: str) -> str:
        return field if field.startswith(self.path + ".") else f"{self.path}.{field}"

    def type_of(self, field: str) -> T.DataType | None:
        outer = field_type(self.schema, self.path)
        inner = outer.elementType if isinstance(outer, T.ArrayType) else outer
        return field_type(inner, self.full(field)[len(self.path) + 1 :])

    def column(self, field: str) -> Column:
        return self._inner(self.element["value"], field)

    def is_text(self, field: str) -> bool:
        return self.full(field) in self.analyzers

    def analyzer(self, field: str) -> Analyzer:
        return self.analyzers.get(self.full(field), STANDARD)

    def _token_lists(self, field: str) -> str:
        name = f"__tokens_{safe_name(self.full(field))}"
        texts = F.transform(self.row_array(), lambda e: self._inner(e, field))
        self.prepared.setdefault(name, self.analyzer(field).token_lists(texts))
        if name not in self._lists:
            self._lists.append(name)
        return name

    def use_text(self, field: str) -> None:
        """Announce a text field before the elements are built."""
        self._token_lists(field)

    def _inner(self, element: Column, field: str) -> Column:
        for part in self.full(field)[len(self.path) + 1 :].split("."):
            element = element[part]
        return element

    def row_array(self) -> Column:
        outer = field_type(self.schema, self.path)
        col = F.col(self.path)
        return col if isinstance(outer, T.ArrayType) else F.when(col.isNotNull(), F.array(col))

    def elements(self) -> Column:
        """The nested array with each element's token lists alongside its value."""
        out = F.transform(self.row_array(), lambda v: F.struct(v.alias("value")))
        for name in self._lists:
            out = F.zip_with(out, F.col(name), lambda s, t: s.withField(name, t))
        return out

    def tokens(self, field: str) -> Column:
        return self.element[self._token_lists(field)]

    scored_tokens = tokens

    def _units(self, field: str) -> tuple[Column, bool]:
        return F.col(self._token_lists(field)), True

    def once(self, name: str, value: Column) -> Column:
        # Per element: a lambda has no columns of its own.
        return value

    def prefilter(self, field: str, words: list[str]) -> list[Column]:
        return []
