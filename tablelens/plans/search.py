"""A search over one table, composed into a single lazy DataFrame."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field as attr

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.functions import scoring
from tablelens.functions.atoms import OneOf, Prefix, Word
from tablelens.functions.text import STANDARD, Analyzer
from tablelens.operators import aggregations as A
from tablelens.operators import batch_text, fusion, paging, retrieval
from tablelens.operators import highlight as H
from tablelens.operators.projection import select_fields
from tablelens.plans import conditions as C
from tablelens.plans.criteria import Criteria, collect
from tablelens.plans.indexed import IndexScope, covered, held_fields, with_found
from tablelens.plans.runtime import release, staged, written
from tablelens.plans.scope import Scope, Statistics


@dataclass
class Result:
    """Lazy frames: the page of hits and one frame per aggregation.

    One of ``find_many(once=True)`` is to be closed (or used in a ``with`` statement) when its frames
    are done with: that deletes the matches written for it.
    """

    hits: DataFrame
    aggs: dict[str, DataFrame]
    _matched: Callable[[], DataFrame]
    _track: bool | int = True
    _written: list[str] = attr(default_factory=list)

    def close(self) -> None:
        release(self.hits.sparkSession, self._written)
        self._written = []

    def __enter__(self) -> Result:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def total(self, track: bool | int | None = None) -> int | None:
        """All matches, or at most ``track`` of them, or None when tracking is off."""
        track = self._track if track is None else track
        if track is False:
            return None
        rows = self._matched().select(F.lit(1))
        return rows.count() if track is True else rows.limit(int(track)).count()


@dataclass
class Highlight:
    fields: dict[str, dict] = attr(default_factory=dict)
    options: dict = attr(default_factory=dict)


def with_tokens(df: DataFrame, text: dict[str, Analyzer]) -> tuple[DataFrame, dict[str, str]]:
    """The table with a token column per text field, to be written once, and the names for ``tokens``."""
    names = {field: f"tokens_{field}" for field in text}
    return df.withColumns({names[f]: a.tokens(F.col(f)) for f, a in text.items()}), names


class Search(Criteria):
    """Conditions, scoring, retrieval, sorting, paging and aggregations over a DataFrame.

    ``text`` names the analyzed fields and their analyzers; any other string field is matched as
    plain words.  ``tokens`` names columns that hold a field's tokens already (see
    :func:`with_tokens`), so that searches read those instead of analyzing the text again.  With an
    ``index`` (a ``TextIndex`` of this table, by the same analyzers) matches, phrases and fuzzy words of its
    fields read the postings of their terms and its statistics, and not the texts.  Methods return the
    search itself.
    """

    def __init__(
        self, df: DataFrame, id: str = "id", text: dict[str, Analyzer] | None = None, tokens: dict[str, str] | None = None,
        index=None,
    ):
        super().__init__()
        self.index = index
        self.df, self.id, self.text, self.tokens = df, id, dict(text or {}), dict(tokens or {})
        self._include: list[str] = []
        self._exclude: list[str] = []
        self._sorts: list[paging.SortKey] = []
        self._limit: int | None = None
        self._page = 1
        self._after: list | None = None
        self._min_score: float | None = None
        self._track: bool | int = True
        self._random: int | None = None
        self._factors: list[Column] = []
        self._retrievers: list[tuple[Callable[[], DataFrame], float, bool]] = []
        self._window, self._constant = fusion.WINDOW_SIZE, fusion.RANK_CONSTANT
        self._phases: list[tuple[int, list[C.Condition]]] = []
        self._highlight = Highlight()
        self._aggs: dict[str, Callable[[DataFrame], DataFrame]] = {}
        #: Fields that the aggregations read, None when any may be.
        self._aggregated: set[str] | None = set()
        #: The written matches while the frames of one result are made from them.
        self._held: DataFrame | None = None

    # Result shape -------------------------------------------------------------

    def fields(self, names: Sequence[str]):
        self._include = list(names)
        return self

    source_includes = fields

    def exclude_fields(self, names: Sequence[str]):
        self._exclude = list(names)
        return self

    source_excludes = exclude_fields

    def highlight_field(self, name: str, **options):
        self._highlight.fields[name] = options
        return self

    def highlighter_options(self, **options):
        self._highlight.options = options
        return self

    def sort(self, spec, direction: str | None = None):
        self._sorts += paging.sort_keys(spec, direction)
        return self

    def sort_by_random(self, on: bool = True, seed: int = 0):
        self._random = seed if on else None
        return self

    def limit(self, n: int):
        self._limit = n
        return self

    def page(self, number: int):
        self._page = number
        return self

    def search_after(self, values: Sequence):
        self._after = list(values)
        return self

    def min_score(self, score: float):
        self._min_score = score
        return self

    def track_total_hits(self, value: bool | int):
        self._track = value
        return self

    # Scoring ------------------------------------------------------------------

    def decay_function_score(self, kind: str, field: str, origin, scale: float, offset: float = 0.0, decay: float = 0.5):
        """Multiply the score by a decay curve; dates are measured in seconds from ``origin``."""
        value = F.col(field)
        if self.df.schema[field].dataType.typeName() in ("date", "timestamp", "timestamp_ntz"):
            value, origin = scoring.seconds(value), scoring.seconds(F.lit(origin))
        else:
            origin = F.lit(origin)
        self._factors.append(scoring.decay(kind, value, origin, scale, offset, decay))
        return self

    def field_value_factor(self, field: str, factor: float = 1.0, missing: float = 1.0):
        self._factors.append(scoring.field_factor(F.col(field), factor, missing))
        return self

    def rescore(self, window_size: int, branch: Callable[[Criteria], object]):
        self._phases.append((window_size, collect(branch)))
        return self

    # Retrieval ----------------------------------------------------------------

    def rank_window_size(self, size: int):
        self._window = size
        return self

    def rank_constant(self, constant: int):
        self._constant = constant
        return self

    def knn(
        self,
        field: str,
        vector: Sequence[float],
        k: int,
        num_candidates: int | None = None,
        weight: float = 1.0,
        filter: Callable[[Criteria], object] | Column | None = None,
        similarity: float | str | None = None,
        signature: str | None = None,
        partition: str | None = None,
        lists: retrieval.VectorLists | None = None,
        probes: int = 8,
    ):
        def run() -> DataFrame:
            rows, condition = self.df, filter
            if callable(filter) and not isinstance(filter, Column):
                # A search of its own: text and nested conditions bring their columns and statistics along.
                inner = self._inner()
                inner.conditions = collect(filter)
                rows, condition = inner.matched(), None
            return retrieval.nearest(
                rows, self.id, field, vector, k, num_candidates, condition, similarity, signature, partition, lists=lists, probes=probes
            )

        self._retrievers.append((run, weight, False))
        return self

    def _semantic_list(self, field: str, phrase: str, embed, vectors: DataFrame | None = None) -> DataFrame:
        if embed is not None:
            return retrieval.nearest(self.df, self.id, field, embed(phrase), self._window)
        asked = self.df.sparkSession.createDataFrame([(0, phrase)], "__query int, __phrase string")
        found = batch_text.semantic_search(
            self.df, self.id, field, asked, "__query", "__phrase", self._window, self.text.get(field, STANDARD),
            vectors=vectors,
        )
        return found.select(self.id, "_score")

    def semantic(self, field: str, phrase: str, weight: float = 1.0, embed: Callable[[str], Sequence[float]] | None = None,
                 vectors: DataFrame | None = None):
        """By vector when ``embed`` turns the phrase into one, else by hashed tf-idf of a text field.

        ``vectors`` are the field's stored hashed vectors (see ``batch_text.hashed_vectors``).
        """
        self._retrievers.append((lambda: self._semantic_list(field, phrase, embed, vectors), weight, True))
        return self

    def rrf(self, semantic_field: str, standard_field: str, phrase: str, weight: float = 1.0, embed=None, vectors=None):
        def run() -> DataFrame:
            lexical = self._inner().match(standard_field, phrase)._scored_rows()
            lists = [lexical.select(self.id, "_score"), self._semantic_list(semantic_field, phrase, embed, vectors)]
            return fusion.reciprocal_rank(lists, self.id, self._window, self._constant)

        self._retrievers.append((run, weight, False))
        return self

    # Aggregations ---------------------------------------------------------------

    def include_facets(self, fields, limit: int = 25):
        """Add facets; further calls add to the same ``facets`` frame."""
        self._reads(fields.values() if isinstance(fields, Mapping) else fields)
        before = self._aggs.get("facets")
        if before is None:
            self._aggs["facets"] = lambda df: A.facets(df, fields, limit)
        else:
            self._aggs["facets"] = lambda df: before(df).unionByName(A.facets(df, fields, limit))
        return self

    def aggregate_term(self, field: str, limit: int = 10, exclude=(), order=None):
        self._reads([field])
        self._aggs[field] = lambda df: A.term_counts(df, field, limit, exclude, order)
        return self.limit(0)

    def date_histogram(self, field: str, interval: str, offset: int | str = 0):
        A.bucket_start(F.lit(None), interval, offset)
        self._reads([field])
        self._aggs[field] = lambda df: A.date_histogram(df, field, interval, offset)
        return self.limit(0)

    def aggregate(self, name: str, by: Sequence, **aggregates: Column):
        self._aggregated = None
        self._aggs[name] = lambda df: A.grouped(df, by, **aggregates)
        return self

    def _reads(self, fields) -> None:
        if self._aggregated is not None:
            self._aggregated.update(fields)

    # Plan -------------------------------------------------------------------------

    def _inner(self) -> Search:
        """A search over the same table, with all that this one reads instead of texts."""
        return Search(self.df, self.id, self.text, self.tokens, self.index)

    def _scope(self) -> Scope:
        plain = Scope(self.df.schema, self.text, self.tokens)
        held = held_fields([*self.conditions, *self._phase_conditions()], plain, self.index)
        if not held:
            return plain
        return IndexScope(self.df.schema, self.text, self.tokens, self.index, held)

    def _filtered(self, scope: Scope, scored: bool) -> tuple[DataFrame, Column]:
        """Matching rows with what scoring needs, and the score."""
        plain = [c for c in self.conditions if not c.uses_text(scope)]
        textual = [c for c in self.conditions if c.uses_text(scope)]
        tests = [c.hit(scope) for c in textual]
        score = C.And(self.conditions).score(scope) if scored else F.lit(None).cast("double")
        extra = [C.And(branch).score(scope) for _, branch in self._phases] if scored else []
        extra_hits = [C.is_true(C.And(branch).hit(scope)) for _, branch in self._phases] if scored else []
        self._phase_scores = [F.when(h, s).otherwise(0.0) for h, s in zip(extra_hits, extra)]

        # Plain conditions first: they reach the scan, and text is analyzed only for what is left.
        rows = self.df
        for condition in plain:
            rows = rows.filter(condition.hit(scope))
        if isinstance(scope, IndexScope):
            for field in [f for f in scope.fields if any(f in c.text_fields() for c in [*textual, *self._phase_conditions()])]:
                asked = [*self.conditions, *self._phase_conditions()]
                paired = covered(asked, scope, self.index, field)
                parts, pairs = paired or (self._accepting(scope, field, asked, negated=True), [])
                required = any(not isinstance(c, C.Group) and c.field == field for c in textual)
                rows = with_found(rows, self.id, self.index, field, parts, required, pairs)
        documents = self.df.withColumns(scope.prepared) if scope.prepared else self.df
        expansions = scope.statistics.expansion_columns(documents)
        if expansions:
            documents = documents.withColumns(expansions)
        early = [t for t, c in zip(tests, textual) if c.reads_table_only(scope)]
        late = [t for t, c in zip(tests, textual) if not c.reads_table_only(scope)]
        for test in early:
            rows = rows.filter(test)
        if scope.prepared:
            rows = rows.withColumns(scope.prepared)
        if expansions:
            rows = rows.withColumns(expansions)
        if not scope.statistics.empty:
            rows = rows.withColumn(Statistics.COLUMN, scope.statistics.table(documents).scalar())
        for test in late:
            rows = rows.filter(test)
        if scope.derived:
            rows = rows.withColumns(scope.derived)
        return rows, score

    def _scored_rows(self, scored: bool = True, factors: bool = True) -> DataFrame:
        scope = self._scope()
        rows, score = self._filtered(scope, scored)
        if self._random is not None:
            score = scoring.random_score(F.col(self.id), self._random)
        for factor in self._factors if scored and factors else []:
            score = score * factor
        inner = {
            c.inner_hits: F.slice(c.matching(scope), 1, c.inner_size)
            for c in self.conditions
            if isinstance(c, C.Nested) and c.inner_hits
        }
        rows = rows.withColumns({**inner, "_score": score})
        for i, extra in enumerate(self._phase_scores):
            rows = rows.withColumn(f"__phase{i}", extra)
        keep = [*self.df.columns, *inner, "_score", *[f"__phase{i}" for i in range(len(self._phase_scores))]]
        return rows.select(*[F.col(f"`{c}`") for c in keep])

    def matched(self) -> DataFrame:
        """Every matching row, unscored and unsorted."""
        if self._held is not None:
            return self._held.select(*[F.col(f"`{c}`") for c in self._held.columns if c in self.df.columns])
        if not self._retrievers:
            rows, _ = self._filtered(self._scope(), False)
            return rows.select(*[F.col(f"`{c}`") for c in self.df.columns])
        return self._retrieved().select(*self.df.columns)

    def _retrieved(self) -> DataFrame:
        """Rows of the fused lists, with inner hits where the conditions matched.

        Conditions are one more list, in random order if asked for; without conditions the retrieved
        rows are.  Factors multiply the fused score.
        """
        lists = [(run(), weight) for run, weight, _ in self._retrievers]
        phases, self._phases = self._phases, []
        inner = []
        if self.conditions:
            matched = self._scored_rows(factors=False)
            inner = [c for c in matched.columns if c not in self.df.columns and c != "_score"]
            lists.append((matched.select(self.id, "_score"), 1.0))
        self._phases = phases
        fused = lists[0][0].select(self.id, "_score") if len(lists) == 1 else fusion.weighted(lists, self.id)
        rows = self.df.join(fused, self.id)
        if inner:
            rows = rows.join(matched.select(self.id, *[F.col(f"`{c}`") for c in inner]), self.id, "left")
        score = F.col("_score")
        if self._random is not None and not self.conditions:
            score = scoring.random_score(F.col(self.id), self._random)
        for factor in self._factors:
            score = score * factor
        return rows.withColumn("_score", score)

    def _rescoring_allowed(self) -> bool:
        return not self._retrievers or bool(self.conditions) or any(q for _, _, q in self._retrievers)

    def _wants_score(self) -> bool:
        if self._random is not None and not self._sorts:
            return False
        return (
            not self._sorts
            or any(k.field == "_score" for k in self._sorts)
            or self._min_score is not None
            or bool(self._phases)
        )

    def _base_rows(self) -> DataFrame:
        """Every match with its score and what rescoring needs."""
        if self._held is not None:
            return self._held
        return self._retrieved() if self._retrievers else self._scored_rows(self._wants_score())

    def _needed(self, rows: DataFrame) -> DataFrame:
        """The matches with the fields that their page and the aggregations read."""
        shown = set()
        if self._limit != 0:
            shown = set(self._include) or set(self.df.columns) - set(self._exclude)
            shown |= {k.field for k in self._sorts} | set(self._highlight.fields)
        names = {self.id, *shown, *(self._aggregated or ())}
        if self._aggregated is None or any("*" in n for n in names):
            return rows
        names |= {n.split(".")[0] for n in names}
        return rows.select(*[F.col(f"`{c}`") for c in rows.columns if c in names or c not in self.df.columns])

    def _all_hits(self) -> tuple[DataFrame, list[paging.SortKey]]:
        rows = self._base_rows()
        if self._retrievers:
            if self._phases and self._rescoring_allowed():
                if self._limit is not None and not self._sorts and not self._after:
                    # rows below the largest window and the page are neither rescored nor shown
                    most = max(self._limit * max(self._page, 1), *[w for w, _ in self._phases])
                    rows = self._phase_columns(fusion.top_of(rows, self.id, most).drop("rank"), True)
                else:
                    rows = self._phase_columns(rows, False)
        keys = list(self._sorts)
        tier = False
        if self._phases and self._rescoring_allowed():
            phases = [(window, F.col(f"__phase{i}")) for i, (window, _) in enumerate(self._phases)]
            if self._limit is not None and not keys and not self._after:
                rows = fusion.rescored_top(rows, self.id, phases, self._limit * max(self._page, 1))
            else:
                for window, extra in phases:
                    rows = fusion.rescored(rows, self.id, window, extra)
            tier = True
        if self._min_score is not None:
            rows = rows.filter(F.col("_score") >= self._min_score)
        if not keys and (self._limit is not None or self._after):
            # Relevance order only where a limit makes it a top-k; nobody sorts a whole table unasked.
            keys = [paging.SortKey("_score", True)]
            if tier:
                keys = [paging.SortKey("_tier", True), *keys]
        return rows, paging.with_tie_break(keys, self.id) if keys else []

    def _phase_columns(self, rows: DataFrame, few: bool) -> DataFrame:
        """Second-query scores of retrieved rows, with statistics of the whole table; ``few`` ones are broadcast."""
        inner = self._inner()
        inner._phases = self._phases
        wide, _ = inner._filtered(inner._scope(), True)
        names = [f"__phase{i}" for i in range(len(self._phases))]
        asked = rows.select(self.id)
        scores = wide.join(F.broadcast(asked) if few else asked, self.id, "left_semi")
        return rows.join(scores.select(self.id, *[s.alias(n) for s, n in zip(inner._phase_scores, names)]), self.id)

    def hits(self) -> DataFrame:
        """The page of hits: records, ``_score``, inner hits and highlights.

        Without a limit every match is returned, ordered only if ``sort`` was called.  With explicit
        sorts the score is computed only where a sort, a cut or a rescore phase uses it.
        """
        rows, keys = self._all_hits()
        if self._after:
            rows = paging.after(rows, keys, self._after)
        if keys:
            rows = paging.ordered(rows, keys)
        rows = paging.page(rows, self._limit, self._page)
        extras = [c for c in rows.columns if c not in self.df.columns and not c.startswith("__") and c != "_tier"]
        if self._highlight.fields:
            rows, marked = self._highlighted(rows)
            extras += marked
        rows = rows.select(*[F.col(f"`{c}`") for c in [*[c for c in self.df.columns if c in rows.columns], *extras]])
        return select_fields(rows, self._include, self._exclude, always=tuple(extras))

    def _highlighted(self, rows: DataFrame) -> tuple[DataFrame, list[str]]:
        """Fragments for the rows of the page only."""
        scope = self._scope()
        names = []
        for name, options in self._highlight.fields.items():
            analyzer, col = scope.analyzer(name), F.col(name)
            parts = self._accepting(scope, name)
            column = f"highlight_{name.replace('.', '_')}"
            chosen = {**self._highlight.options, **options}

            def marked(text, analyzed, words, parts=parts, chosen=chosen):
                return H.highlight(text, analyzed, words, lambda t: C.any_of([p.accepts(t) for p in parts]), **chosen)

            if isinstance(rows.select(col.alias("c")).schema["c"].dataType, T.ArrayType):
                # Several texts: the fragments of each, in their order.
                rows = rows.withColumn("__texts", F.filter(col, lambda t: t.isNotNull()))
                rows = rows.withColumn("__analyzed", analyzer.token_lists(F.col("__texts")))
                rows = rows.withColumn("__words", F.transform("__texts", analyzer.words))
                each = F.transform(F.arrays_zip("__texts", "__analyzed", "__words"), lambda e: marked(e["__texts"], e["__analyzed"], e["__words"]))
                found = F.coalesce(F.flatten(each), F.array().cast("array<string>"))
                if chosen.get("number_of_fragments", H.FRAGMENTS):
                    found = F.slice(found, 1, chosen.get("number_of_fragments", H.FRAGMENTS))
                rows = rows.withColumn(column, found).drop("__texts", "__analyzed", "__words")
                names.append(column)
                continue
            rows = rows.withColumn("__analyzed", scope.analyzed(name)).withColumn("__words", analyzer.words(col))
            found = marked(col, F.col("__analyzed"), F.col("__words"))
            rows = rows.withColumn(column, found).drop("__analyzed", "__words")
            names.append(column)
        return rows, names

    def _phase_conditions(self) -> list:
        return [c for _, branch in self._phases for c in branch]

    def _accepting(self, scope: Scope, field: str, conditions: list | None = None, negated: bool = False) -> list:
        """What the text conditions on a field look for; with ``negated`` also what must not be there."""
        out: list = []

        def walk(condition):
            if isinstance(condition, C.NoneOf) and not negated:
                return
            if isinstance(condition, C.Group):
                for c in condition.children:
                    walk(c)
            elif getattr(condition, "field", None) != field:
                return
            elif isinstance(condition, C.Match):
                out.extend(p.test if isinstance(p, OneOf) else p for p in condition.parts(scope))
            elif isinstance(condition, C.Phrase):
                out.extend(p for _, p in condition.parts(scope))
            elif isinstance(condition, C.TokenPrefix):
                out.append(Prefix(condition.prefix.lower()))
            elif isinstance(condition, C.Term):
                out.append(Word(str(condition.value)))
            elif isinstance(condition, C.MoreLikeThis):
                out.extend(Word(w) for w in scope.analyzer(field).query(condition.like) if w)

        for condition in self.conditions if conditions is None else conditions:
            walk(condition)
        return out

    def find_many(self, once: bool = False) -> Result:
        """The page of hits, every aggregation and the total.

        Each is a plan of its own, which lets a filter reach the scan and a top-k keep few rows, but the
        search runs once for each that is used.  With ``once`` it runs a single time, now: the matches
        are written to the shared folder with the fields that are needed, and everything reads those until the result is closed.
        """
        if not once:
            aggs = {name: make(self.matched()) for name, make in self._aggs.items()}
            return Result(self.hits(), aggs, self.matched, self._track)
        before = set(staged())
        held = self._held = written(self._needed(self._base_rows()), "matched")
        try:
            aggs = {name: make(self.matched()) for name, make in self._aggs.items()}
            hits = self.hits()
        finally:
            self._held = None
        return Result(hits, aggs, lambda: held, self._track, [p for p in staged() if p not in before])

    def find_first(self):
        limit, self._limit = self._limit, 1
        try:
            return self.hits().head()
        finally:
            self._limit = limit

    def find_first_or_throw(self):
        row = self.find_first()
        if row is None:
            raise LookupError("no record matches the search")
        return row

    def count(self) -> int:
        """Matches of the conditions, whatever the sort, limit or aggregations."""
        return self.matched().count()
