"""The text index as tables: postings with positions, term statistics, field statistics."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablelens.functions.scoring import bm25, idf
from tablelens.functions.text import STANDARD, Analyzer
from tablelens.operators.batch_text import DIGITS, MARKER, best_per_query, query_terms
from tablelens.operators.grouping import TokenGroups
from tablelens.plans.runtime import fits_broadcast, join_sized, ship_package, written
from tablelens.plans.scope import field_type, joined

def text_fields(schema: T.StructType, keywords: tuple[str, ...] = (), prefix: str = "") -> list[str]:
    """Paths of every string field that is not a keyword, nested ones included."""
    out = []
    for f in schema.fields:
        path, kind = prefix + f.name, f.dataType
        inner = kind.elementType if isinstance(kind, T.ArrayType) else kind
        if isinstance(inner, T.StructType):
            out += text_fields(inner, keywords, path + ".")
        elif isinstance(inner, T.StringType) and path not in keywords:
            out.append(path)
    return out


def field_tokens(schema: T.StructType, field: str, analyzer: Analyzer) -> Column:
    if not isinstance(field_type(schema, field), T.ArrayType):
        return analyzer.tokens(F.col(field))
    return joined(analyzer.token_lists(F.col(field)))


def _grouped(markers: bool):
    def group(batches):
        for batch in batches:
            groups = TokenGroups(batch.column("tokens"), with_positions=True)
            lengths = groups.lengths.astype(np.int32)
            which = pa.array(groups.rows)
            yield pa.record_batch(
                {
                    "field": batch.column("field").take(which),
                    "term": groups.terms.take(pa.array(groups.codes)),
                    "id": batch.column("id").take(which),
                    "length": pa.array(lengths[groups.rows]),
                    "tf": pa.array(groups.counts.astype(np.int32)),
                    "positions": groups.position_lists(),
                }
            )
            if markers:
                present = pa.array(np.flatnonzero(lengths))
                yield pa.record_batch(
                    {
                        "field": batch.column("field").take(present),
                        "term": pa.array([MARKER] * len(present), pa.string()),
                        "id": batch.column("id").take(present),
                        "length": pa.array(lengths).take(present),
                        "tf": pa.array(np.zeros(len(present), dtype=np.int32)),
                        "positions": pa.array([[]] * len(present), pa.list_(pa.int32())),
                    }
                )

    return group


def postings(df: DataFrame, row_id: str, fields: dict[str, Analyzer], markers: bool = False) -> DataFrame:
    """``(field, term, id, length, tf, positions)`` of every text field in one pass, without a shuffle.

    With ``markers``, each non-empty document also yields one row with an empty term and its length.
    """
    ship_package()
    names = {f: f"__t{i}" for i, f in enumerate(fields)}
    # A column per field first: analyzers that run in Python cannot enter an array directly.
    own = df.select(
        F.col(row_id).alias("id"), *[field_tokens(df.schema, f, a).alias(names[f]) for f, a in fields.items()]
    )
    tagged = F.array(*[F.struct(F.lit(f).alias("field"), F.col(n).alias("tokens")) for f, n in names.items()])
    rows = own.select("id", F.explode(tagged).alias("f")).select("id", "f.field", "f.tokens")
    id_type = rows.schema["id"].dataType.simpleString()
    return rows.filter(F.col("tokens").isNotNull()).mapInArrow(
        _grouped(markers), f"field string, term string, id {id_type}, length int, tf int, positions array<int>"
    )


def term_statistics(rows: DataFrame) -> DataFrame:
    found = rows.filter(F.col("term") != MARKER)
    return found.groupBy("field", "term").agg(F.count("*").alias("df"), F.sum("tf").alias("cf"))


def field_statistics(rows: DataFrame) -> DataFrame:
    """From the marker rows: documents and average length per field."""
    marked = rows.filter(F.col("term") == MARKER)
    return marked.groupBy("field").agg(F.count("*").alias("documents"), F.avg("length").alias("average"))


#: Edit distances that the table of deletions answers, and letters of a term from which on it is looked for in the vocabulary.
SPELLING_DISTANCE, SPELLING_LENGTH = 2, 40


def deletions(term: Column, most: int) -> Column:
    """The term and all that is left of it after up to ``most`` deleted letters."""

    def once(form: Column) -> Column:
        places = F.filter(F.sequence(F.lit(1), F.greatest(F.char_length(form), F.lit(1))), lambda i: i <= F.char_length(form))
        return F.transform(places, lambda i: F.concat(F.substring(form, 1, i - 1), F.substring(form, i + 1, F.char_length(form))))

    found = last = F.array(term)
    for _ in range(most):
        last = F.array_distinct(F.flatten(F.transform(last, once)))
        found = F.concat(found, last)
    return F.array_distinct(found)


def spelling_table(terms: DataFrame) -> DataFrame:
    """(field, form, term, df): each term under itself and its forms with one and two letters less.

    Two words within an edit distance of d have a form in common that lacks at most d letters of each.
    Longer terms than SPELLING_LENGTH, of which there are few, are only under their own first letters.
    """
    short = F.char_length("term") <= SPELLING_LENGTH
    forms = F.when(short, deletions(F.col("term"), SPELLING_DISTANCE)).otherwise(F.array(F.lit(LONG_TERM)))
    return terms.select("field", F.explode(forms).alias("form"), "term", "df")


#: Stands for the form of long terms; no analyzer gives such a term.
LONG_TERM = "\x00long"


#: Share of a field's documents from which on a term is frequent; there are at most (distinct terms of a document) / share of those.
FREQUENT = 0.05


def neighbours(rows: DataFrame) -> DataFrame:
    """(field, first, second, id, length, tf, positions) of terms that stand side by side; ``positions`` are the first one's."""
    at = rows.select("field", "id", "length", "term", F.explode("positions").alias("at"))
    document = Window.partitionBy("field", "id").orderBy("at")
    after = at.withColumn("next", F.lead(F.struct("at", "term")).over(document))
    beside = after.filter(F.col("next.at") == F.col("at") + 1)
    # rows of a document lie together already
    found = beside.groupBy("field", "id", F.col("term").alias("first"), F.col("next.term").alias("second"))
    lists = found.agg(F.max("length").alias("length"), F.array_sort(F.collect_list("at")).alias("positions"))
    return lists.select("field", "first", "second", "id", "length", F.size("positions").alias("tf"), "positions")


class TextIndex:
    """Postings sorted by field, term and id, with their statistics.

    Files are cut by range over (field, term, id): a frequent term is spread over many files, and a
    search for a few terms reads only the row groups whose ranges hold them.
    """

    def __init__(
        self, postings: DataFrame, terms: DataFrame, fields: DataFrame, analyzers: dict[str, Analyzer], spellings: DataFrame | None = None,
        pairs: DataFrame | None = None, frequent: DataFrame | None = None,
    ):
        self.postings, self.terms, self.fields, self.analyzers = postings, terms, fields, analyzers
        self.spellings, self.pairs, self.frequent = spellings, pairs, frequent

    @classmethod
    def write(cls, df: DataFrame, row_id: str, fields: dict[str, Analyzer], folder: str, files: int | None = None):
        spark = df.sparkSession
        rows = written(postings(df, row_id, fields, markers=True), "postings")
        keys = ["field", "term", "id"]
        held = rows.filter(F.col("term") != MARKER)
        ranged = held.repartitionByRange(files, *keys) if files else held.repartitionByRange(*keys)
        ranged.sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{folder}/postings")
        stored = spark.read.parquet(f"{folder}/postings")
        term_statistics(stored).repartitionByRange("field", "term").sortWithinPartitions("field", "term").write.mode(
            "overwrite"
        ).parquet(f"{folder}/terms")
        field_statistics(rows).write.mode("overwrite").parquet(f"{folder}/fields")
        return cls.open(spark, folder, fields)

    def with_spellings(self, folder: str) -> TextIndex:
        """The index with a stored table of deletions, so that fuzzy words read the terms near them and not the vocabulary."""
        held = spelling_table(self.terms.select("field", "term", "df"))
        held.repartitionByRange("field", "form").sortWithinPartitions("field", "form").write.mode("overwrite").parquet(f"{folder}/spellings")
        spellings = self.terms.sparkSession.read.parquet(f"{folder}/spellings")
        return TextIndex(self.postings, self.terms, self.fields, self.analyzers, spellings, self.pairs, self.frequent)

    def with_pairs(self, folder: str, share: float = FREQUENT) -> TextIndex:
        """The index with stored lists of neighbouring frequent terms, so that a phrase of them reads no list of a single one.

        A term is frequent in a field when at least ``share`` of its documents have it.
        """
        spark = self.terms.sparkSession
        sizes = self.fields.select("field", "documents")
        often = self.terms.join(F.broadcast(sizes), "field").filter(F.col("df") >= share * F.col("documents")).select("field", "term")
        often.coalesce(1).write.mode("overwrite").parquet(f"{folder}/frequent")
        frequent = spark.read.parquet(f"{folder}/frequent")
        rows = join_sized(self.postings, frequent, ["field", "term"], fits_broadcast(frequent))
        found = written(neighbours(rows), "pairs")
        keys = ["field", "first", "second", "id"]
        found.repartitionByRange(*keys).sortWithinPartitions(*keys).write.mode("overwrite").parquet(f"{folder}/pairs")
        pairs = spark.read.parquet(f"{folder}/pairs")
        return TextIndex(self.postings, self.terms, self.fields, self.analyzers, self.spellings, pairs, frequent)

    def frequent_of(self, field: str, words: list[str]) -> set[str]:
        """Which of the words the lists of pairs know."""
        if self.frequent is None or not words:
            return set()
        return {r["term"] for r in self.frequent.filter((F.col("field") == field) & F.col("term").isin(words)).collect()}

    @classmethod
    def open(cls, spark: SparkSession, folder: str, fields: dict[str, Analyzer]) -> "TextIndex":
        return cls(*(spark.read.parquet(f"{folder}/{part}") for part in ("postings", "terms", "fields")), fields)

    def _corpus(self, field: str) -> Column:
        return self.fields.filter(F.col("field") == field).select(F.struct("documents", "average")).scalar()

    def _scored(self, rows: DataFrame, weights: DataFrame, field: str, keys: list[str], broadcast: bool) -> DataFrame:
        if broadcast:
            # Only the terms asked for are shuffled, once, by document; the pairs then stay in place.
            wanted = weights.select("term").distinct()
            rows = rows.join(F.broadcast(wanted), "term", "left_semi").repartition("id")
        pairs = join_sized(rows, weights, "term", broadcast).withColumn("corpus", self._corpus(field))
        part = bm25(F.col("tf").cast("double"), F.col("length"), F.col("corpus.average"), F.col("weight"))
        return pairs.groupBy(*keys, "id").agg(F.round(F.sum(part), DIGITS).alias("_score"), F.count("*").alias("matched"))

    def match(self, field: str, phrase: str, operator: str = "or") -> DataFrame:
        """``(id, _score)`` of the documents with any or all words; reads only those words' postings."""
        words = list(dict.fromkeys(w for w in self.analyzers.get(field, STANDARD).query(phrase) if w))
        held = (F.col("field") == field) & F.col("term").isin(words)
        weights = self.terms.filter(held).withColumn("corpus", self._corpus(field))
        weights = weights.select("term", idf(F.col("corpus.documents"), F.col("df")).alias("weight"))
        # One row per word of the phrase.
        scored = self._scored(self.postings.filter(held), weights, field, [], True)
        if operator.lower() == "and":
            scored = scored.filter(F.col("matched") == len(words))
        return scored.select("id", "_score")

    def phrase(self, field: str, phrase: str) -> DataFrame:
        """``(id, tf)``: documents where the words stand in exactly this order, and how often."""
        kept = [(i, w) for i, w in enumerate(self.analyzers.get(field, STANDARD).query(phrase)) if w]
        words = list(dict.fromkeys(w for _, w in kept))
        rows = self.postings.filter((F.col("field") == field) & F.col("term").isin(words))
        found = rows.groupBy("id").agg(
            *[F.first(F.when(F.col("term") == w, F.col("positions")), ignorenulls=True).alias(f"p{n}") for n, w in enumerate(words)]
        )
        starts = [
            F.transform(F.col(f"p{words.index(w)}"), lambda p: p - gap) for gap, w in kept
        ]
        common = reduce(F.array_intersect, starts)
        return found.select("id", F.size(common).alias("tf")).filter(F.col("tf") > 0)

    def search(self, queries: DataFrame, query_id: str, text: str, field: str, k: int = 10, digits: int = DIGITS) -> DataFrame:
        """``(query, id, _score, rank)``: the k best documents of every query."""
        asked = query_terms(queries, query_id, text, self.analyzers.get(field, STANDARD))
        small = fits_broadcast(asked)
        known = self.terms.filter(F.col("field") == field).select("term", "df")
        # The vocabulary may be large; only the terms asked for are joined to the queries.
        known = join_sized(known, asked.select("term").distinct(), "term", small)
        weights = join_sized(asked, known, "term", small).withColumn("corpus", self._corpus(field))
        weights = weights.select(query_id, "term", idf(F.col("corpus.documents"), F.col("df")).alias("weight"))
        rows = self.postings.filter(F.col("field") == field).select("term", "id", "length", "tf")
        scored = self._scored(rows, weights, field, [query_id], small)
        return best_per_query(scored, "id", query_id, k, digits)

    def _spelled(self, field: str, word: str, distance: int) -> DataFrame:
        """Terms among which are all within the distance: (field, term, df)."""
        if self.spellings is None or distance > SPELLING_DISTANCE or len(word) > 2 * SPELLING_LENGTH:
            return self.terms.filter(F.col("field") == field).select("field", "term", "df")
        forms = {word}
        last = forms
        for _ in range(distance):
            last = {w[:i] + w[i + 1 :] for w in last for i in range(len(w))}
            forms = forms | last
        if len(word) + distance > SPELLING_LENGTH:
            forms = forms | {LONG_TERM}
        asked = self.spellings.sparkSession.createDataFrame([(f,) for f in sorted(forms)], "form string")
        # the range lets the scan skip row groups; the forms are at most a few thousand
        held = self.spellings.filter((F.col("field") == field) & F.col("form").between(min(forms), max(forms)))
        return held.join(F.broadcast(asked), "form", "left_semi").select("field", "term", "df").distinct()

    def near_spellings(self, field: str, word: str, distance: int, prefix_length: int = 0, max_expansions: int | None = None):
        """Vocabulary terms within an edit distance, nearest and most frequent first."""
        terms = self._spelled(field, word, distance).filter(F.col("term").startswith(word[:prefix_length]))
        near = terms.withColumn("distance", F.levenshtein("term", F.lit(word), distance)).filter(F.col("distance") >= 0)
        ordered = near.orderBy("distance", F.desc("df"), "term")
        return ordered.limit(max_expansions) if max_expansions else ordered
