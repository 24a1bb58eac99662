"""Conditions, projections and nested conditions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.functions.text import STANDARD
from tablelens.operators.wildcards import WildcardIndex
from tablelens.plans.runtime import new_path
from tablelens.plans.search import Search
from tablelens.queries import SQL, query
from tablelens.sources.reader import read_table as read
from tablelens.sources.reader import spread


def labelled(spark, d):
    """Documents without their text, with labels where there are any, so that nulls occur."""
    return read(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").join(
        read(spark, d, "labels"), "doc_id", "left"
    )


LABELLED = """(SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
 FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""


def lined(spark, d):
    """Documents with their lines as an array of structs, derived within each row."""
    def line(text, number):
        size = F.length(text)
        kind = F.when(size == 0, "empty").when(size < 80, "short").when(size < 400, "medium").otherwise("long")
        return F.struct(number.alias("line"), size.alias("size"), kind.alias("kind"), text.alias("text"))

    rows = spread(read(spark, d, "documents"), "doc_id")
    return rows.select("doc_id", "lang", F.transform(F.split("text", "\n"), line).alias("lines"))


# One row per line of every document, as above.
LINES = """(SELECT doc_id, lang, line, length(text) AS size, text, CASE WHEN length(text) = 0 THEN 'empty'
    WHEN length(text) < 80 THEN 'short' WHEN length(text) < 400 THEN 'medium' ELSE 'long' END AS kind
  FROM (SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS text,
          generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line FROM documents))"""


def unscored(search):
    return search.hits().drop("_score")


@query("match_all", "SELECT r_regionkey, r_name, 1.0::DOUBLE AS _score FROM region")
def _(spark, d):
    return Search(read(spark, d, "region"), "r_regionkey").hits()


@query(
    "fields_included_and_excluded",
    "SELECT o_orderkey, o_orderstatus, o_orderpriority, o_totalprice FROM orders WHERE o_orderstatus = 'F'",
)
def _(spark, d):
    search = Search(read(spark, d, "orders"), "o_orderkey").term("o_orderstatus", "F")
    return unscored(search.fields(["o_order*", "o_totalprice"]).exclude_fields(["o_orderdate"]))


@query(
    "fields_nested",
    f"""SELECT doc_id, string_agg(line || ':' || size, ',' ORDER BY line) AS lines FROM {LINES} GROUP BY doc_id""",
)
def _(spark, d):
    rows = unscored(Search(lined(spark, d), "doc_id").source_excludes(["lang", "lines.text", "lines.k*"]))
    pairs = F.transform("lines", lambda t: F.concat_ws(":", *[t[f].cast("string") for f in ("line", "size")]))
    return rows.select("doc_id", F.array_join(pairs, ",").alias("lines"))


@query("term_exact", "SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def _(spark, d):
    search = Search(read(spark, d, "orders"), "o_orderkey")
    return unscored(search.term("o_orderstatus", "F").term("o_orderpriority", "1-URGENT"))


@query(
    "term_in_array",
    """SELECT conv_id FROM (SELECT conv_id, list(role) AS roles FROM conversations GROUP BY conv_id)
       WHERE list_contains(roles, 'system')""",
)
def _(spark, d):
    rows = read(spark, d, "conversations").groupBy("conv_id").agg(F.collect_set("role").alias("roles"))
    return unscored(Search(rows, "conv_id").term("roles", "system").fields(["conv_id"]))


@query(
    "term_on_text_token",
    r"SELECT doc_id FROM documents WHERE list_contains(regexp_extract_all(lower(text), '[\p{L}\p{N}]+'), 'thing')",
)
def _(spark, d):
    rows = read(spark, d, "documents")
    from tablelens.functions.text import STANDARD

    return unscored(Search(rows, "doc_id", {"text": STANDARD}).term("text", "thing").fields(["doc_id"]))


@query("range_half_open", "SELECT * FROM lineitem WHERE l_quantity > 45 AND l_discount <= 0.02")
def _(spark, d):
    rows = read(spark, d, "lineitem")
    return unscored(Search(rows, "l_orderkey").range("l_quantity", ">", 45).range("l_discount", "LTE", 0.02))


@query("range_between", "SELECT * FROM orders WHERE o_totalprice BETWEEN 50000 AND 150000")
def _(spark, d):
    return unscored(Search(read(spark, d, "orders"), "o_orderkey").range("o_totalprice", "between", [50000, 150000]))


@query(
    "range_between_one_sided",
    "SELECT * FROM orders WHERE o_totalprice >= 400000 AND o_orderdate <= TIMESTAMP '1997-01-01'",
)
def _(spark, d):
    search = Search(read(spark, d, "orders"), "o_orderkey").range("o_totalprice", "between", [400000, None])
    search.range("o_orderdate", "between", [None, "1997-01-01"]).range("o_custkey", "between", [None, None])
    return unscored(search)


@query("exists_label", f"SELECT * FROM {LABELLED} WHERE quality IS NOT NULL")
def _(spark, d):
    return unscored(Search(labelled(spark, d), "doc_id").exists("quality"))


@query("missing_label", f"SELECT * FROM {LABELLED} WHERE quality IS NULL")
def _(spark, d):
    return unscored(Search(labelled(spark, d), "doc_id").must_not(lambda q: q.exists("quality").exists("no_such_field")))


@query(
    "none_of_keeps_nulls",
    f"SELECT * FROM {LABELLED} WHERE quality IS DISTINCT FROM 1 AND coalesce(n_chars <= 2000, true)",
)
def _(spark, d):
    search = Search(labelled(spark, d), "doc_id")
    return unscored(search.must_not(lambda q: q.term("quality", 1).range("n_chars", "gt", 2000)))


@query(
    "or_group",
    """SELECT * FROM orders WHERE o_orderpriority = '1-URGENT'
       OR (o_totalprice > 300000 AND o_orderstatus = 'O')""",
)
def _(spark, d):
    search = Search(read(spark, d, "orders"), "o_orderkey")
    return unscored(
        search.should(
            [
                lambda q: q.term("o_orderpriority", "1-URGENT"),
                lambda q: q.range("o_totalprice", "gt", 300000).term("o_orderstatus", "O"),
                lambda q: q,
            ]
        )
    )


AT_LEAST = f"""SELECT * FROM {LABELLED} WHERE
  coalesce(quality = 1, false)::INT + coalesce(lang = 'en', false)::INT
  + coalesce(n_chars > 1000, false)::INT + coalesce(toxic = 0, false)::INT >= 2"""


def _four(search, minimum):
    return unscored(
        search.should(
            [
                lambda q: q.term("quality", 1),
                lambda q: q.term("lang", "en"),
                lambda q: q.range("n_chars", "gt", 1000),
                lambda q: q.term("toxic", 0),
            ],
            minimum_should_match=minimum,
        )
    )


@query("or_group_at_least_two", AT_LEAST)
def _(spark, d):
    return _four(Search(labelled(spark, d), "doc_id"), 2)


@query("or_group_half", AT_LEAST)
def _(spark, d):
    return _four(Search(labelled(spark, d), "doc_id"), "50%")


@query(
    "terms_set_fixed",
    r"""SELECT doc_id FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS t FROM documents)
       WHERE list_contains(t, 'thing')::INT + list_contains(t, 'ther')::INT + list_contains(t, 'only')::INT >= 2""",
)
def _(spark, d):
    from tablelens.functions.text import word_tokens

    rows = read(spark, d, "documents").select("doc_id", word_tokens(F.col("text")).alias("tags"))
    search = Search(rows, "doc_id").terms_set("tags", ["thing", "ther", "only"], "least(num_terms, 2)")
    return unscored(search.fields(["doc_id"]))


@query(
    "terms_set_from_column",
    """SELECT conv_id FROM (SELECT conv_id, list(DISTINCT role) AS roles, max(turn) AS last_turn
         FROM conversations GROUP BY conv_id)
       WHERE list_contains(roles, 'user')::INT + list_contains(roles, 'assistant')::INT
         + list_contains(roles, 'system')::INT >= least(3, last_turn)""",
)
def _(spark, d):
    rows = read(spark, d, "conversations").groupBy("conv_id")
    rows = rows.agg(F.collect_set("role").alias("roles"), F.max("turn").alias("last_turn"))
    search = Search(rows, "conv_id").terms_set("roles", ["user", "assistant", "system"], "least(num_terms, last_turn)")
    return unscored(search.fields(["conv_id"]))


@query("raw_condition", "SELECT * FROM lineitem WHERE l_extendedprice * (1 - l_discount) > 90000 AND l_tax < 0.03")
def _(spark, d):
    search = Search(read(spark, d, "lineitem"), "l_orderkey")
    search.raw_condition(F.col("l_extendedprice") * (1 - F.col("l_discount")) > 90000)
    return unscored(search.raw_condition("l_tax < 0.03"))


@query("wildcard", "SELECT * FROM part WHERE p_name LIKE '%e% %' AND p_brand LIKE 'Brand#1_'")
def _(spark, d):
    return unscored(Search(read(spark, d, "part"), "p_partkey").wildcard("p_name", "*e* *").wildcard("p_brand", "Brand#1?"))


@query("wildcard_indexed", SQL["wildcard"])
def _(spark, d):
    """By stored pieces of the values; a pattern without three fixed characters checks the distinct values."""
    rows = read(spark, d, "part")
    for field, pattern in (("p_name", "*e* *"), ("p_brand", "Brand#1?")):
        index = WildcardIndex.write(read(spark, d, "part"), "p_partkey", field, new_path(spark, "wildcards"))
        rows = rows.join(index.matching_ids(pattern).withColumnRenamed("id", "p_partkey"), "p_partkey", "left_semi")
    return rows.select(*read(spark, d, "part").columns)


LATE_LONG = "line >= 1 AND size > 200"


def late_long(q):
    return q.range("lines.line", "gte", 1).range("lines.size", "gt", 200)


@query("nested_same_element", f"SELECT DISTINCT doc_id FROM {LINES} WHERE {LATE_LONG}")
def _(spark, d):
    return unscored(Search(lined(spark, d), "doc_id").nested("lines", late_long).fields(["doc_id"]))


@query("nested_unmapped_path", "SELECT doc_id FROM documents WHERE lang IN ('fr', 'de')")
def _(spark, d):
    search = Search(lined(spark, d), "doc_id")
    search.should(
        [
            lambda q: q.nested("no_such_path", lambda n: n.term("a", 1), ignore_unmapped=True),
            lambda q: q.term("lang", "fr"),
            lambda q: q.term("lang", "de"),
        ]
    )
    return unscored(search.fields(["doc_id"]))


@query(
    "nested_text",
    rf"""SELECT DISTINCT doc_id FROM {LINES}
        WHERE line >= 1 AND list_contains(regexp_extract_all(lower(text), '[\p{{L}}\p{{N}}]+'), 'thing')""",
)
def _(spark, d):
    search = Search(lined(spark, d), "doc_id")
    search.nested("lines", lambda q: q.range("lines.line", "gte", 1).match("lines.text", "thing"))
    return unscored(search.fields(["doc_id"]))


@query(
    "nested_inner_hits",
    f"""SELECT doc_id, line, size, text FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line) AS r
          FROM {LINES} WHERE {LATE_LONG}) WHERE r <= 3""",
)
def _(spark, d):
    search = Search(lined(spark, d), "doc_id").nested("lines", late_long, inner_hits="found")
    return search.hits().select("doc_id", F.explode_outer("found").alias("f")).select("doc_id", "f.line", "f.size", "f.text")


#: A customer's orders as short texts: status and priority, the other way round for even orders.
NOTE = """CASE WHEN o_orderkey % 2 = 0 THEN substr(o_orderpriority, 3) || ' ' || o_orderstatus
  ELSE o_orderstatus || ' ' || substr(o_orderpriority, 3) END"""


def noted(spark, d):
    """Customers with the notes of their orders as a multi-valued text."""
    notes = F.array_sort(F.collect_list(F.expr(NOTE)))
    return read(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer")).agg(notes.alias("notes"))


@query("phrase_over_values", "SELECT DISTINCT o_custkey AS customer FROM orders WHERE o_orderkey % 2 = 1 AND o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'")
def _(spark, d):
    """A phrase lies within one value: the last word of one and the first of the next are no neighbours."""
    found = Search(noted(spark, d), "customer", text={"notes": STANDARD})
    return unscored(found.match_phrase("notes", "f high").fields(["customer"]))


@query(
    "highlight_nested",
    f"""SELECT o_custkey AS customer, replace({NOTE}, 'URGENT', '<em>URGENT</em>') AS fragment FROM orders WHERE o_orderpriority = '1-URGENT'""",
)
def _(spark, d):
    """Fragments of each value of a multi-valued text."""
    found = Search(noted(spark, d), "customer", text={"notes": STANDARD}).match("notes", "urgent")
    found.highlight_field("notes", pre_tag="<em>", post_tag="</em>", number_of_fragments=1000)
    return found.hits().select("customer", F.explode("highlight_notes").alias("fragment"))


@query(
    "terms_set_named_column",
    """SELECT o_custkey AS customer FROM orders GROUP BY 1
       HAVING max((o_orderpriority = '1-URGENT')::INT) + max((o_orderpriority = '2-HIGH')::INT) >= least(2, count(*))""",
)
def _(spark, d):
    """``num_terms`` inside a longer column name stays as it is."""
    rows = read(spark, d, "orders").groupBy(F.col("o_custkey").alias("customer"))
    rows = rows.agg(F.collect_set("o_orderpriority").alias("priorities"), F.count("*").alias("num_terms_seen"))
    found = Search(rows, "customer").terms_set("priorities", ["1-URGENT", "2-HIGH"], "least(num_terms, num_terms_seen)")
    return unscored(found.fields(["customer"]))


def _nested_score(mode, expression):
    @query(
        f"nested_score_{mode}",
        f"""SELECT doc_id, round({expression}, 6) AS _score FROM (
              SELECT doc_id, 1.0 + CASE WHEN line >= 4 THEN 1.0 ELSE 0.0 END AS s
              FROM {LINES} WHERE size > 50) GROUP BY doc_id""",
    )
    def _(spark, d):
        search = Search(lined(spark, d), "doc_id")
        search.nested(
            "lines",
            lambda q: q.range("lines.size", "gt", 50).should(
                [lambda b: b.range("lines.line", "gte", 4), lambda b: b.exists("lines.nothing")], 0
            ),
            score_mode=mode,
        )
        return search.hits().select("doc_id", F.round("_score", 6).alias("_score"))


for _mode, _expression in {
    "avg": "avg(s)::DOUBLE", "sum": "sum(s)::DOUBLE", "min": "min(s)::DOUBLE", "max": "max(s)::DOUBLE", "none": "0.0::DOUBLE",
}.items():
    _nested_score(_mode, _expression)
