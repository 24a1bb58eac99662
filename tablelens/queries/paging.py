"""Sorting, paging, counting and result shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.plans.search import Search
from tablelens.queries import SQL, query
from tablelens.queries.filters import LABELLED, labelled, unscored
from tablelens.sources.reader import read_table as read


def orders(spark, d):
    return Search(read(spark, d, "orders"), "o_orderkey")


@query(
    "sort_top",
    "SELECT * FROM orders ORDER BY o_orderpriority DESC, o_totalprice ASC, o_orderkey LIMIT 100",
)
def _(spark, d):
    return unscored(orders(spark, d).sort([("o_orderpriority", "desc"), "o_totalprice"]).limit(100))


@query("sort_nulls_last", f"SELECT * FROM {LABELLED} ORDER BY quality DESC NULLS LAST, n_chars DESC, doc_id LIMIT 700")
def _(spark, d):
    return unscored(Search(labelled(spark, d), "doc_id").sort({"quality": "desc"}).sort("-n_chars").limit(700))


@query("page_three", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 50 OFFSET 100")
def _(spark, d):
    return unscored(orders(spark, d).sort("-o_totalprice").limit(50).page(3))


@query(
    "keyset_page",
    """SELECT * FROM orders WHERE o_orderpriority > '2-HIGH'
         OR (o_orderpriority = '2-HIGH' AND o_totalprice < 300000)
       ORDER BY o_orderpriority, o_totalprice DESC, o_orderkey LIMIT 40""",
)
def _(spark, d):
    search = orders(spark, d).sort("o_orderpriority").sort("o_totalprice", "desc")
    return unscored(search.search_after(["2-HIGH", 300000.0]).limit(40))


@query(
    "keyset_page_with_nulls",
    f"""SELECT * FROM {LABELLED} WHERE quality IS NULL OR quality < 1 OR (quality = 1 AND n_chars > 500)
        ORDER BY quality DESC NULLS LAST, n_chars, doc_id LIMIT 600""",
)
def _(spark, d):
    search = Search(labelled(spark, d), "doc_id").sort("-quality").sort("n_chars")
    return unscored(search.search_after([1, 500]).limit(600))


@query("count_matches", "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000")
def _(spark, d):
    search = orders(spark, d).term("o_orderstatus", "F").range("o_totalprice", "gt", 100000).sort("-o_totalprice")
    return spark.createDataFrame([(search.limit(3).count(),)], "n long")


@query("total_capped", "SELECT least(count(*), 1000) AS n FROM orders WHERE o_orderstatus <> 'P'")
def _(spark, d):
    search = orders(spark, d).must_not(lambda q: q.term("o_orderstatus", "P"))
    return spark.createDataFrame([(search.track_total_hits(1000).find_many().total(),)], "n long")


@query("first_match", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING' ORDER BY c_acctbal DESC, c_custkey LIMIT 1")
def _(spark, d):
    search = Search(read(spark, d, "customer"), "c_custkey").term("c_mktsegment", "BUILDING").sort("-c_acctbal")
    first = search.find_first()
    schema = read(spark, d, "customer").schema
    return spark.createDataFrame([] if first is None else [tuple(first[c] for c in schema.names)], schema)


@query(
    "hits_with_aggregations",
    """SELECT 'hit' AS part, o_orderkey::VARCHAR AS key, o_totalprice AS value FROM
         (SELECT * FROM orders WHERE o_orderstatus = 'O' ORDER BY o_totalprice DESC, o_orderkey LIMIT 10)
       UNION ALL SELECT 'facet', o_orderpriority, count(*)::DOUBLE FROM orders WHERE o_orderstatus = 'O' GROUP BY 2
       UNION ALL SELECT 'total', 'all', count(*)::DOUBLE FROM orders WHERE o_orderstatus = 'O'""",
)
def _(spark, d):
    search = orders(spark, d).term("o_orderstatus", "O").sort("-o_totalprice").limit(10)
    result = search.include_facets(["o_orderpriority"]).find_many()
    hits = result.hits.select(
        F.lit("hit").alias("part"), F.col("o_orderkey").cast("string").alias("key"), F.col("o_totalprice").alias("value")
    )
    facets = result.aggs["facets"].select(F.lit("facet").alias("part"), "key", F.col("count").cast("double").alias("value"))
    total = search.matched().agg(F.count("*").cast("double").alias("value"))
    return hits.unionByName(facets).unionByName(total.select(F.lit("total").alias("part"), F.lit("all").alias("key"), "value"))


@query("hits_with_aggregations_once", SQL["hits_with_aggregations"])
def _(spark, d):
    """The search runs a single time for all three."""
    search = orders(spark, d).term("o_orderstatus", "O").sort("-o_totalprice").fields(["o_orderkey", "o_totalprice"]).limit(10)
    result = search.include_facets(["o_orderpriority"]).find_many(once=True)
    hits = result.hits.select(
        F.lit("hit").alias("part"), F.col("o_orderkey").cast("string").alias("key"), F.col("o_totalprice").alias("value")
    )
    facets = result.aggs["facets"].select(F.lit("facet").alias("part"), "key", F.col("count").cast("double").alias("value"))
    total = spark.createDataFrame([("total", "all", float(result.total()))], "part string, key string, value double")
    return hits.unionByName(facets).unionByName(total)


@query("random_order", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P'")
def _(spark, d):
    return unscored(orders(spark, d).term("o_orderstatus", "P").sort_by_random(seed=11).fields(["o_orderkey"]))
