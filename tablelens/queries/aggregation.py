"""Facets, term counts, histograms and custom aggregations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.operators import aggregations as A
from tablelens.plans.search import Search
from tablelens.queries import query
from tablelens.queries.filters import LINES, lined
from tablelens.sources.reader import read_table as read


def facet_sql(table: str, fields: dict[str, str], limit: int, where: str = "true") -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{label}' AS facet, {col}::VARCHAR AS key, count(*) AS count FROM {table} WHERE {where} GROUP BY 2"
        for label, col in fields.items()
    )
    return f"""WITH c AS ({counts}), r AS (SELECT *, row_number() OVER (PARTITION BY facet ORDER BY count DESC, key) AS n,
        sum(count) OVER (PARTITION BY facet) AS total FROM c WHERE key IS NOT NULL)
      SELECT facet, key, count, 0::BIGINT AS doc_count_error,
        (total - sum(count) OVER (PARTITION BY facet))::BIGINT AS other_count FROM r WHERE n <= {limit}"""


FLAGSHIP_SQL = facet_sql(
    "orders", {"o_orderpriority": "o_orderpriority"}, 25,
    "o_orderstatus = 'F' AND o_totalprice BETWEEN 50000 AND 150000",
)


@query("filtered_facets", FLAGSHIP_SQL)
def filtered_facets(spark, d):
    search = Search(read(spark, d, "orders"), "o_orderkey").term("o_orderstatus", "F")
    search.range("o_totalprice", "between", [50000, 150000]).include_facets(["o_orderpriority"])
    return search.find_many().aggs["facets"]


PART_FACETS = {"brand": "p_brand", "type": "p_type", "name": "p_name", "size": "p_size"}


@query("facets_with_other", facet_sql("part", PART_FACETS, 5))
def _(spark, d):
    return Search(read(spark, d, "part"), "p_partkey").include_facets(PART_FACETS, limit=5).find_many().aggs["facets"]


LINE_FACETS = {f: f for f in ("l_returnflag", "l_linestatus", "l_suppkey", "l_linenumber")}


@query("facets_many_rows", facet_sql("lineitem", LINE_FACETS, 25))
def _(spark, d):
    return A.facets(read(spark, d, "lineitem"), list(LINE_FACETS))


@query(
    "facets_nested",
    f"""WITH c AS (SELECT 'kind' AS facet, kind AS key, count(DISTINCT doc_id) AS count FROM {LINES} GROUP BY kind
          UNION ALL SELECT 'lang', lang, count(*) FROM documents GROUP BY lang)
       SELECT facet, key, count, 0::BIGINT AS doc_count_error, 0::BIGINT AS other_count FROM c""",
)
def _(spark, d):
    return A.facets(lined(spark, d), {"kind": "lines.kind", "lang": "lang"})


@query("facet_approximate", "SELECT l_linenumber::VARCHAR AS key, count(*) AS count FROM lineitem GROUP BY 1")
def _(spark, d):
    """Fewer values than counters: the sketch is exact."""
    return A.approximate_facet(read(spark, d, "lineitem"), "l_linenumber", 25)


@query("facet_approximate_many")
def _(spark, d):
    return A.approximate_facet(read(spark, d, "lineitem"), "l_suppkey", 25)


@query(
    "term_counts",
    "SELECT event_type AS key, count(*) AS count FROM events WHERE event_type <> 'error' GROUP BY 1 ORDER BY count DESC, key LIMIT 3",
)
def _(spark, d):
    search = Search(read(spark, d, "events"), "event_id").aggregate_term("event_type", 3, exclude=["error"])
    return search.find_many().aggs["event_type"]


@query("term_counts_by_key", "SELECT p_brand AS key, count(*) AS count FROM part GROUP BY 1 ORDER BY key DESC LIMIT 10")
def _(spark, d):
    return A.term_counts(read(spark, d, "part"), "p_brand", 10, order={"_key": "desc"})


KEYS = {
    "year": "strftime(b, '%Y')",
    "quarter": "strftime(b, '%Y') || '-' || quarter(b)",
    "month": "strftime(b, '%Y-%m')",
    "week": "strftime(b, '%G-%V')",
    "day": "strftime(b, '%Y-%m-%d')",
    "hour": "strftime(b, '%Y-%m-%dT%H')",
    "minute": "strftime(b, '%Y-%m-%dT%H:%M')",
    "second": "strftime(b, '%Y-%m-%dT%H:%M:%S')",
}


def histogram_sql(table: str, field: str, interval: str, minutes: int = 0) -> str:
    return f"""SELECT {KEYS[interval]} AS key, b AS bucket, n AS count FROM (
      SELECT date_trunc('{interval}', {field} + INTERVAL ({minutes}) MINUTE)::TIMESTAMP AS b, count(*) AS n
      FROM {table} GROUP BY 1)"""


def _calendar(interval):
    @query(f"histogram_{interval}", histogram_sql("orders", "o_orderdate", interval))
    def _(spark, d):
        search = Search(read(spark, d, "orders"), "o_orderkey").date_histogram("o_orderdate", interval, "+00:00")
        return search.find_many().aggs["o_orderdate"]


def _fixed(interval):
    @query(f"histogram_{interval}", histogram_sql("events", "ts", interval))
    def _(spark, d):
        return A.date_histogram(read(spark, d, "events"), "ts", interval, 0)


for _interval in ("year", "quarter", "month", "week", "day"):
    _calendar(_interval)
for _interval in ("hour", "minute", "second"):
    _fixed(_interval)


@query("histogram_offset_text", histogram_sql("events", "ts", "day", 330))
def _(spark, d):
    return A.date_histogram(read(spark, d, "events"), "ts", "day", "+05:30")


@query("histogram_offset_minutes", histogram_sql("events", "ts", "hour", -210))
def _(spark, d):
    return A.date_histogram(read(spark, d, "events"), "ts", "hour", -210)


@query(
    "custom_aggregation",
    """SELECT l_returnflag, l_linestatus, sum(l_quantity) AS quantity, round(avg(l_discount), 6) AS discount,
         max(l_shipdate) AS last_ship, count(*) AS n
       FROM lineitem WHERE l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY 1, 2""",
)
def _(spark, d):
    search = Search(read(spark, d, "lineitem"), "l_orderkey").range("l_shipdate", "gte", "1996-01-01")
    search.aggregate(
        "by_status",
        ["l_returnflag", "l_linestatus"],
        quantity=F.sum("l_quantity"),
        discount=F.round(F.avg("l_discount"), 6),
        last_ship=F.max("l_shipdate"),
        n=F.count("*"),
    )
    return search.find_many().aggs["by_status"]
