"""Scores that do not come from text alone: decay, factors, cuts and rescoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tablelens.plans.search import Search
from tablelens.queries import query
from tablelens.queries.text import CORPUS, PART, search
from tablelens.sources.reader import read_table as read

DAY = 86_400.0
_AGE = "greatest(abs(epoch(o_orderdate) - epoch(TIMESTAMP '1998-01-01')) - 5 * 86400.0, 0)"
_CURVES = {
    "gauss": f"exp({_AGE} * {_AGE} * ln(0.5) / (864000.0 * 864000.0))",
    "exp": f"exp({_AGE} * ln(0.5) / 864000.0)",
    "linear": f"greatest(1 - {_AGE} * 0.5 / 864000.0, 0)",
}


def _decay(kind):
    @query(
        f"decay_{kind}",
        f"SELECT o_orderkey, round({_CURVES[kind]}, 6) AS _score FROM orders WHERE o_orderstatus = 'F'",
    )
    def _(spark, d):
        found = Search(read(spark, d, "orders"), "o_orderkey").term("o_orderstatus", "F")
        hits = found.decay_function_score(kind, "o_orderdate", "1998-01-01", 10 * DAY, 5 * DAY, 0.5).hits()
        return hits.select("o_orderkey", F.round("_score", 6).alias("_score"))


for _kind in _CURVES:
    _decay(_kind)


@query(
    "decay_on_number",
    """SELECT p_partkey, round(exp(greatest(abs(p_size - 20) - 2, 0) * ln(0.3) / 5), 6) AS _score FROM part""",
)
def _(spark, d):
    hits = Search(read(spark, d, "part"), "p_partkey").decay_function_score("exp", "p_size", 20, 5.0, 2.0, 0.3).hits()
    return hits.select("p_partkey", F.round("_score", 6).alias("_score"))


@query(
    "field_value_factor",
    """SELECT doc_id, round(1.2::DOUBLE * coalesce(quality, 0.5), 6) AS _score
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def _(spark, d):
    rows = read(spark, d, "documents").join(read(spark, d, "labels"), "doc_id", "left")
    hits = Search(rows, "doc_id").field_value_factor("quality", 1.2, missing=0.5).hits()
    return hits.select("doc_id", F.round("_score", 6).alias("_score"))


CORPUS_WITH = f"WITH {CORPUS}"
_MATCHED = f"""{CORPUS}, m AS (SELECT doc_id, sum({PART}) AS s FROM f JOIN v USING (term), c
   WHERE term IN ('thing', 'only') GROUP BY doc_id)"""


@query("minimum_score", f"WITH {_MATCHED} SELECT doc_id, round(s, 6) AS _score FROM m WHERE s >= 2.5")
def _(spark, d):
    hits = search(spark, d).match("text", "thing only").min_score(2.5).hits()
    return hits.select("doc_id", F.round("_score", 6).alias("_score"))


_RESCORED = f"""WITH {_MATCHED},
      x AS (SELECT doc_id, sum({PART}) AS s2 FROM f JOIN v USING (term), c WHERE term = 'there' GROUP BY doc_id),
      y AS (SELECT doc_id, sum({PART}) AS s3 FROM f JOIN v USING (term), c WHERE term = 'than' GROUP BY doc_id),
      a1 AS (SELECT doc_id, s, row_number() OVER (ORDER BY s DESC, doc_id) <= 50 AS t1 FROM m),
      b1 AS (SELECT doc_id, t1, CASE WHEN t1 THEN s + coalesce(s2, 0) ELSE s END AS s FROM a1 LEFT JOIN x USING (doc_id)),
      a2 AS (SELECT doc_id, t1, s, row_number() OVER (ORDER BY t1 DESC, s DESC, doc_id) <= 25 AS t2 FROM b1),
      b2 AS (SELECT doc_id, t1::INT + t2::INT AS tier, CASE WHEN t2 THEN s + coalesce(s3, 0) ELSE s END AS s
             FROM a2 LEFT JOIN y USING (doc_id))
      SELECT doc_id, round(s, 6) AS _score FROM b2 ORDER BY tier DESC, s DESC, doc_id"""


def rescored(spark, d, limit):
    found = search(spark, d).match("text", "thing only")
    found.rescore(50, lambda q: q.match("text", "there")).rescore(25, lambda q: q.match("text", "than"))
    return found.limit(limit).hits().select("doc_id", F.round("_score", 6).alias("_score"))


@query("rescore_two_phases", f"{_RESCORED} LIMIT 60")
def _(spark, d):
    """A page that reaches past the windows."""
    return rescored(spark, d, 60)


@query("rescore_within_window", f"{_RESCORED} LIMIT 30")
def _(spark, d):
    """A page inside the first window needs one pass."""
    return rescored(spark, d, 30)


@query(
    "rescore_three_phases",
    f"""WITH z AS (SELECT * FROM ({_RESCORED.replace("SELECT doc_id, round(s, 6) AS _score FROM b2", "SELECT doc_id, tier, s FROM b2")})),
      k AS ({CORPUS_WITH} SELECT doc_id, sum({PART}) AS s4 FROM f JOIN v USING (term), c WHERE term = 'are' GROUP BY doc_id),
      a3 AS (SELECT doc_id, tier, s, row_number() OVER (ORDER BY tier DESC, s DESC, doc_id) <= 10 AS t3 FROM z),
      b3 AS (SELECT doc_id, tier + t3::INT AS tier, CASE WHEN t3 THEN s + coalesce(s4, 0) ELSE s END AS s FROM a3 LEFT JOIN k USING (doc_id))
      SELECT doc_id, round(s, 6) AS _score FROM b3 ORDER BY tier DESC, s DESC, doc_id LIMIT 60""",
)
def _(spark, d):
    found = search(spark, d).match("text", "thing only").rescore(50, lambda q: q.match("text", "there"))
    found.rescore(25, lambda q: q.match("text", "than")).rescore(10, lambda q: q.match("text", "are"))
    return found.limit(60).hits().select("doc_id", F.round("_score", 6).alias("_score"))


@query(
    "boolean_score",
    f"""WITH {_MATCHED}, t AS (SELECT doc_id, 1.0 + coalesce(s, 0) + CASE WHEN lang = 'en' THEN 1.0 ELSE 0 END AS s
          FROM documents LEFT JOIN m USING (doc_id) WHERE n_chars > 500 AND (s IS NOT NULL OR lang = 'en'))
       SELECT doc_id, round(s, 6) AS _score FROM t""",
)
def _(spark, d):
    found = search(spark, d).range("n_chars", "gt", 500).must_not(lambda q: q.term("source", "none"))
    found.should([lambda q: q.match("text", "thing only"), lambda q: q.term("lang", "en")])
    return found.hits().select("doc_id", F.round("_score", 6).alias("_score"))
