"""One query for each operator and the pipeline, on the registry."""

import re

import __spark_entry__ as entry


def test_names():
    names = list(entry.queries())
    assert [n for k in range(1, 14) for n in names if re.match(rf"op{k}_", n)] == [
        "op1_bpe_round_trip", "op2_exact_dedup", "op3_jaccard_join", "op4_substring_dedup", "op5_url_filter", "op6_chat_format",
        "op7_decontamination", "op8_html_text", "op9_quality", "op10_secrets", "op11_alignment", "op12_lexical_search", "op13_warc",
    ]
    assert "pipeline" in names
    assert {f"op{k}" for k in (2, 4, 5, 6, 7, 12, 13)} <= {n.split("_")[0] for n in entry.oracle_sql()}
