"""Highlighted fragments of a text, for the rows of a finished page."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tablelens.functions.atoms import bind
from tablelens.functions.text import WORD

# Fragments per field, characters per fragment, and the tag of a match.
FRAGMENTS, FRAGMENT_SIZE = 3, 150
OPEN_TAG, CLOSE_TAG = '<em class="hlt1">', "</em>"

_OPEN, _CLOSE = "\u0001", "\u0002"


def fragments(text: Column, size: int) -> Column:
    """Cut at white space into pieces of at most ``size`` characters; nothing is lost."""
    return F.regexp_extract_all(text, F.lit(rf"(?s).{{1,{size}}}(?:\s|$)|.{{{size}}}"), 0)


def _mark(piece: Column, pattern: Column, before: str, after: str) -> Column:
    """Bracket every word, tag the bracketed words that match, drop the other brackets."""
    words = F.regexp_replace(piece, rf"({WORD})", f"{_OPEN}$1{_CLOSE}")
    tagged = F.regexp_replace(words, pattern, F.lit(f"{before}$1{after}"))
    return F.translate(tagged, _OPEN + _CLOSE, "")


def highlight(
    text: Column,
    analyzed: Column,
    words: Column,
    accepted: Callable[[Column], Column],
    number_of_fragments: int = FRAGMENTS,
    fragment_size: int = FRAGMENT_SIZE,
    pre_tag: str = OPEN_TAG,
    post_tag: str = CLOSE_TAG,
) -> Column:
    """Up to ``number_of_fragments`` pieces with the most matches, best first, matches tagged.

    ``analyzed`` and ``words`` are aligned, so a match on a stem tags the word as written.
    ``number_of_fragments = 0`` returns the whole text as one piece.
    """
    pieces = F.array(text) if number_of_fragments == 0 else fragments(text, fragment_size)

    def matched_forms(both: Column) -> Column:
        hits = F.filter(F.arrays_zip(both["analyzed"], both["words"]), lambda w: accepted(w["analyzed"]))
        return F.array_distinct(F.transform(hits, lambda w: w["words"]))

    def marked(forms: Column) -> Column:
        either = F.array_join(forms, "|")
        pattern = F.concat(F.lit(f"(?iu){_OPEN}("), either, F.lit(f"){_CLOSE}"))
        numbered = F.transform(pieces, lambda piece, i: F.struct(piece.alias("text"), i.alias("at")))
        # A plain search first, so that words are bracketed only where a form occurs.
        likely = F.filter(numbered, lambda p: F.rlike(p["text"], F.concat(F.lit("(?iu)"), either)))
        tagged = F.transform(
            likely, lambda p: F.struct(_mark(p["text"], pattern, "\u0003", "\u0004").alias("text"), p["at"].alias("at"))
        )
        ranked = F.transform(
            F.filter(tagged, lambda p: p["text"].contains("\u0003")),
            lambda p: F.struct(
                (-F.length(F.regexp_replace(p["text"], "[^\u0003]", ""))).alias("matches"),
                p["at"].alias("at"),
                p["text"].alias("text"),
            ),
        )
        best = F.array_sort(ranked)
        if number_of_fragments:
            best = F.slice(best, 1, number_of_fragments)
        return F.transform(
            best,
            lambda p: F.replace(F.replace(p["text"], F.lit("\u0003"), F.lit(pre_tag)), F.lit("\u0004"), F.lit(post_tag)),
        )

    forms = bind(F.struct(analyzed.alias("analyzed"), words.alias("words")), matched_forms)
    none = F.array().cast("array<string>")
    return bind(forms, lambda f: F.when(F.size(f) > 0, marked(f)).otherwise(none))
