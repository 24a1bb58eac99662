"""Text analysis as column expressions.

An analyzed text is an array with one entry per word, in order.  A word the analyzer removes
leaves an empty string behind, so an entry's index is its position and phrases keep their gaps.
"""

from __future__ import annotations

import unicodedata
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tablelens.functions.porter import stem
from tablelens.plans.runtime import ship_package

WORD = r"[\p{L}\p{N}]+"

# The usual English stop words.
ENGLISH_STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "but", "by", "for", "if", "in", "into", "is",
    "it", "no", "not", "of", "on", "or", "such", "that", "the", "their", "then", "there",
    "these", "they", "this", "to", "was", "will", "with",
)

# Letters without a decomposition, and what they fold to.
LIGATURES = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th"}
SINGLE_FOLDS = {"ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ı": "i"}


def _fold_table() -> dict[str, str]:
    """Lower-case Latin letters whose canonical base is an ASCII letter."""
    table = dict(SINGLE_FOLDS)
    for code in range(0xC0, 0x250):
        ch = chr(code)
        base = unicodedata.normalize("NFD", ch)[0]
        if ch == ch.lower() and base != ch and base.isascii():
            table[ch] = base
    return table


FOLD_TABLE = _fold_table()
_FOLD_FROM, _FOLD_TO = "".join(FOLD_TABLE), "".join(FOLD_TABLE.values())


def fold(col: Column) -> Column:
    """Lower-case and strip accents (the keyword normalizer)."""
    out = F.translate(F.lower(col), _FOLD_FROM, _FOLD_TO)
    for ligature, plain in LIGATURES.items():
        out = F.replace(out, F.lit(ligature), F.lit(plain))
    return out


def fold_text(text: str) -> str:
    text = text.lower().translate(str.maketrans(FOLD_TABLE))
    for ligature, plain in LIGATURES.items():
        text = text.replace(ligature, plain)
    return text


def strip_chars(col: Column, chars: str) -> Column:
    """Character mapping before tokenizing: drop the given characters."""
    return F.translate(col, chars, "") if chars else col


def word_tokens(col: Column) -> Column:
    """Lower-cased runs of letters and digits, in order (splitting is faster than extracting)."""
    return F.array_remove(F.split(F.lower(col), r"[^\p{L}\p{N}]+"), "")


def _finish(token: str, stop: frozenset[str], stemmed: bool, folded: bool) -> str:
    if token in stop:
        return ""
    if stemmed:
        token = stem(token)
    return fold_text(token) if folded else token


def _rewrite_distinct(lists: pa.Array, rewrite) -> pa.Array:
    """Apply ``rewrite`` to the distinct strings of a list column and map them back."""
    codes = lists.flatten().dictionary_encode()
    renamed = pa.array([rewrite(t) for t in codes.dictionary.to_pylist()], pa.string())
    sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
    offsets = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
    mask = lists.is_null() if lists.null_count else None
    return pa.ListArray.from_arrays(offsets, renamed.take(codes.indices), mask=mask)


@dataclass(frozen=True)
class Analyzer:
    """Tokenize, lower-case, then optionally drop stop words, stem and fold, in that order."""

    stop: frozenset[str] = frozenset()
    stemmed: bool = False
    folded: bool = False
    dropped_chars: str = ""

    def words(self, col: Column) -> Column:
        """The words as written, lower-cased; aligned with :meth:`tokens`."""
        return word_tokens(strip_chars(col, self.dropped_chars))

    @property
    def runs_in_jvm(self) -> bool:
        return not self.stemmed

    def tokens(self, col: Column) -> Column:
        words = self.words(fold(col) if self.folded and self.runs_in_jvm else col)
        if self.runs_in_jvm:
            if not self.stop:
                return words
            stop = sorted(self.stop)
            return F.transform(words, lambda t: F.when(t.isin(stop), "").otherwise(t))
        return self._stemming_udf("array<string>")(words)

    def token_lists(self, cols: Column) -> Column:
        """Tokens of every string in an array of strings."""
        if self.runs_in_jvm:
            return F.transform(cols, self.tokens)
        return self._stemming_udf("array<array<string>>")(F.transform(cols, self.words))

    def _stemming_udf(self, returns: str):
        ship_package()
        stop, stemmed, folded = self.stop, self.stemmed, self.folded
        nested = returns.startswith("array<array")

        def finish(token):
            return None if token is None else _finish(token, stop, stemmed, folded)

        @F.arrow_udf(returns)
        def analyze(lists: pa.Array) -> pa.Array:
            if not nested:
                return _rewrite_distinct(lists, finish)
            inner = _rewrite_distinct(lists.flatten(), finish)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            offsets = pa.array([0, *sizes.cumsum().tolist()], pa.int32())
            mask = lists.is_null() if lists.null_count else None
            return pa.ListArray.from_arrays(offsets, inner, mask=mask)

        # Non-deterministic only so that the optimizer keeps one evaluation per row.
        return analyze.asNondeterministic()

    def query(self, phrase: str) -> list[str]:
        """The same analysis for a query phrase, on the driver."""
        import regex  # on the driver only

        text = phrase.translate({ord(c): None for c in self.dropped_chars})
        if self.folded and self.runs_in_jvm:
            text = fold_text(text)
        words = regex.findall(WORD, text.lower())
        return [_finish(w, self.stop, self.stemmed, self.folded) for w in words]

    def prefix_form(self, word: str) -> str:
        """The last word of a phrase prefix: cut words are not stemmed."""
        import regex

        text = fold_text(word) if self.folded else word.lower()
        words = regex.findall(WORD, text)
        return words[-1] if words else ""


STANDARD = Analyzer()
FOLDED = Analyzer(folded=True)
ENGLISH = Analyzer(stop=frozenset(ENGLISH_STOP_WORDS), stemmed=True, folded=True)


def token_count(tokens: Column) -> Column:
    """Number of kept tokens (the document length)."""
    return F.coalesce(F.size(F.array_remove(tokens, "")), F.lit(0))


def phonetic_codes(tokens: Column) -> Column:
    return F.transform(tokens, F.soundex)


def phonetic_match(tokens: Column, phrase: str, analyzer: Analyzer = STANDARD) -> Column:
    """Any word of the phrase sounds like any token."""
    wanted = F.array(*[F.soundex(F.lit(w)) for w in analyzer.query(phrase) if w])
    return F.arrays_overlap(phonetic_codes(tokens), wanted)
