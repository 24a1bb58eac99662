"""Document search and table analytics as Spark plans."""

from tablelens.functions.text import ENGLISH, FOLDED, STANDARD, Analyzer
from tablelens.plans.criteria import Criteria, fuzzy, phrase, prefix, word
from tablelens.plans.search import Result, Search, with_tokens

__all__ = [
    "ENGLISH",
    "FOLDED",
    "STANDARD",
    "Analyzer",
    "Criteria",
    "Result",
    "Search",
    "fuzzy",
    "phrase",
    "prefix",
    "with_tokens",
    "word",
]
