"""English suffix stripping after Porter (1980), applied once per distinct token of a batch."""

from __future__ import annotations

import re
from functools import lru_cache

# The suffix tables of the published algorithm.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
    "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)


def _shape(word: str) -> str:
    """The word as consonants ``c`` and vowels ``v``; ``y`` after a consonant is a vowel."""
    out = ""
    for ch in word:
        vowel = ch in "aeiou" or (ch == "y" and out.endswith("c"))
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return len(re.findall("v+c+", _shape(word)))


def _double_consonant(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word).endswith("c")


def _short_end(word: str) -> bool:
    return _shape(word).endswith("cvc") and word[-1] not in "wxy"


def _longest_suffix(word: str, suffixes) -> str | None:
    found = [s for s in suffixes if word.endswith(s)]
    return max(found, key=len) if found else None


def _plural(word: str) -> str:
    if word.endswith("sses") or word.endswith("ies"):
        return word[:-2]
    if word.endswith("s") and not word.endswith("ss"):
        return word[:-1]
    return word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    suffix = _longest_suffix(word, ("ed", "ing"))
    if suffix is None or "v" not in _shape(word[: -len(suffix)]):
        return word
    word = word[: -len(suffix)]
    if word.endswith(("at", "bl", "iz")):
        return word + "e"
    if _double_consonant(word) and word[-1] not in "lsz":
        return word[:-1]
    if _measure(word) == 1 and _short_end(word):
        return word + "e"
    return word


def _mapped(word: str, table: dict[str, str]) -> str:
    suffix = _longest_suffix(word, table)
    if suffix and _measure(word[: -len(suffix)]) > 0:
        return word[: -len(suffix)] + table[suffix]
    return word


def _residual(word: str) -> str:
    suffix = _longest_suffix(word, STEP_4)
    if suffix is None:
        return word
    root = word[: -len(suffix)]
    if _measure(root) > 1 and (suffix != "ion" or root.endswith(("s", "t"))):
        return root
    return word


def _tidy(word: str) -> str:
    if word.endswith("e"):
        root = word[:-1]
        if _measure(root) > 1 or (_measure(root) == 1 and not _short_end(root)):
            word = root
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if len(word) < 3:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    return _tidy(_residual(_mapped(_mapped(word, STEP_2), STEP_3)))
