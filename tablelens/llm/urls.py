"""URL rules, and exact host lists without joins by a cascade of Bloom filters.

The first filter holds the listed keys of the corpus; the second holds the other keys of the corpus
that the first lets through; the third the listed ones that the second lets through; and so on
until no key is left.  A key of the corpus is listed exactly when the first filter that rejects it has
an even number (or it passes an odd number of filters, all there are).  Filters take a few bits for each listed key, and
travel as literals of the plan; only DataFrame functions run.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablelens.plans.runtime import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: All filters of a cascade together; a list that needs more is refused, not cut.
MAX_BITS = 1 << 26

Rule = tuple[str, str, str]


def host_of(url: str | Column) -> Column:
    """From the first :// to / ? # or the end, A-Z lower-cased; empty without ://."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str | Column) -> Column:
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: str | Column) -> Column:
    column = F.coalesce(F.col(url) if isinstance(url, str) else url, F.lit(""))
    at = F.instr(column, "://")
    return F.when(at > 0, F.substring(column, at + 3, F.char_length(column))).otherwise(F.lit(""))


def suffixes(host: Column) -> Column:
    """The host and all its parent domains."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


class Bloom:
    """Bits of one filter as 64-bit words, with the function that tests a key."""

    def __init__(self, words: list[int], bits: int, hashes: int, level: int):
        self.words, self.bits, self.hashes, self.level = words, bits, hashes, level

    @staticmethod
    def positions(key: Column, bits: int, hashes: int, level: int) -> list[Column]:
        first, step = F.xxhash64(key, F.lit(2 * level)), F.xxhash64(key, F.lit(2 * level + 1))
        mask = F.lit((1 << 40) - 1)  # sums stay within 64 bits
        first, step = first.bitwiseAND(mask), step.bitwiseAND(mask).bitwiseOR(F.lit(1))
        return [F.pmod(first + F.lit(j) * step, F.lit(bits).cast("long")) for j in range(hashes)]

    @classmethod
    def of(cls, keys: DataFrame, column: str, count: int, bits_per_key: float, level: int) -> Bloom:
        bits = max(64, math.ceil(count * bits_per_key))
        hashes = max(1, round(bits / max(count, 1) * math.log(2)))
        hashes = min(hashes, 24)
        at = F.explode(F.array(*cls.positions(F.col(column), bits, hashes, level)))
        set_bits = keys.select(at.alias("at")).select(
            (F.col("at") / 64).cast("long").alias("word"), F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit")
        )
        words = [0] * (-(-bits // 64))
        for row in set_bits.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():  # at most bits / 64 rows
            words[row["word"]] = row["bits"]
        return cls(words, bits, hashes, level)

    def passes(self, key: Column) -> Column:
        words = F.from_json(F.lit(json.dumps(self.words)), "array<bigint>")  # folded to a literal
        test = F.lit(True)
        for at in self.positions(key, self.bits, self.hashes, self.level):
            word = F.element_at(words, (F.floor(at / 64) + 1).cast("int"))
            test = test & (F.getbit(word, (at % 64).cast("int")) == 1)
        return test


def cascade(universe: DataFrame, key: str, listed: DataFrame, listed_key: str) -> list[Bloom]:
    """Filters that tell the listed keys of ``universe`` from all its other keys; [] when none is listed."""
    names = listed.select(F.col(listed_key).alias("key")).filter("key is not null").distinct().withColumn("listed", F.lit(True))
    keys = universe.select(F.col(key).alias("key")).filter("key is not null").distinct()
    keys = written(keys.join(names, "key", "left").select("key", F.coalesce("listed", F.lit(False)).alias("listed")), "keys")
    held, other = keys.filter("listed"), keys.filter("not listed")
    n, m = held.count(), other.count()
    filters, spent, stuck = [], 0, 0
    while n:
        # the first filter lets about as many others through as there are listed keys, later ones half
        wanted = 1.44 * math.log2(max(2, m / n)) + 1 if not filters else 1.44
        wanted = max(wanted, 1.44) * (1 + stuck)
        level = Bloom.of(held, "key", n, wanted, len(filters))
        spent += level.bits
        if spent > MAX_BITS:
            raise ValueError(f"the list needs filters of more than {MAX_BITS} bits")
        filters.append(level)
        through = written(other.filter(level.passes(F.col("key"))), "passed")
        held, other, before = through, held, n
        n, m = through.count(), before
        stuck = stuck + 1 if n >= before else 0
    return filters


def is_listed(filters: Sequence[Bloom], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    answer = F.lit(len(filters) % 2 == 1)
    for i, level in reversed(list(enumerate(filters))):
        # rejected by filter i: listed when i is odd (counted from 0)
        answer = F.when(level.passes(key), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def rule_fits(rule: Rule, host: Column, path: Column) -> Column:
    _, domain, prefix = rule
    return ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)


def judge(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, listed_key: str = "host", page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: page_id, host, path, rule, verdict.

    ``rules`` are (allow or block, host, path prefix); the longest that fits decides, of equally long
    ones the first.  Without a rule a page is blocked when its host or a parent domain of it is in ``listed``.
    A null url or one without :// has empty host and path, fits no rule and is allowed; repeated rows
    are judged each; an empty table gives no rows.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), host_of(F.col(f"`{url}`")).alias("host"), path_of(F.col(f"`{url}`")).alias("path"))
    hosts = rows.select("host").distinct()
    universe = hosts.select(F.explode(suffixes(F.col("host"))).alias("key"))
    filters = cascade(universe, "key", listed, listed_key)
    named, said = F.lit(None).cast("string"), F.when(F.exists(suffixes(F.col("host")), lambda k: is_listed(filters, k)), "block").otherwise("allow") if filters else F.lit("allow")
    # the last one that fits decides, so of equally long rules the first comes last
    for rule in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):
        fits = rule_fits(rule, F.col("host"), F.col("path"))
        named = F.when(fits, rule[1] + rule[2]).otherwise(named)
        said = F.when(fits, rule[0]).otherwise(said)
    return rows.select("page_id", "host", "path", named.alias("rule"), said.alias("verdict"))
