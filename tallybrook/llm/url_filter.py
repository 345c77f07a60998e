"""URL rules by a cascade of Bloom filters (operator 7), DataFrame functions only.

A rule names a host and a path prefix. A url's keys are every suffix of its host (by labels) with
every prefix of its path that has the length of some rule's path, so a rule fits a url
exactly when the rule's key is among the url's keys.

The cascade of a rule list is built over all keys of the corpus: level 1 encodes the listed keys, level 2
those unlisted keys of the corpus that level 1 takes for listed, level 3 the listed keys that
level 2 takes for unlisted, and so on until a level errs on no key. A key of the corpus is listed exactly if the first level
that says no has an even number, or the last level is odd and says yes: no join is needed, and no answer is wrong.
All levels are sized by the rule list: the first has enough bits for about as many false positives
as there are rules. A cascade answers only for keys it was built over.

Cases: a null url, or one without "://", has an empty host and path and no rule; an empty rule list
gives every url the default verdict; of two fitting rules the longer key wins, and block wins over allow for the same key;
rows are never joined or grouped, so repeated rows, null ids and extra columns stay as they are; columns named host, path, rule or verdict are
replaced by the results.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybrook.llm.common import ascii_lower, stage

#: (verdict, host, path) of the registered query
RULES = (("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/"))


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All keys of a url. An array as long as the host has labels, times the path lengths of the rules."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= n, F.left(path, F.lit(n))) for n in lengths]), lambda p: p.isNotNull())
    return F.when(host == "", F.array().cast("array<string>")).otherwise(F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p)))))


@dataclass(frozen=True)
class Level:
    bits: int
    hashes: int
    words: tuple[int, ...]  # 32 bits each

    @staticmethod
    def positions(key: Column, bits: int, hashes: int, level: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(level * 64 + i)), F.lit(bits)) for i in range(hashes)]

    def may_hold(self, key: Column, level: int) -> Column:
        table = F.split(F.lit(" ".join(map(str, self.words))), " ").cast("array<long>")
        tests = [F.get(table, F.floor(p / 32).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(p, F.lit(32)).cast("int"))) != 0 for p in self.positions(key, self.bits, self.hashes, level)]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def holds(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for i in reversed(range(len(self.levels))):
            answer = F.when(self.levels[i].may_hold(key, i), answer).otherwise(F.lit(i % 2 == 1))
        return answer


def _level(keys: DataFrame, count: int, rate: float, number: int) -> Level:
    """Encode ``keys`` (column key). Only the words of the filter come to the driver: about 1.44 log2(1 / rate) bits a key."""
    bits = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    hashes = max(1, round(bits / count * math.log(2)))
    spread = keys.select(F.explode(F.array(*Level.positions(F.col("key"), bits, min(hashes, 30), number))).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(32)).cast("int"))
    found = dict(spread.groupBy(F.floor(F.col("p") / 32).alias("w")).agg(F.bit_or(one)).collect())
    return Level(bits, min(hashes, 30), tuple(found.get(w, 0) for w in range(bits // 32 + 1)))


def build(listed: DataFrame, universe: DataFrame, universe_size: int) -> Cascade:
    """``listed`` and ``universe`` have a column key; the universe need not be distinct, and is read once."""
    levels: list[Level] = []
    inside = listed.filter(F.col("key").isNotNull()).distinct()
    count = inside.count()
    if not count:
        return Cascade(())
    rate = min(0.5, count / max(universe_size, 1))
    levels.append(_level(inside, count, rate, 0))
    # false positives of level 1: about as many as listed keys; tested before anything is shuffled
    wrong = universe.filter(levels[0].may_hold(F.col("key"), 0)).distinct().join(inside, "key", "left_anti")
    ours, others = inside, stage(wrong)
    while count := others.count():
        number = len(levels)
        levels.append(_level(others, count, 0.5, number))
        ours, others = others, stage(ours.filter(levels[-1].may_hold(F.col("key"), number)))
    return Cascade(tuple(levels))


def _longest(keys: Column, verdict: str) -> Column:
    return F.array_max(F.transform(keys, lambda k: F.struct(F.length(k).alias("n"), F.lit(verdict).alias("verdict"), k.alias("key"))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow", url_col: str = "url") -> DataFrame:
    """Add host, path, rule and verdict to the rows. ``rules`` has verdict, host and path; its cascades, some 30 bits a rule, are held by every task."""
    shape = rules.select("verdict", F.concat("host", "path").alias("key"), F.length("path").alias("n"))
    lengths = sorted(r[0] for r in shape.select("n").distinct().collect() if r[0] is not None)  # bounded by the longest path
    # other columns go along under names of their own, so that none can clash
    extra = [c for c in pages.columns if c.lower() not in ("host", "path", "rule", "verdict")]
    names = [f"c{i}" for i in range(len(extra))]
    parsed = pages.select(*[pages[c].alias(n) for c, n in zip(extra, names)], host_of(pages[url_col]).alias("host"), path_of(pages[url_col]).alias("path"))
    if not lengths:
        return parsed.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict")).toDF(*extra, "host", "path", "rule", "verdict")
    keyed = parsed.select("*", keys_of(F.col("host"), F.col("path"), lengths).alias("keys"))
    universe = keyed.select(F.explode("keys").alias("key"))
    size = universe.agg(F.approx_count_distinct("key")).first()[0]
    marks = []
    for verdict in ("allow", "block"):
        cascade = build(shape.filter(F.col("verdict") == verdict).select("key"), universe, size)
        marks.append(_longest(F.filter("keys", cascade.holds), verdict))
    best = keyed.select("*", F.array_max(F.array(*marks)).alias("best"))
    out = best.select(*names, "host", "path", F.col("best.key").alias("rule"), F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    return out.toDF(*extra, "host", "path", "rule", "verdict")
