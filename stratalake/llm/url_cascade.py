"""URL verdicts from Bloom filter cascades, with DataFrame functions only.

Level 1 of a cascade encodes the listed keys. Level 2 encodes the keys of the universe
that pass level 1 without being listed, level 3 the listed keys that pass level 2, and so
on until nobody passes wrongly. The first level that a key fails tells whether it is
listed, without error for every key of the universe, and without a join.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Bits that the levels of a cascade may have in all; they travel with the query (8 MB).
MOST_BITS = 1 << 26


class Cascade:
    """Exact membership in ``listed`` for every key of ``universe`` (both: one string column ``key``)."""

    def __init__(self, listed: DataFrame, universe: DataFrame, most_bits: int = MOST_BITS) -> None:
        self.levels: list[tuple[int, int, Column]] = []
        self.bits = 0
        inside = written(listed.select("key").dropna().distinct(), "listed")
        outside = universe.select("key").dropna().distinct()
        n_inside, total = inside.count(), max(1, outside.count())
        now, other = inside, outside.join(inside, "key", "left_anti")
        # Few wrong keys pass the first level; half of them pass each level after it.
        rate = min(0.5, max(n_inside, 1) / (math.sqrt(2) * total))
        n = n_inside
        while n:
            self._add(now, n, rate, most_bits)
            passing = written(other.filter(self._passes(F.col("key"), len(self.levels) - 1)), "passing")
            now, other, n, rate = passing, now, passing.count(), 0.5

    def _positions(self, key: Column, level: int, size: int, hashes: int) -> list[Column]:
        return [F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(size)) for j in range(hashes)]

    def _add(self, keys: DataFrame, n: int, rate: float, most_bits: int) -> None:
        hashes = max(1, round(-math.log2(rate)))
        size = 64 * max(1, math.ceil(n * hashes / math.log(2) / 64))
        self.bits += size
        if self.bits > most_bits:
            raise ValueError(f"the cascade needs over {most_bits} bits; split the listed keys by a hash or raise most_bits")
        at = keys.select(F.explode(F.array(*self._positions(F.col("key"), len(self.levels), size, hashes))).alias("at"))
        words = at.groupBy(F.expr("at div 64").alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(at % 64)))").alias("set"))
        held = [0] * (size // 64)
        for row in words.collect():  # size / 64 rows, bounded by most_bits
            held[row.word] = row.set
        self.levels.append((size, hashes, F.expr(f"cast(split('{','.join(map(str, held))}', ',') as array<bigint>)")))

    def _passes(self, key: Column, level: int) -> Column:
        size, hashes, words = self.levels[level]
        tests = [
            F.get(words, F.floor(p / 64).cast("int")).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), (p % 64).cast("int"))) != 0
            for p in self._positions(key, level, size, hashes)
        ]
        out = tests[0]
        for t in tests[1:]:
            out = out & t
        return out

    def contains(self, key: Column) -> Column:
        out = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            out = F.when(self._passes(key, level), out).otherwise(F.lit(level % 2 == 1))
        return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty if it is null or has no ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(__url, instr(__url, '://') + 3)")).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _suffixes(host: Column, most: int) -> Callable:
    """The host and its parent domains of up to ``most`` labels, longest first."""
    labels = F.split(host, r"\.", -1)
    n = F.size(labels)
    first = F.greatest(F.lit(1), n - most + 1)
    return F.transform(F.sequence(first, n), lambda i: F.concat_ws(".", F.slice(labels, i, n - i + 1)))


def url_verdicts(
    pages: DataFrame, rules: list[tuple[str, str]], listed_hosts: DataFrame, id_col: str = "page_id", url_col: str = "url"
) -> DataFrame:
    """id, host, path, rule, verdict (and ``listed``) of every page.

    ``rules`` are ``(verdict, host + path)``; a rule fits its host and all subdomains if
    the path starts with the rule's, and the longest that fits wins. Where none fits, the
    verdict is block if the host or a parent domain is in ``listed_hosts(key)``, else
    allow. The universe of the rules' cascades is every (domain, path start) of the
    corpus that a rule could name, that of the hosts' cascade every domain. Null urls
    have empty host and path, no rule, and are allowed. Rows are kept as they are;
    an empty list is a cascade without levels.
    """
    spark = pages.sparkSession
    kinds: dict[str, list[str]] = {"allow": [], "block": []}
    lengths, most = set(), 1
    for verdict, rule in rules:
        domain, slash, path = rule.partition("/")
        kinds[verdict].append(rule)
        lengths.add(len(slash + path))
        most = max(most, domain.count(".") + 1)
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    sizes = F.array(*[F.lit(n) for n in sorted(lengths, reverse=True)]) if lengths else F.array().cast("array<int>")
    fitting = F.transform(
        _suffixes(F.col("host"), most),
        lambda domain: F.transform(
            F.filter(sizes, lambda n: F.length("path") >= n), lambda n: F.concat(domain, F.expr("path").substr(F.lit(1), n))
        ),
    )
    rows = rows.withColumn("__keys", F.when(F.col("host") == "", F.array().cast("array<string>")).otherwise(F.flatten(fitting)))
    universe = written(rows.select(F.explode("__keys").alias("key")).distinct(), "url-keys")
    found = {
        kind: Cascade(spark.createDataFrame([(r,) for r in keys], "key string"), universe)
        for kind, keys in kinds.items()
    }
    depth = listed_hosts.agg(F.max(F.size(F.split("key", r"\.", -1)))).first()[0] or 1
    domains = written(rows.select(F.explode(_suffixes(F.col("host"), depth)).alias("key")).distinct(), "domains")
    hosts = Cascade(listed_hosts, domains)
    fits = F.filter("__keys", lambda key: found["allow"].contains(key) | found["block"].contains(key))
    longest = F.array_sort(fits, lambda a, b: F.length(b) - F.length(a))
    rows = rows.withColumn("rule", F.get(longest, F.lit(0)))
    listed = F.exists(_suffixes(F.col("host"), depth), lambda key: hosts.contains(key)) & (F.col("host") != "")
    ruled = F.when(found["block"].contains(F.col("rule")), "block").otherwise("allow")
    rows = rows.withColumn("listed", F.coalesce(listed, F.lit(False)))
    verdict = F.when(F.col("rule").isNotNull(), ruled).otherwise(F.when(F.col("listed"), "block").otherwise("allow"))
    return rows.select("page_id", "host", "path", "rule", verdict.alias("verdict"), "listed")
