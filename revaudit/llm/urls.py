"""URL filters: exact list membership by a Bloom filter cascade (operator 6, native).

The universe of keys is every (host suffix, path prefix) pair that the corpus's urls
offer at the lengths that rules have.  Level 1 of the cascade encodes the listed keys
that occur in it; level 2 encodes the keys of the universe that level 1 accepts though
they aren't listed; level 3 the listed keys that level 2 accepts; and so on, until a
level accepts nothing wrong.  A key's membership is the parity of the first level that
turns it down, which is exact for every key of the universe, without any join.

Sizes.  Level 1's false-positive rate is about listed / universe, so the later levels
hold no more keys than the list has, and each halves: all levels together take about
``1.44 * log2(universe / listed) + 6`` bits for each listed key.  The list is the caller's
parameter; the corpus only enters by its logarithm.  A filter reaches the rows as one
literal array of longs.

Hosts and paths: see ``host_path``.  Null urls and urls without ``://`` have an empty host
and path, which no rule fits.  Repeated rows are judged alike.  An empty table or an
empty list gives verdict ``allow`` and rule null for every row.  Columns of ``pages`` whose
names clash with the result's are replaced; others are kept by ``filter_urls``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import stored

#: (action, host, path prefix); fixed values of the query.
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"),
         ("allow", "org", "/fr/")]

_WORD = 32
_HOST_PATH = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://``, ASCII-lower-cased, and path up to ``?`` or ``#``; empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    return (F.translate(F.regexp_extract(url, _HOST_PATH, 1), _UPPER, _LOWER),
            F.regexp_extract(url, _HOST_PATH, 2))


def rule_keys(host: Column, path: Column, path_lengths: list[int]) -> Column:
    """Every ``suffix of the host + prefix of the path`` that a rule could be, longest first.

    Suffixes begin at a label.  Longest means by the host's length, then by the path's.
    """
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda k: F.array_join(F.slice(labels, k, F.size(labels) - k + 1), "."))
    lengths = F.filter(F.array(*[F.lit(n) for n in sorted(set(path_lengths), reverse=True)]).cast("array<int>"),
                       lambda n: n <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(
        lengths, lambda n: F.concat(s, path.substr(F.lit(1), n)))))


def _places(key: Column, level: int, bits: int, hashes: int) -> Column:
    """The filter bits of a key at a level."""
    m = F.lit(bits).cast("long")
    one, two = F.pmod(F.xxhash64(key, F.lit(2 * level)), m), F.pmod(F.xxhash64(key, F.lit(2 * level + 1)), m)
    return F.transform(F.sequence(F.lit(0), F.lit(hashes - 1)),
                       lambda i: F.pmod(one + i.cast("long") * two, m))


def _accepts(words: Column, key: Column, level: int, bits: int, hashes: int) -> Column:
    return F.forall(_places(key, level, bits, hashes), lambda p: F.get(words, F.shiftright(p, 5).cast("int"))
                    .bitwiseAND(_bit(p)) != 0)


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(place, F.lit(_WORD)).cast("int"))


class Cascade:
    """Levels of Bloom filters; ``contains`` is exact for every key of the universe it was built on."""

    def __init__(self, spark: SparkSession, listed: DataFrame, universe: DataFrame, key: str = "key"):
        """``listed`` and ``universe`` hold distinct keys; listed keys outside the universe take no part.

        The joins here serve the building alone: they tell listed keys from others.
        """
        self.levels: list[tuple[Column, int, int]] = []
        rest = universe.join(listed, key, "left_anti")
        inside = universe.join(listed, key, "left_semi")
        n_inside, n_rest = inside.count(), universe.count()
        self.n_listed, self.n_universe, n_rest = n_inside, n_rest, n_rest - n_inside
        encode, other, n_encode, n_other = inside, rest, n_inside, n_rest
        while n_encode:
            rate = min(0.5, max(n_encode, 1) / max(n_other, 1)) if not self.levels else 0.5
            bits = max(64, math.ceil(n_encode * 1.45 * math.log2(1 / rate)))
            hashes = max(1, round(math.log2(1 / rate)))
            level = len(self.levels)
            words = self._words(encode, key, level, bits, hashes)
            self.levels.append((words, bits, hashes))
            wrong = stored(other.where(_accepts(words, F.col(key), level, bits, hashes)), "cascade")
            encode, other, n_encode, n_other = wrong, encode, wrong.count(), n_encode

    @staticmethod
    def _words(keys: DataFrame, key: str, level: int, bits: int, hashes: int) -> Column:
        """The filter as a literal array, word by word; its size follows the list (see above)."""
        place = keys.select(F.explode(_places(F.col(key), level, bits, hashes)).alias("p"))
        filled = dict(place.groupBy(F.shiftright("p", 5).alias("w")).agg(F.bit_or(_bit(F.col("p"))).alias("v")).collect())
        return F.expr("array(" + ",".join(f"{filled.get(w, 0)}L" for w in range(-(-bits // _WORD))) + ")")

    def contains(self, key: Column) -> Column:
        """True where the first level to turn the key down is an even one (or the last level, an odd one, accepts)."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in range(len(self.levels) - 1, -1, -1):
            words, bits, hashes = self.levels[level]
            answer = F.when(_accepts(words, key, level, bits, hashes), answer).otherwise(F.lit(level % 2 == 1))
        return answer


def filter_urls(pages: DataFrame, rules: list[tuple[str, str, str]] = RULES, url: str = "url") -> DataFrame:
    """Add host, path, rule (the longest that fits, else null) and verdict to every row of ``pages``."""
    spark = pages.sparkSession
    host, path = host_path(F.col(url))
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    parts = pages.select(*kept, host.alias("host"), path.alias("path"))
    if not rules:
        return parts.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    lengths = [len(r[2]) for r in rules]
    candidates = rule_keys(F.col("host"), F.col("path"), lengths)
    universe = stored(parts.select(F.explode(candidates).alias("key")).distinct(), "url-keys")
    listed = spark.range(1).select(F.inline(F.array(*[
        F.struct(F.lit(h + p).alias("key"), F.lit(action).alias("action")) for action, h, p in rules])))
    any_rule = Cascade(spark, listed.select("key").distinct(), universe)
    hits = stored(universe.where(any_rule.contains(F.col("key"))), "url-hits")
    blocking = Cascade(spark, listed.where("action = 'block'").select("key").distinct(), hits)
    rule = F.get(F.filter("candidates", any_rule.contains), F.lit(0))
    return (parts.withColumn("candidates", candidates).withColumn("rule", rule).drop("candidates")
            .withColumn("verdict", F.when(F.col("rule").isNull(), "allow")
                        .when(blocking.contains(F.col("rule")), "block").otherwise("allow")))


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .tables import read
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return filter_urls(pages).select("page_id", "host", "path", "rule", "verdict")


OP6_SQL = r"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    END AS rule FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
