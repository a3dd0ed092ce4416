r"""URL filters by a Bloom filter cascade (native).

A rule is a host and a path prefix; it fits its host and all subdomains when
the URL's path starts with the rule's path. Each URL has a few candidate keys
(a suffix of the host, a prefix of the path); the question is which are listed.

The cascade answers exactly for the keys it was built over. Level 1 is a Bloom
filter of the listed keys; level 2 encodes the corpus's keys that pass level 1
wrongly; level 3 the listed keys that pass level 2 wrongly; and so on, until
nothing passes wrongly. All candidate keys of the corpus meet every level while
building, so no URL of it gets a wrong answer, and the verdicts need no join:
the levels are constant bit arrays inside the expression.

Size: level 1 takes about 1.44 log2(corpus keys / listed keys) bits for each
listed key, which leaves about as many false positives as there are listed
keys; later levels take ``BITS_PER_KEY`` each. The number of keys of every
level is checked against ``max_keys``; beyond it the keys are matched by an
equi-join (``match_by_join``) with the same result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The rules of the registered query as (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

BITS_PER_KEY = 10
MIN_BITS = 64
MAX_KEYS = 1_000_000
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)\A.*?://([^/?#]*)([^?#]*)"


class TooManyKeys(Exception):
    """A level would hold more keys than its proven bound."""


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased. Path: from there up to ``?``, ``#`` or the end. Both are empty
    for a null URL and for one without ``://``."""
    u = F.coalesce(url, F.lit(""))
    return F.translate(F.regexp_extract(u, _URL, 1), _UPPER, _LOWER), F.regexp_extract(u, _URL, 2)


def candidate_keys(host: Column, path: Column, labels: int, lengths: Sequence[int]) -> Column:
    """Every key a fitting rule could have, longest first (on a tie the longer
    host): suffixes of the host at label borders with at most ``labels``
    labels, each with the path's prefixes of the given ``lengths``. Both
    limits come from the rules, so no key that can be listed is left out, and a
    host of very many labels costs no more than the rules need."""
    parts = F.split(host, r"\.", -1)
    n = F.least(F.size(parts), F.lit(labels))
    suffixes = F.transform(F.sequence(F.lit(1), n),
                           lambda k: F.concat_ws(".", F.slice(parts, F.size(parts) - k + 1, k)))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in sorted(set(lengths))]),
                        lambda p: p.isNotNull())
    keys = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(
        (F.length(h) + F.length(p)).alias("size"), F.length(h).alias("host_size"), F.concat(h, p).alias("key")))))
    return F.transform(F.sort_array(keys, asc=False), lambda x: x["key"])


@dataclass(frozen=True)
class Level:
    """One Bloom filter: number of bits, hash functions and the 64-bit words."""
    bits: int
    hashes: int
    words: tuple[int, ...]

    def passes(self, key: Column, number: int) -> Column:
        words = F.split(F.lit(",".join(map(str, self.words))), ",").cast("array<bigint>")   # folded to one constant
        out = F.lit(True)
        for p in positions(key, self.bits, self.hashes, number):
            out = out & (F.getbit(F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")) == 1)
        return out


def positions(key: Column, bits: int, hashes: int, number: int) -> list[Column]:
    """Bit positions of a key in level ``number``, by double hashing."""
    a = F.pmod(F.xxhash64(F.lit(2 * number), key), F.lit(bits))
    b = F.pmod(F.xxhash64(F.lit(2 * number + 1), key), F.lit(bits))
    return [(a + b * i) % bits for i in range(hashes)]


def build_level(keys: DataFrame, n: int, number: int, bits_per_key: float = BITS_PER_KEY) -> Level:
    """The filter of the ``key`` column (``n`` keys). Bits are set by ``bit_or``
    per word, combined map-side; at most one row per word reaches the driver."""
    words = max(MIN_BITS // 64, math.ceil(n * bits_per_key / 64))
    hashes = max(1, round(0.69 * bits_per_key))
    at = keys.select(F.explode(F.array(*positions(F.col("key"), 64 * words, hashes, number))).alias("p"))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))
    rows = at.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("v")).collect()
    filled = {r.w: r.v for r in rows}
    return Level(64 * words, hashes, tuple(filled.get(i, 0) for i in range(words)))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def contains(self, key: Column) -> Column:
        """Listed: passes level 1 and not (passes level 2 and not (passes level 3 …))."""
        out = F.lit(False)
        for number in range(len(self.levels), 0, -1):
            out = self.levels[number - 1].passes(key, number) & ~out
        return out


def build_cascade(listed: DataFrame, universe: DataFrame, max_keys: int = MAX_KEYS) -> Cascade:
    """A cascade that tells the ``listed`` keys from all others in ``universe``
    (both a ``key`` column; repeats and nulls are harmless). Each level reads
    only the keys that every earlier level let pass."""
    listed = listed.where(F.col("key").isNotNull()).distinct()
    n = listed.limit(max_keys + 1).count()
    if n == 0:
        return Cascade(())
    n_universe = universe.agg(F.approx_count_distinct("key")).first()[0]
    per_key = max(BITS_PER_KEY, 1.44 * math.log2(max(n_universe, 2) / n) + 1)
    levels: list[Level] = []
    keys = listed
    while n:
        if n > max_keys:
            raise TooManyKeys(f"level {len(levels) + 1} holds more than {max_keys} keys")
        levels.append(build_level(keys, n, len(levels) + 1, per_key if not levels else BITS_PER_KEY))
        passed = F.lit(True)
        for number, level in enumerate(levels, 1):
            passed = passed & level.passes(F.col("key"), number)
        if len(levels) % 2:     # a level of listed keys: which others pass all levels so far?
            keys = universe.where(passed).distinct().join(listed, "key", "left_anti")
        else:                   # a level of others: which listed keys pass all levels so far?
            keys = listed.where(passed)
        n = keys.limit(max_keys + 1).count()
    return Cascade(tuple(levels))


def rules_table(spark, rules: Iterable[tuple[str, str, str]]) -> DataFrame:
    """``verdict, key`` of rules given as (verdict, host, path), as constants of the plan; read long lists as a table."""
    rows = [F.struct(F.lit(v).alias("verdict"), F.lit(h.translate(str.maketrans(_UPPER, _LOWER)) + p).alias("key")) for v, h, p in rules]
    if not rows:
        return spark.range(0).select(F.lit("").alias("verdict"), F.lit("").alias("key"))
    return spark.range(1).select(F.explode(F.array(*rows)).alias("r")).select("r.verdict", "r.key")


def _shape(rules: DataFrame) -> tuple[int, list[int]]:
    """Most host labels, and the distinct path lengths, among the rules (a few numbers)."""
    host = F.substring_index("key", "/", 1)
    size = (F.length("key") - F.length(host)).alias("n")
    labels = rules.agg(F.max(F.size(F.split(host, r"\.", -1)))).first()[0]
    return labels or 1, [r.n for r in rules.select(size).distinct().collect()] or [1]


def filter_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow",
                max_keys: int = MAX_KEYS) -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``;
    ``rules`` has ``verdict`` (block or allow) and ``key`` (host and path).

    The longest fitting rule decides (the longer host on a tie; block if a key
    is listed both ways); with none, the URL is in no list: ``default``. Null
    URLs have empty host and path; repeated rows stay; other columns of
    ``pages`` are not read."""
    host, path = host_and_path(F.col(f"`{url}`"))
    labels, lengths = _shape(rules)
    urls = (pages.select(F.col(f"`{key}`").alias("page_id"), host.alias("host"), path.alias("path"))
            .withColumn("keys", candidate_keys(F.col("host"), F.col("path"), labels, lengths)))
    try:
        by_rule = build_cascade(rules, urls.select(F.explode("keys").alias("key")), max_keys)
        blocks = build_cascade(rules.where("verdict = 'block'"), rules.select("key"), max_keys)
    except TooManyKeys:
        return match_by_join(urls, rules, default)
    return match_by_cascade(urls, by_rule, blocks, default)


def match_by_cascade(urls: DataFrame, by_rule: Cascade, blocks: Cascade, default: str) -> DataFrame:
    found: Callable[[Column], Column] = by_rule.contains
    rule = F.get(F.filter("keys", lambda k: found(k)), F.lit(0))
    return (urls.withColumn("rule", rule)
            .select("page_id", "host", "path", "rule",
                    F.when(F.col("rule").isNull(), F.lit(default))
                    .when(blocks.contains(F.col("rule")), F.lit("block")).otherwise(F.lit("allow")).alias("verdict")))


def match_by_join(urls: DataFrame, rules: DataFrame, default: str) -> DataFrame:
    """The same verdicts for rule lists beyond the filter's bound: the distinct
    key lists of the URLs are matched by an equi-join, then joined back."""
    listed = rules.groupBy("key").agg(F.min(F.when(F.col("verdict") == "block", 0).otherwise(1)).alias("v"))
    groups = urls.select("keys").distinct()
    best = (groups.select("keys", F.posexplode("keys").alias("at", "key")).join(listed, "key")
            .groupBy(F.col("keys").alias("of_keys")).agg(F.min(F.struct("at", "key", "v")).alias("m")))
    return (urls.join(best, F.col("keys") == F.col("of_keys"), "left")
            .select("page_id", "host", "path", F.col("m.key").alias("rule"),
                    F.when(F.col("m").isNull(), F.lit(default)).when(F.col("m.v") == 0, F.lit("block"))
                    .otherwise(F.lit("allow")).alias("verdict")))
