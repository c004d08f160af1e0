"""URL rules held in Bloom filter cascades.

A cascade answers exactly for every key of the universe it was built over. Level 1 encodes
the listed keys, level 2 the keys of the universe that level 1 lets through by mistake, level 3
the listed keys that level 2 lets through, and so on until a level makes no mistake. A key that
misses an odd level is not listed, one that misses an even level is. Looking a key up
costs a few bit tests on constants; no table is joined.

The keys of a url are its host's suffixes joined to its path's prefixes, in the shapes (number
of labels, length of path) that occur among the rules. The universe is every key of every url.

Everything here is DataFrame functions.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenura.llm.storage import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.translate(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0), UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or url."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def n_labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."))) + 1


@dataclass(frozen=True)
class Level:
    bits: int
    words: tuple[int, ...]


@dataclass(frozen=True)
class Cascade:
    """Filters as 64-bit words; ``hashes`` bit positions for each key and level."""

    levels: tuple[Level, ...]
    hashes: int

    @property
    def n_bytes(self) -> int:
        return sum(8 * len(x.words) for x in self.levels)

    def passes(self, number: int, key: Column) -> Column:
        """Whether level ``number`` (from 1) lets ``key`` through."""
        level = self.levels[number - 1]
        words = F.from_json(F.lit(json.dumps(level.words)), "array<bigint>")

        def is_set(bit: Column) -> Column:
            word = F.get(words, F.shiftright(bit, 6).cast("int"))
            mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (bit % 64).cast("int"))
            return word.bitwiseAND(mask) != 0

        return F.forall(positions(key, number, level.bits, self.hashes), is_set)

    def contains(self, key: Column) -> Column:
        """Whether ``key``, a key of the universe, is listed."""
        found = F.lit(len(self.levels) % 2 == 1)
        for number in range(len(self.levels), 0, -1):
            found = F.when(~self.passes(number, key), F.lit(number % 2 == 0)).otherwise(found)
        return found


def positions(key: Column, level: int, bits: int, hashes: int) -> Column:
    """The bits of ``key`` in a level of ``bits`` bits."""
    return F.array(*(F.pmod(F.xxhash64(key, F.lit(level), F.lit(j)), F.lit(bits).cast("bigint"))
                     for j in range(hashes)))


def _fill(keys: DataFrame, count: int, level: int, bits_per_key: int, hashes: int) -> Level:
    bits = 64 * math.ceil(max(count, 1) * bits_per_key / 64)
    bit = keys.select(F.explode(positions(F.col("key"), level, bits, hashes)).alias("bit"))
    mask = F.call_function("shiftleft", F.lit(1).cast("bigint"), (F.col("bit") % 64).cast("int"))
    filled = bit.groupBy(F.shiftright("bit", 6).alias("word")).agg(F.bit_or(mask).alias("bits"))
    found = dict(filled.collect())  # one row for each non-empty word of a filter of checked size
    return Level(bits, tuple(found.get(i, 0) for i in range(bits // 64)))


def build_cascade(
    listed: DataFrame,
    universe: DataFrame,
    bits_per_key: int = 12,
    hashes: int = 4,
    max_filter_bytes: int = 8 << 20,
) -> Cascade:
    """A cascade for the keys ``listed.key`` over the keys ``universe.key``.

    Repeated and null keys do no harm. An empty list gives a cascade without levels, which
    contains nothing. The filters travel inside the plan, so their size is checked level by
    level: beyond ``max_filter_bytes`` the build fails and asks for a higher bound.
    """
    inside = stored(listed.select("key").where("key is not null").distinct())
    count, levels = inside.count(), []
    outside = None
    while count:
        if sum(8 * len(x.words) for x in levels) + count * bits_per_key / 8 > max_filter_bytes:
            raise ValueError(f"{count} keys need more than {max_filter_bytes} bytes of filters")
        number = len(levels) + 1
        encoded = inside if number % 2 else outside
        levels.append(_fill(encoded, count, number, bits_per_key, hashes))
        wrong = Cascade(tuple(levels), hashes).passes(number, F.col("key"))
        if number == 1:  # only what the first level lets through is ever shuffled
            through = universe.select("key").where(F.col("key").isNotNull()).where(wrong).distinct()
            outside = stored(through.join(inside, "key", "left_anti"))
            count = outside.count()
        else:
            other = stored((outside if number % 2 else inside).where(wrong))
            count = other.count()
            inside, outside = (inside, other) if number % 2 else (other, outside)
    return Cascade(tuple(levels), hashes)


def rule_keys(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """The keys of a url in the given shapes."""
    made = F.array(*(
        F.when((n_labels(host) >= labels) & (F.length(path) >= length),
               F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, length)))
        for labels, length in shapes
    ))
    return F.filter(made, lambda key: key.isNotNull())


def judge(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    bits_per_key: int = 12,
    hashes: int = 4,
    max_filter_bytes: int = 8 << 20,
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits its host and
    all subdomains, if the url's path starts with the rule's path. The longest fitting rule decides
    and is returned as host + path; block wins where the same rule is listed with both verdicts.
    A url without a fitting rule is on no list: ``rule`` is null and the verdict is ``default``.

    A null url, or one without ``://``, has an empty host and path. Rules with a null in any
    column are ignored; without rules everything gets the default. Columns of ``pages`` that have
    the name of a result column are replaced; all others are kept. Repeated rows are
    judged alike. The shapes of the rules are collected: they are pairs of a label count and a
    path length, so there are few of them however long the list is.
    """
    rules = rules.select("host", "path", "verdict").dropna()
    shapes = sorted(
        (r[0], r[1])
        for r in rules.select(n_labels(F.col("host")), F.length("path")).distinct().collect()
    )
    host, path = url_host(pages[url]), url_path(pages[url])
    taken = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    out = pages.select(*(pages[f"`{c}`"] for c in taken), host.alias("host"), path.alias("path"))
    nothing = F.lit(None).cast("string")
    if not shapes:
        return out.withColumns({"rule": nothing, "verdict": F.lit(default)})

    keys = rule_keys(F.col("host"), F.col("path"), shapes)
    universe = pages.select(host.alias("host"), path.alias("path")).distinct()
    universe = universe.select(F.explode(keys).alias("key"))
    listed = rules.select(F.concat("host", "path").alias("key"), "verdict")

    def longest(verdict: str) -> Column:
        cascade = build_cascade(listed.where(F.col("verdict") == verdict), universe,
                                bits_per_key, hashes, max_filter_bytes)
        found = F.filter(keys, cascade.contains)
        return F.array_max(F.transform(found, lambda key: F.struct(F.length(key), key.alias("key"))))

    out = out.withColumns({"__block": longest("block"), "__allow": longest("allow")})
    blocks = F.col("__block").isNotNull() & (
        F.col("__allow").isNull() | (F.col("__block") >= F.col("__allow")))
    out = out.withColumns({
        "rule": F.when(blocks, F.col("__block.key")).otherwise(F.col("__allow.key")),
        "verdict": F.when(blocks, "block").when(F.col("__allow").isNotNull(), "allow")
        .otherwise(F.lit(default)),
    })
    return out.drop("__block", "__allow")
