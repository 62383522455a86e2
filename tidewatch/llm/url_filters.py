"""URL rules and exact membership in key lists by a cascade of Bloom filters.

The first filter of a cascade holds the listed keys; the second holds the keys of the corpus that the
first one wrongly passes; the third the listed keys that the second wrongly passes; and so on until
nothing is wrong. As the levels are built over all keys the corpus has, the answer is exact for
each of them, and a lookup reads a few bits of a literal: no join, no shuffle.

Nulls and edge cases: a null url, or one without ``://``, has an empty host and path; a null key is
never listed; an empty list gives a cascade that lists nothing; repeated rows are each judged;
further columns are kept, and the columns added replace ones of the same name.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.folders import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: From so few keys on, a level after the first takes as many bits as the last ones need to leave nothing wrong.
LAST_KEYS = 512

#: Bits that the filters of a cascade may take together before ``listed_by_cascade`` joins instead.
MAX_BITS = 1 << 26


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def lower_ascii(column: Column) -> Column:
    return F.translate(column, UPPER, UPPER.lower())


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


# ---------------------------------------------------------------- Bloom filters of plain functions


@dataclass(frozen=True)
class BloomFilter:
    words: tuple[int, ...]
    hashes: int
    seed: int

    @property
    def bits(self) -> int:
        return 32 * len(self.words)


def _places(key: Column, bits: int, hashes: int, seed: int) -> list[Column]:
    size = F.lit(bits).cast("long")
    first = F.pmod(F.xxhash64(F.lit(seed), key), size)
    step = F.pmod(F.xxhash64(F.lit(seed + 1), key), size)
    return [F.pmod(first + F.lit(k) * step, size) for k in range(hashes)]


def build_filter(keys: DataFrame, count: int, rate: float, seed: int) -> BloomFilter:
    """A filter of ``count`` keys (column ``key``) with a false-positive ``rate``."""
    bits = max(64, 32 * math.ceil(count * math.log(1 / rate) / math.log(2) ** 2 / 32))
    hashes = max(1, round(bits / max(1, count) * math.log(2)))
    place = F.explode(F.array(*_places(F.col("key"), bits, hashes, seed)))
    words = keys.select(place.alias("place")).groupBy(F.shiftright("place", 5).alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place & 31 as int)))").alias("value")
    )
    table = [0] * (bits // 32)
    for row in words.collect():  # at most a row for each word of the filter, whose size is checked
        table[row["word"]] = row["value"]
    return BloomFilter(tuple(table), hashes, seed)


def contains(bloom: BloomFilter, key: Column) -> Column:
    # one literal, made from text when the plan is optimised
    words = F.split(F.lit(",".join(map(str, bloom.words))), ",").cast("array<bigint>")
    found = F.lit(True)
    for place in _places(key, bloom.bits, bloom.hashes, bloom.seed):
        word = F.get(words, F.shiftright(place, 5).cast("int"))
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), (place % 32).cast("int"))
        bit = word.bitwiseAND(mask)
        found = found & (bit != 0)
    return found


@dataclass(frozen=True)
class Cascade:
    """Filters in turn; the first one that a key doesn't pass decides."""

    levels: tuple[BloomFilter, ...]

    @property
    def bits(self) -> int:
        return sum(level.bits for level in self.levels)

    def listed(self, key: Column) -> Column:
        answer = F.lit(len(self.levels) % 2 == 1)
        for number, level in reversed(list(enumerate(self.levels))):
            answer = F.when(contains(level, key), answer).otherwise(F.lit(number % 2 == 1))
        return F.coalesce(answer & key.isNotNull(), F.lit(False))


def build_cascade(
    universe: DataFrame, listed: DataFrame, first_rate: float | None = None, rate: float = 0.5,
    max_bits: int = MAX_BITS, seed: int = 11,
) -> Cascade | None:
    """The cascade that tells the keys of ``listed`` from all others of ``universe``.

    Both have a column ``key``, ``universe`` all keys that will be asked for. None if the filters
    would take more than ``max_bits``. The first rate is by default the one that makes the cascade
    smallest: the share of listed keys, divided by the square root of two.
    """
    inside = listed.select("key").where(F.col("key").isNotNull()).distinct()
    keys = universe.select("key").where(F.col("key").isNotNull()).distinct()
    # only listed keys that the corpus has can be asked for
    marked = written(
        keys.join(inside.withColumn("listed", F.lit(True)), "key", "left")
        .select("key", F.coalesce("listed", F.lit(False)).alias("listed")),
        "url-keys",
    )
    total = {r["listed"]: r["count"] for r in marked.groupBy("listed").count().collect()}
    n_in, n_out = total.get(True, 0), total.get(False, 0)
    if first_rate is None:
        first_rate = min(0.5, n_in / max(1, n_out) / math.sqrt(2)) if n_in else 0.5
    levels: list[BloomFilter] = []
    held = {True: marked.where("listed"), False: marked.where("not listed")}
    count, other, side, used = n_in, n_out, True, 0
    while count:
        level_rate = first_rate if not levels else rate
        if levels and count <= LAST_KEYS:
            level_rate = min(level_rate, 0.05 / max(1, other))
        used += count * math.log(1 / level_rate) / math.log(2) ** 2
        if used > max_bits:
            return None
        levels.append(build_filter(held[side], count, level_rate, seed + 2 * len(levels)))
        # what the new filter wrongly passes is the next one's content
        side = not side
        held[side] = held[side].where(contains(levels[-1], F.col("key")))
        count, other = held[side].count(), count
    return Cascade(tuple(levels))


def judge_urls(
    pages: DataFrame, rules: list[Rule], listed: DataFrame, max_bits: int = MAX_BITS, by_path: bool = False,
) -> DataFrame:
    """``pages`` with host, path, rule and verdict: the longest rule's, else block for listed keys.

    ``listed`` has a column ``key`` of hosts, or with ``by_path`` of hosts followed by paths. Membership
    is asked of a cascade over all such keys of ``pages``; if it would exceed ``max_bits``, of a join
    with the list.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    rows = pages.drop("host", "path", "rule", "verdict").withColumns({"host": host, "path": path})
    name, verdict = matched(rules, F.col("host"), F.col("path"))
    key = F.concat("host", "path") if by_path else F.col("host")
    cascade = build_cascade(rows.select(key.alias("key")), listed, max_bits=max_bits)
    if cascade is not None:
        blocked = cascade.listed(key)
    else:
        keys = listed.select(F.col("key").alias("__key")).distinct()
        rows, blocked = rows.join(keys, key == F.col("__key"), "left"), F.col("__key").isNotNull()
    own = F.when(blocked, "block").otherwise("allow")
    return rows.withColumns({"rule": name, "verdict": F.coalesce(verdict, own)}).drop("__key")
