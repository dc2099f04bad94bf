"""URL filter: host and path rules, then a listed set behind a blocked Bloom filter and an exact hash join."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 8  # 64-bit words of one block; every key sets one bit in each
BROADCAST_BYTES = 64 << 20  # a filter up to this size is broadcast, a larger one is joined by block
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
QUERY = r"(?s)^[^?#]*\?([^#]*)"
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=|$)"


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str  # allow or block

    def fits(self, host: Column, path: Column) -> Column:
        own = (host == self.host) | host.endswith("." + self.host)
        return own & path.startswith(self.path)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty where there is none."""
    return F.coalesce(F.translate(F.regexp_extract(url, PARTS, 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or end; empty where there is none."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.``, path without closing slashes, query without tracking parameters in sorted order.

    Scheme and fragment do not count. NULL for a NULL url or one without ``://``.
    """
    host = F.regexp_replace(host_of(url), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    kept = F.filter(F.split(F.regexp_extract(url, QUERY, 1), "&"), lambda p: (p != "") & ~p.rlike(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    return F.when(F.instr(url, "://") > 0, F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise("")))


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _masks(key: str) -> list[Column]:
    second = f"xxhash64({key}, 'bits')"
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned({second}, {6 * w}) & 63 AS int))") for w in range(WORDS)]


def blocked_filter(keys: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as rows (block, w0..w7); blocks without a key have no row."""
    masks = keys.select(_block(F.col(key), blocks).alias("_block"), *[m.alias(f"_w{w}") for w, m in enumerate(_masks(key))])
    return masks.groupBy("_block").agg(*[F.bit_or(f"_w{w}").alias(f"_w{w}") for w in range(WORDS)])


def flag_listed(df: DataFrame, key: str, listed: DataFrame, bits_per_key: int = 16, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All rows of ``df`` with ``is_listed``: whether ``key`` occurs in the one column of ``listed``. NULL is never listed.

    Rows that the filter excludes are final at once; only possible hits meet the list itself, in a hash join on the key
    that removes false positives. Keys of the list are made distinct first, so no row is repeated.
    """
    keys = listed.select(F.col(listed.columns[0]).alias("_key")).where("_key IS NOT NULL").distinct()
    blocks = max(1, math.ceil(keys.count() * bits_per_key / (64 * WORDS)))
    bloom = blocked_filter(keys, "_key", blocks)
    if blocks * 8 * (WORDS + 1) <= broadcast_bytes:
        bloom = F.broadcast(bloom)
    probed = df.withColumn("_key", F.col(key)).withColumn("_block", _block(F.col("_key"), blocks)).join(bloom, "_block", "left")
    passed = F.lit(True)
    for w, mask in enumerate(_masks("_key")):
        passed = passed & (F.col(f"_w{w}").bitwiseAND(mask) != 0)
    possible = F.col("_key").isNotNull() & F.coalesce(passed, F.lit(False))
    probed = probed.withColumn("_possible", possible)
    out = [*df.columns, "_key"]
    never = probed.where("NOT _possible").select(*out, F.lit(False).alias("is_listed"))
    exact = keys.withColumn("_found", F.lit(True)).hint("shuffle_hash")
    maybe = probed.where("_possible").select(*out).join(exact, "_key", "left").select(*out, F.coalesce("_found", F.lit(False)).alias("is_listed"))
    return never.unionByName(maybe).drop("_key")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], listed: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: id, ``host``, ``path``, ``rule`` (``host`` + ``path`` of the rule, else NULL), ``is_listed``, ``verdict``.

    A rule fits its host and all subdomains where the url's path starts with its path; the longest wins, among equally
    long ones the one with the longer host, then a block. Without a rule a page is blocked if its canonical url is the
    canonical form of one in ``listed`` (one column of urls). NULL urls and urls without ``://`` have an empty host and
    path and are allowed. Repeated rows stay repeated; an empty table gives no rows; other columns are ignored.
    """
    rows = pages.select(F.col(id_col), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"), canonical(F.col(url_col)).alias("canonical_url"))
    keys = listed.select(canonical(F.col(listed.columns[0])).alias("listed_url"))
    flagged = flag_listed(rows, "canonical_url", keys)
    ranked = sorted(rules, key=lambda r: (-len(r.host + r.path), -len(r.host), r.verdict != "block"))
    host, path = F.col("host"), F.col("path")
    nothing = F.lit(None).cast("string")
    rule = F.coalesce(*[F.when(r.fits(host, path), r.host + r.path) for r in ranked], nothing)
    ruled = F.coalesce(*[F.when(r.fits(host, path), r.verdict) for r in ranked], nothing)
    verdict = F.coalesce(ruled, F.when(F.col("is_listed"), "block").otherwise("allow"))
    return flagged.select(id_col, "host", "path", rule.alias("rule"), "is_listed", verdict.alias("verdict"))
