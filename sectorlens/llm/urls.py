"""URL rules and a list of URLs behind a blocked Bloom filter.

A URL's verdict comes from the longest rule that fits its host and path.  Where no rule fits, its
canonical form is looked up in a list: a blocked Bloom filter lets only possible hits pass, and an
exact hash join with the list removes the false positives.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .stages import stored

# A block is four 64-bit words; a key sets two bits in each word of one block.
WORDS, BITS_PER_KEY = 4, 16
# Blocks that are sent to every task at most: 40 bytes each, 16 MB.
BROADCAST_BLOCKS = 400_000


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without ``www.`` or ``m.`` and path without ``.html`` or slash at its end.

    Scheme, query and fragment do not tell pages apart here.
    """
    return F.concat(F.regexp_replace(host_of(url), r"^(www|m)\.", ""),
                    F.regexp_replace(path_of(url), r"(\.html)?/*$", ""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest (verdict, ``host/path``) rule that fits, as a struct, or null."""
    def fits(rule: str) -> Column:
        where, slash, rest = rule.partition("/")
        return ((host == where) | F.endswith(host, F.lit(f".{where}"))) & F.startswith(
            path, F.lit(slash + rest))

    longest = sorted(rules, key=lambda r: (-len(r[1]), r[1]))
    return F.coalesce(*[F.when(fits(rule), F.struct(
        F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))) for verdict, rule in longest])


def _place(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(0)), F.lit(blocks)).alias("block")


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(key, F.lit(1))

    def bit(place: int) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.shiftrightunsigned(
            bits, 6 * place).bitwiseAND(F.lit(63)).cast("int"))

    return [bit(2 * w).bitwiseOR(bit(2 * w + 1)) for w in range(WORDS)]


def bloom_blocks(keys: DataFrame, key: str, bits_per_key: int = BITS_PER_KEY) -> tuple[DataFrame, int]:
    """The filter of distinct keys as rows (block, w0 … w3), and its number of blocks.

    Blocks are combined map-side, so a block's keys never meet in one task first.
    """
    count = keys.count()
    blocks = max(1, -(-count * bits_per_key // (64 * WORDS)))
    masks = keys.select(_place(F.col(key), blocks), *[
        m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))])
    return masks.groupBy("block").agg(*[
        F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), blocks


def listed(urls: DataFrame, id_columns: Sequence[str], key: str, listing: DataFrame,
           broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """The rows of ``urls`` whose ``key`` is in ``listing`` (a column of the same name).

    Every key meets its block of the filter, so only possible hits reach the exact join.  A filter
    of at most ``broadcast_blocks`` blocks is sent to every task; a larger one would outgrow a task,
    and keys and blocks are shuffled by the block's number.  Null keys are never listed; a key that
    the list repeats counts once.
    """
    keys = stored(listing.select(key).where(F.col(key).isNotNull()).distinct())
    possible = urls.select(*id_columns, key).where(F.col(key).isNotNull())
    filter_rows, blocks = bloom_blocks(keys, key)
    all_set = reduce(lambda a, b: a & b, [
        F.col(f"w{i}").bitwiseAND(m) == m for i, m in enumerate(_masks(F.col(key)))])
    side = F.broadcast(filter_rows) if blocks <= broadcast_blocks else filter_rows
    possible = possible.withColumn("block", _place(F.col(key), blocks)).join(
        side, "block").where(all_set).select(*id_columns, key)
    return possible.join(keys, key, "left_semi")


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], listing: DataFrame,
           id_column: str = "page_id", url: str = "url") -> DataFrame:
    """Judge every URL: id, ``host``, ``path``, ``rule`` and ``verdict``.

    ``listing`` has a column ``canonical``; a listed URL without a rule is blocked, any other
    allowed.  A null URL, or one without ``://``, has an empty host and path, fits no rule and is
    not looked up: allowed.  Repeated rows are judged each; other columns are ignored.  Only
    distinct canonical forms are looked up, so a form that fills a third of the table is one row.
    """
    parts = pages.select(F.col(id_column), host_of(F.col(url)).alias("host"),
                         path_of(F.col(url)).alias("path"), canonical(F.col(url)).alias("canonical"))
    ruled = parts.withColumn("found", rule_for(F.col("host"), F.col("path"), rules))
    open_forms = ruled.where(F.col("found").isNull() & (F.col("host") != "")) \
                      .select("canonical").distinct()
    hits = stored(listed(open_forms, [], "canonical", listing)).withColumn("hit", F.lit(True))
    looked_up = ruled.join(hits, "canonical", "left")
    return looked_up.select(
        id_column, "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", F.when(F.col("hit") & (F.col("host") != ""), "block"),
                   F.lit("allow")).alias("verdict"))
