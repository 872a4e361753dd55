"""Exact de-duplication by two-pass Bloom filtering, in DataFrame functions alone.

Texts are equal when they are identical after each run of ``[\\x20\\x09-\\x0D]`` becomes one space; a null text counts as
empty. Of equal texts the row with the smallest id stays.

1. Every row sets ``PROBES`` bits of a blocked Bloom filter: its hash names a block of 32,768 bits, a second hash the
   places in it. Bits set by one row only are forgotten, so what remains tells which hashes may repeat. Bits are counted
   with partial aggregates: copies of one text add a few counts per task, however many they are.
2. Rows are tested against that filter where they are read. A row with a bit that nobody else set is the only one of its
   text and passes straight through. The others, which are the real copies and a few chance hits, are the only rows that
   shuffle: by SHA-256 of the normalised text, which decides alone what is equal.

The filter has ``BITS_PER_ROW`` bits a row, broadcast in slices of at most 32 MB and at most ``MAX_SLICES`` of them. From
about 134 million rows on, the bits per row fall instead and more rows take the shuffle; the result is the same.

Defined cases: empty tables give empty results; an id of null sorts after all others; of rows repeating text and id, one
stays (the first read); input columns named like a result column are replaced by it; all others are carried along.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .exchange import stage

#: Bits of one of Spark's bitmaps.
BLOCK_BITS = 32768
BITS_PER_ROW = 16
PROBES = 3
SLICE_BLOCKS = 8192
MAX_SLICES = 8
HOT_ROWS = 1000
HOT_GROUPS = 50_000
RESULT = ("keep_id", "group_size", "kept", "text_sha256")


def text_digest(text: Column) -> Column:
    """SHA-256 (lower-case hex) of the text with each run of white space as one space, in UTF-8."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", " "), 256)


def _probes(sha: Column, blocks: int) -> tuple[Column, list[Column]]:
    """The block of a digest, and its bits in that block."""
    places = F.xxhash64(sha, F.lit(1))
    return (F.pmod(F.xxhash64(sha), F.lit(blocks)),
            [F.shiftrightunsigned(places, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(PROBES)])


def _is_set(bits: Column, place: Column) -> Column:
    """Whether a bit of a bitmap (binary) is set; null for no bitmap."""
    byte = F.conv(F.hex(F.substr(bits, F.floor(place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.bit_get(byte, place % 8) == 1


def repeated_bits(digests: DataFrame, blocks: int) -> DataFrame:
    """First pass: (block, bits) of the places that more than one row set; blocks without any are left out."""
    block, places = _probes(F.col("sha"), blocks)
    hits = digests.select(block.alias("block"), F.explode(F.array_distinct(F.array(*places))).alias("place"))
    twice = hits.groupBy("block", "place").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return twice.groupBy("block").agg(F.bitmap_construct_agg(F.col("place").cast("long")).alias("bits"))


def with_suspicion(rows: DataFrame, seen_twice: DataFrame, blocks: int) -> DataFrame:
    """Second pass: ``maybe`` tells whether a row's text may occur again. Nothing is shuffled."""
    block, places = _probes(F.col("sha"), blocks)
    rows, found = rows.withColumn("block", block), []
    for k in range(ceil(blocks / SLICE_BLOCKS)):
        low = k * SLICE_BLOCKS
        part = (seen_twice.where((F.col("block") >= low) & (F.col("block") < low + SLICE_BLOCKS))
                .select(F.col("block").alias(f"block{k}"), F.col("bits").alias(f"bits{k}")))
        rows = rows.join(F.broadcast(part), F.col("block") == F.col(f"block{k}"), "left")    # at most 32 MB
        found.append(F.col(f"bits{k}"))
    bits, every = F.coalesce(*found), F.lit(True)
    for place in places:
        every = every & _is_set(bits, place)
    return rows.select("row", "id", "sha", "at", F.coalesce(every, F.lit(False)).alias("maybe"))


def exact_dedup(docs: DataFrame, id: str = "doc_id", text: str = "text", carry: Sequence[str] | None = None) -> DataFrame:
    """All rows of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    ``carry`` names the columns to take along (default: all); only these travel with the rows that shuffle.
    """
    names = [c for c in (docs.columns if carry is None else carry) if c.lower() not in RESULT]
    total = docs.count()
    blocks = min(max(1, ceil(total * BITS_PER_ROW / BLOCK_BITS)), SLICE_BLOCKS * MAX_SLICES)
    # The columns travel as one struct, so no name of theirs can clash with those used here.
    rows = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in names]).alias("row"),
                       F.col(f"`{id}`").alias("id"), text_digest(F.col(f"`{text}`")).alias("sha"),
                       F.monotonically_increasing_id().alias("at"))
    seen_twice = stage(repeated_bits(rows.select("sha"), blocks), "repeated-bits")
    tested = with_suspicion(rows, seen_twice, blocks)
    # Staged once, so that the place of a row (``at``) is the same for all that read it.
    suspects = stage(tested.where("maybe").drop("maybe"), "dedup-suspects")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("at")))
    groups = stage(suspects.groupBy("sha").agg(F.count(F.lit(1)).alias("size"), first.alias("first")), "dedup-groups")
    # A group that holds much of the table does not meet in one task: its rows are looked up where they lie. At most
    # HOT_GROUPS groups can be that large, which bounds what is broadcast.
    hot = F.col("size") >= max(HOT_ROWS, ceil(total / HOT_GROUPS))
    large = groups.where(hot).select(F.col("sha").alias("key"), F.col("size"), F.col("first"))
    looked_up = suspects.join(F.broadcast(large), F.col("sha") == F.col("key"), "left")
    met = looked_up.where("key IS NOT NULL").drop("key").unionByName(
        looked_up.where("key IS NULL").drop("key", "size", "first").join(groups.where(~hot), "sha"))
    among = met.select(
        "row", F.col("first.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("at") == F.col("first.at")).alias("kept"), F.col("sha").alias("text_sha256"))
    alone = tested.where("NOT maybe").select(
        "row", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"),
        F.col("sha").alias("text_sha256"))
    return alone.unionByName(among).select(*[F.col("row")[c].alias(c) for c in names], *RESULT)


ORACLE = """
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256
           FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id NULLS LAST) = 1 AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)"""
