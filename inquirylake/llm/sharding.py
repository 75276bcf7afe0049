"""Op 10: weighted rendezvous hashing of record keys over shards, in DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Blocks that keys are dealt over by their hash, and blocks of each by content.
BLOCK_KEYS, CONTENT_BLOCKS = 1024, 16


def _bits(text: Column) -> Column:
    """The first 48 bits of a text's MD5 digest, as a long."""
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long")


def rendezvous(key: Column, weights: Sequence[float]) -> Column:
    """The shard whose -ln(u)/weight is least, u being a uniform hash of key and shard.

    The hash is the first 48 bits of the MD5 digest of 'key:shard'.
    Adding a shard adds one candidate and changes no other, so records move only into it; raising
    a weight moves records only towards that shard.  Ties go to the smaller shard.  A null key is
    hashed as the text 'null'.
    """
    text = F.coalesce(key.cast("string"), F.lit("null"))
    tries = []
    for shard, weight in enumerate(weights):
        if not weight > 0:
            raise ValueError("weights must be positive")
        uniform = (_bits(F.concat(text, F.lit(f":{shard}"))).cast("double") + 0.5) / float(2**48)
        tries.append(F.struct((-F.ln(uniform) / float(weight)).alias("cost"), F.lit(shard).alias("shard")))
    return F.array_min(F.array(*tries))["shard"]


def shard(df: DataFrame, key: str = "doc_id", text: str = "text", weights: Sequence[float] = (1.0,) * 8) -> DataFrame:
    """One row per input row: key, size, text_crc32, law 'key', shard, slot, grown_shard.

    slot numbers a shard's rows without gaps from 0, in the order of (key block, content block,
    key, checksum, size); the key and the number of shards alone decide the shard.  Keys may be of
    any type that casts to text, as sparse as they like: blocks are by hash, and their number is
    fixed.  grown_shard is
    the shard with one more of weight 1.

    Null key: one key of its own.  Null or empty text: size 1, checksum 0.  Repeated rows: each
    gets its own slot in the same shard.  Empty table: no rows.  Other columns are ignored.
    Slots come from a count for each block and a running number within it, so no shard and no key
    block is ordered in one task; a key that many rows share is dealt by content.
    """
    content = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = df.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(content) + 1).cast("long").alias("size"),
        F.crc32(F.encode(content, "UTF-8")).alias("text_crc32"),
    )
    rows = rows.select(
        "*",
        rendezvous(F.col("doc_id"), weights).alias("shard"),
        rendezvous(F.col("doc_id"), [*weights, 1.0]).alias("grown_shard"),
        F.pmod(_bits(F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))), F.lit(BLOCK_KEYS)).cast("int").alias("key_block"),
        (F.col("text_crc32") % CONTENT_BLOCKS).alias("content_block"),
    )
    block = ["shard", "key_block", "content_block"]
    before = Window.partitionBy("shard").orderBy("key_block", "content_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy(*block).agg(F.count("*").alias("n")).select(*block, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy(*block).orderBy("doc_id", "text_crc32", "size")
    return (
        rows.withColumn("at", F.row_number().over(within) - 1)
        .join(starts, block)
        .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("base") + F.col("at")).cast("long").alias("slot"), F.col("grown_shard").cast("int").alias("grown_shard"))
    )
