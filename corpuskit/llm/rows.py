"""Taking decided rows out of a table without moving the others.

Keys of rows to look at are set in a bitmap of bounded size, which goes to all
tasks. Rows whose key misses it stay where they are; only hits, few of them
false, are joined with the exact keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskit.llm import scratch

#: A bitmap has this many bits at least and at most (2 MB and 128 MB): eight for each key up to 10^8 keys. Beyond
#: that it fills up, and the rows that it lets through by mistake, all of them in the end, are joined like the others.
BITS = (1 << 24, 1 << 30)


def _bit(key: Column, bits: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(bits)) + 1


class Bitmap:
    """Which values of a column there may be; built by Spark, in parts of 4 KB, and written to the shared folder."""

    def __init__(self, keys: DataFrame, column: str):
        count, self.bits = keys.count(), BITS[0]
        self.count = count
        while self.bits < BITS[1] and self.bits < 8 * count:
            self.bits *= 2
        at = _bit(F.col(column), self.bits)
        set_bits = keys.select(F.bitmap_bucket_number(at).alias("_part"), F.bitmap_bit_position(at).alias("_bit"))
        self.parts = scratch.materialise(set_bits.groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits")), "bitmap")

    def mark(self, rows: DataFrame, column: str) -> DataFrame:
        """``rows`` with ``hit``: false where the column's value is surely not among the keys."""
        at = _bit(F.col(column), self.bits)
        found = rows.withColumns({"_part": F.bitmap_bucket_number(at), "_bit": F.bitmap_bit_position(at)})
        # At most bits / 8 bytes, whatever the input: 128 MB, and a byte for each key.
        found = found.join(F.broadcast(self.parts), "_part", "left")
        byte = F.conv(F.hex(F.expr("substring(_bits, cast(_bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
        mask = F.expr("shiftleft(1, cast(_bit % 8 as int))")
        return found.withColumn("hit", F.coalesce(byte.bitwiseAND(mask) != 0, F.lit(False))).drop("_part", "_bit", "_bits")


def without(docs: DataFrame, key: Column, gone: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs``, all columns, without rows whose key is in ``gone``; of rows that share a key in ``repeated`` one stays.

    ``key`` must not be null (a struct of nullable parts isn't); the other two
    tables have it as ``key``, each value once.
    """
    look = Bitmap(gone.union(repeated), "key")
    marked = look.mark(docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), key.alias("key")), "key")
    hits = marked.where("hit").join(gone, "key", "left_anti").select("key", "doc")
    if not repeated.isEmpty():
        one = hits.join(repeated, "key", "left_semi").groupBy("key").agg(F.first("doc").alias("doc"))
        hits = hits.join(repeated, "key", "left_anti").unionByName(one)
    kept = marked.where("not hit").select("doc").union(hits.select("doc"))
    return kept.select(*(F.col(f"doc.`{c}`").alias(c) for c in docs.columns))
