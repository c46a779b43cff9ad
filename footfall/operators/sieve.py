"""A bitmap of keys of fixed size, against which a large table is thinned out before anything of it is shuffled.

Each key sets one of ``BITS`` bits by its hash. The bits lie in rows of ``ROW_BITS``, so the whole bitmap is at most 4,096
rows of 4 KB whatever the number of keys, and may always be broadcast. A row of the other table whose bit is not set
has none of the keys. A few rows pass by accident, about one in (bits / keys), so an exact join must follow. Beyond some
hundred million keys most rows pass: the bitmap then saves nothing, and the result is the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of the bitmap: 16 MB.
BITS = 1 << 27
#: Bits of a row: what ``bitmap_construct_agg`` holds.
ROW_BITS = 1 << 15


def _bit(key: str) -> Column:
    """The bit of a key. A missing key and a blank one share theirs, as the fact stores one as the other."""
    return F.pmod(F.xxhash64(F.coalesce(F.col(key).cast("string"), F.lit(""))), F.lit(BITS))


def bitmap(keys: DataFrame, key: str) -> DataFrame:
    """``_row``, ``_bits``: the bitmap of a column of keys. Repeated keys are harmless."""
    bits = keys.select(_bit(key).alias("_bit")).distinct()
    row, place = F.floor(F.col("_bit") / ROW_BITS).alias("_row"), F.pmod("_bit", F.lit(ROW_BITS))
    return bits.groupBy(row).agg(F.bitmap_construct_agg(place).alias("_bits"))


def thinned(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """The rows whose key is among ``keys``, and a few others. ``rows`` are not shuffled."""
    bit = _bit(key)
    place = F.pmod(bit, F.lit(ROW_BITS))
    byte = F.substring("_bits", (F.floor(place / 8) + 1).cast("int"), F.lit(1))
    is_set = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), F.pmod(place, F.lit(8)).cast("int")) == 1
    found = F.broadcast(bitmap(keys, key))
    return rows.join(found, (F.floor(bit / ROW_BITS) == F.col("_row")) & is_set, "left_semi")
