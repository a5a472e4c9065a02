"""Anti and semi joins that shuffle only the rows whose key may be on the other side.

The keys of the smaller side are aggregated to a Bloom filter: a table of at most ``words``
words of 64 bits, in which each key sets a few bits of one word. It is the only thing that is
broadcast, and its size is bounded by ``words`` whatever the number of keys. A row whose bits are not all set has no
partner and passes without a shuffle; the others go through the ordinary join, so the result
is exact. With many more keys than ``16 * words`` the filter lets everything through and the
join does all the work, as without it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORDS = 1 << 20
BITS = 5


def _word(keys: Sequence[str], words: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(words).cast("long"))


def _mask(keys: Sequence[str]) -> Column:
    """The bits of a key in its word, cut from a second hash."""
    mixed = F.xxhash64(*keys, F.lit("bits"))
    mask = F.lit(0).cast("long")
    for i in range(BITS):
        place = F.shiftrightunsigned(mixed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def build(keys: DataFrame, on: Sequence[str], words: int = WORDS) -> DataFrame:
    """(word, bits): the filter of all keys. Equal words collapse before the shuffle."""
    return keys.select(_word(on, words).alias("_word"), _mask(on).alias("_mask")).groupBy("_word").agg(F.bit_or("_mask").alias("_bits"))


def marked(rows: DataFrame, bloom: DataFrame, on: Sequence[str], words: int = WORDS, name: str = "_maybe") -> DataFrame:
    """Rows with whether their key may be among those of the filter; keys with a null are among none."""
    mask = _mask(on)
    whole = F.lit(True)
    for key in on:
        whole = whole & F.col(key).isNotNull()
    tagged = rows.withColumn("_word", F.when(whole, _word(on, words)))
    found = tagged.join(F.broadcast(bloom), "_word", "left")
    return found.withColumn(name, F.coalesce(F.col("_bits").bitwiseAND(mask) == mask, F.lit(False))).drop("_word", "_bits")


def anti_join(rows: DataFrame, keys: DataFrame, on: Sequence[str], words: int = WORDS) -> DataFrame:
    """``rows`` without those whose key is in ``keys``. ``rows`` is read twice; give a scan or a stored table."""
    on = list(on)
    tagged = marked(rows, build(keys, on, words), on, words)
    apart = tagged.where(~F.col("_maybe")).select(*rows.columns)
    met = tagged.where(F.col("_maybe")).select(*rows.columns).join(keys.select(*on), on, "left_anti")
    return apart.unionByName(met)


def semi_join(rows: DataFrame, keys: DataFrame, on: Sequence[str], words: int = WORDS) -> DataFrame:
    """The rows whose key is in ``keys``."""
    on = list(on)
    tagged = marked(rows, build(keys, on, words), on, words)
    return tagged.where(F.col("_maybe")).select(*rows.columns).join(keys.select(*on), on, "left_semi")
