"""J1 a join to one row per key that no hot key can hold up.

A subscription may hold a third of all orders; a shuffled join on it would put them into one task, and AQE does not split
a join whose other side is an aggregate.  Here the aggregate itself says how many rows a key has: the rows of a key with
over 1/``share`` of them get one of several salts, and the key's one row is repeated once per salt.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A key with more than 1/HOT_SHARE of all rows is hot: there are fewer than HOT_SHARE of them.
HOT_SHARE = 1000


def join_one_per_key(rows: DataFrame, side: DataFrame, key: str, weight: str, spread: Column, share: int = HOT_SHARE) -> DataFrame:
    """``rows`` inner-joined to ``side``, which has one row per ``key`` and in ``weight`` the (about) number of its rows.

    The total and the hot keys with their salts are scalar subqueries, the latter a map of fewer than ``share`` entries whatever
    the data; so ``rows`` is joined once and nothing is broadcast.  The repeated rows of ``side`` are fewer than 2 * ``share``.
    ``weight`` is not kept.
    A null key joins with nothing; an empty ``side`` gives an empty result.
    """
    total = side.agg(F.sum(weight)).scalar()
    is_hot = F.col(weight) * F.lit(share) > total
    salts = F.ceil(F.col(weight) * F.lit(share) / total).cast("int")
    hot = side.where(is_hot & F.col(key).isNotNull()).agg(F.map_from_entries(F.collect_list(F.struct(F.col(key), salts)))).scalar()
    salt = F.pmod(F.xxhash64(spread), F.try_element_at(hot, F.col(key))).cast("int")
    salted = rows.withColumn("_salt", F.coalesce(salt, F.lit(0)))
    repeated = (side.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.when(is_hot, salts - 1).otherwise(F.lit(0)))))
                .drop(weight))
    return salted.join(repeated, [key, "_salt"]).drop("_salt")
