"""Joins."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import add, and_

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from millrace.operators.frequent import frequent_keys, key_hash
from millrace.operators.partitions import planned_bytes
from millrace.workspace import materialize

# A side within all limits is broadcast: by Spark's estimate, and by counting its rows and decoded bytes.
SMALL_SIDE_BYTES = 10 * 1024 * 1024
SMALL_SIDE_ROWS = 1_000_000

# A key is spread over several tasks once it holds more rows than this. There are at most
# rows / ROWS_PER_TASK such keys, each a hash and a number of pieces wherever they are sent.
ROWS_PER_TASK = 1_000_000


def lookup_join(fact: DataFrame, lookup: DataFrame, fact_key: str, lookup_key: str, how: str = "inner") -> DataFrame:
    """Add the columns of a lookup table and drop its key.

    There is no broadcast hint: Spark broadcasts a lookup whose size it knows to be below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides otherwise.
    With ``how="inner"`` codes missing from the lookup drop their rows, with ``"left"`` they stay.
    """
    return fact.join(lookup, fact[fact_key] == lookup[lookup_key], how).drop(lookup[lookup_key])


def hot_keys(counts: DataFrame, key: Sequence[str], count: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """The keys too large for one task, as ``_hot`` (their hash), with the number of pieces ``_pieces`` for each."""
    heavy = counts.where(F.col(count) > rows_per_task)
    pieces = F.ceil(F.col(count) / rows_per_task).alias("_pieces")
    # two keys with one hash share the larger number of pieces
    return heavy.select(key_hash(key).alias("_hot"), pieces).groupBy("_hot").agg(F.max("_pieces").alias("_pieces"))


def _equal_join(left: DataFrame, right: DataFrame, key: Sequence[str], how: str, null_safe: bool) -> DataFrame:
    """Join on columns that both sides name alike and keep them once; a null equals a null if ``null_safe``."""
    if not null_safe:
        return left.join(right, list(key), how)
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in key})
    same = reduce(and_, [left[k].eqNullSafe(renamed[f"_right_{k}"]) for k in key])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in key])


def salted_join(
    fact: DataFrame,
    other: DataFrame,
    key: str | Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    *,
    key_counts: DataFrame | None = None,
    rows_per_task: int = ROWS_PER_TASK,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join (``inner`` or ``left``) that spreads the hot keys of ``fact`` over many tasks.

    A hot key gets one piece per ``rows_per_task`` rows. Each of its fact rows falls in the piece
    that the hash of ``salt_by`` picks, so ``salt_by`` should name a unique id; the matching rows of
    ``other`` are repeated for each piece. All other keys have one piece and are joined as usual.
    ``key_counts`` may bring counts that already exist, as the key columns and ``n``; without them hot keys are found
    by a sketch, see ``frequent_keys``, and keys that are not hot are not counted. With ``null_safe`` a null key
    matches a null key.
    """
    key = [key] if isinstance(key, str) else list(key)
    if key_counts is None:
        key_counts = materialize(frequent_keys(fact, key, rows_per_task), "hot-keys")
    # sixteen bytes for each key above rows_per_task; no hint, Spark broadcasts it while it is small. Written down, since
    # Spark would take it to be as large as the counts and shuffle both sides for it
    hot = materialize(hot_keys(key_counts, key, "n", rows_per_task), "hot-pieces")

    def with_pieces(df: DataFrame) -> DataFrame:
        return df.withColumn("_hash", key_hash(key)).join(hot, F.col("_hash") == F.col("_hot"), "left").drop("_hot", "_hash")

    first = F.lit(0).cast("bigint")
    picked = F.pmod(F.xxhash64(*salt_by), F.col("_pieces"))
    salted = with_pieces(fact).withColumn("_piece", F.coalesce(picked, first))
    all_pieces = F.sequence(first, F.coalesce(F.col("_pieces") - 1, first))
    repeated = with_pieces(other).withColumn("_piece", F.explode(all_pieces))
    joined = _equal_join(salted.drop("_pieces"), repeated.drop("_pieces"), [*key, "_piece"], how, null_safe)
    return joined.drop("_piece")


def rows_and_bytes(df: DataFrame) -> tuple[int, int]:
    """The number of rows of ``df`` and about how many bytes they take once decoded, from one aggregate."""

    def width(field) -> Column:
        name, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, StringType | BinaryType):
            return F.coalesce(F.octet_length(name), F.lit(0)) + 16
        if isinstance(kind, ArrayType | MapType | StructType):
            return F.coalesce(F.octet_length(F.to_json(F.struct(name))), F.lit(0)) + 16
        return F.lit(16)

    total = F.sum(reduce(add, [width(f).cast("bigint") for f in df.schema.fields], F.lit(8)))
    row = df.agg(F.count("*").alias("n"), F.coalesce(total, F.lit(0)).alias("size")).first()
    return row["n"], row["size"]


def fits_broadcast(df: DataFrame) -> bool:
    """Whether ``df`` is small, by its decoded size: that of files tells little, since columns compress well."""
    if df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold").startswith("-"):
        return False
    if planned_bytes(df) > SMALL_SIDE_BYTES:
        return False
    rows, size = rows_and_bytes(df)
    return rows <= SMALL_SIDE_ROWS and size <= SMALL_SIDE_BYTES


def skew_safe_join(
    fact: DataFrame,
    other: DataFrame,
    key: str | Sequence[str],
    salt_by: Sequence[str],
    how: str = "inner",
    *,
    key_counts: DataFrame | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Equi-join (``inner`` or ``left``) that no hot key of ``fact`` can stall.

    A small ``other`` is broadcast and ``fact`` stays where it is; otherwise both are shuffled with
    the hot keys salted, see ``salted_join``.
    """
    if fits_broadcast(other):
        return _equal_join(fact, F.broadcast(other), [key] if isinstance(key, str) else list(key), how, null_safe)
    return salted_join(fact, other, key, salt_by, how, key_counts=key_counts, null_safe=null_safe)
