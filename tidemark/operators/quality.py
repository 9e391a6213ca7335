"""Uniqueness, ordered rules, and the valid / invalid split."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contracts import Entity
from tidemark.functions.conditions import broken_rules


#: Bits of the filter over hashes of repeated keys: 512 KB in every task, however many keys repeat.
FILTER_BITS = 1 << 22
WORD_BITS = 6
WORD = 1 << WORD_BITS
#: With more repeated keys than this, every fifth row whose key does not repeat would pass the filter, or more.
MOST_FILTERED = FILTER_BITS // 4


def repeated_keys(rows: DataFrame, key: str, *within: str) -> DataFrame:
    """Non-NULL keys that occur more than once (in the same ``within``), with their number of copies.

    NULL keys count as none, which sorts them out; a filter before would read each key from its text once more.
    """
    return rows.groupBy(key, *within).agg(F.count(key).alias("copies")).where(F.col("copies") > 1)


def _place(*columns: str) -> Column:
    """The bit of the filter that belongs to a row's ``columns``; never NULL, so that a join on it filters nothing before."""
    return F.xxhash64(*columns).bitwiseAND(FILTER_BITS - 1)


def _word(place: Column) -> Column:
    return F.shiftright(place, WORD_BITS).cast("int")


def _bit(place: Column) -> Column:
    return place.bitwiseAND(WORD - 1).cast("int")


def _filter_of(repeated: DataFrame, *columns: str) -> Column:
    """One bit for each place of a hash, set for those of ``repeated``'s ``columns``; NULL with too many of them to be told apart.

    An array of words that a scalar subquery makes of the repeated keys: of fixed size, whatever their number.
    """
    place = _place(*columns)
    set_bits = F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), _bit(place)))
    some = repeated.groupBy(_word(place).alias("word")).agg(set_bits.alias("bits"), F.count(F.lit(1)).alias("n_keys"))
    every = repeated.sparkSession.range(FILTER_BITS // WORD).select(F.col("id").cast("int").alias("word"))
    entry = F.struct("word", F.coalesce("bits", F.lit(0).cast("bigint")).alias("bits"))
    words = every.join(some, "word", "left").agg(F.sort_array(F.collect_list(entry)).alias("words"), F.sum("n_keys").alias("n_keys"))
    few = F.coalesce("n_keys", F.lit(0)) <= MOST_FILTERED
    return words.select(F.when(few, F.transform("words", lambda w: w["bits"]))).scalar()


def _looked_up(rows: DataFrame, marks: DataFrame, key: str, *within: str) -> DataFrame:
    """``rows`` with ``is_unique``, from a join with the repeated keys ``marks``.

    The route is a join key of its own, for which both sides are dealt out anew, so that both can be split. A NULL key
    has no copies; such rows are dealt out by what else they hold. ``marks`` has no NULL key: that its comparison is
    null-safe only keeps Spark from filtering the keys, and so reading each twice, before they are counted.
    """
    hashable = [name for name, kind in rows.dtypes if "map<" not in kind and "variant" not in kind]
    route = F.when(F.col(key).isNull(), F.xxhash64(*hashable)).otherwise(F.xxhash64(key, *within))
    marked = marks.select(*[F.col(c).alias(f"_repeated_{c}") for c in (key, *within)], F.xxhash64(key, *within).alias("_repeated_route"), F.lit(False).alias("is_unique"))
    same = F.col(key).eqNullSafe(F.col(f"_repeated_{key}")) & (F.col("_route") == F.col("_repeated_route"))
    for column in within:
        same = same & (F.col(column) == F.col(f"_repeated_{column}"))
    is_unique = F.coalesce("is_unique", F.lit(True)).alias("is_unique")
    return rows.withColumn("_route", route).join(marked, same, "left").select(*rows.columns, is_unique)


def mark_unique(
    rows: DataFrame,
    key: str,
    repeated: DataFrame | None = None,
    broadcast_repeated: bool = False,
    within: Sequence[str] = (),
    many_repeated: bool = False,
) -> DataFrame:
    """Add ``is_unique``: false on every copy of a repeated key; NULL keys are unique.

    Copies count within the same values of ``within`` (such as the batch). Repeated
    keys are counted on the key column, with partial sums. A filter of fixed
    size over their hashes then tells most rows, where they are read, that their key
    cannot repeat; these are not moved. The others look their key up in a join
    whose large partitions adaptive execution splits, so a hot key needs no bound
    and no list, and were all keys repeated, all rows would join. So they do with
    more repeated keys than the filter can tell apart, found while the plan runs:
    the branch of rows that stay then drops them before it computes anything.

    ``repeated`` takes an already computed :func:`repeated_keys`;
    ``broadcast_repeated`` is for callers who measured it and found it small: the
    rows are then read once. ``many_repeated`` is for those who found more keys than
    the filter can tell apart: all rows are looked up then, and read once.
    """
    columns = [key, *within]
    marks = repeated_keys(rows, *columns) if repeated is None else repeated
    if broadcast_repeated:
        marked = F.broadcast(marks.select(*columns, F.lit(False).alias("is_unique")))
        is_unique = F.coalesce("is_unique", F.lit(True)).alias("is_unique")
        return rows.join(marked, columns, "left").select(*rows.columns, is_unique)
    if many_repeated:
        return _looked_up(rows, marks, *columns)
    bits = _filter_of(marks, *columns)
    place = F.when(F.col(key).isNotNull(), _place(*columns))
    # Generated, and told apart by it alone: Spark puts the expressions of columns in place of their names to filter at the
    # source, and written out for every use, values read from text grow beyond what can be compiled.
    placed = F.explode(F.array(place)).alias("_place")
    may_repeat = F.coalesce(F.getbit(F.get(bits, _word(F.col("_place"))), _bit(F.col("_place"))) == 1, F.lit(False))
    alone = rows.where(bits.isNotNull()).select("*", placed).where(~may_repeat)
    others = rows.select("*", placed).where(bits.isNull() | may_repeat)
    return alone.select(*rows.columns, (~may_repeat).alias("is_unique")).unionByName(_looked_up(others.drop("_place"), marks, *columns))


def validate(
    rows: DataFrame,
    entity: Entity,
    repeated: DataFrame | None = None,
    broadcast_repeated: bool = False,
    within: Sequence[str] = (),
    many_repeated: bool = False,
) -> DataFrame:
    """Add ``is_unique``, ``quality_errors`` and ``is_valid`` to standardized rows."""
    marked = mark_unique(rows, entity.key, repeated, broadcast_repeated, within, many_repeated)
    checked = marked.withColumn("quality_errors", broken_rules(entity.rules))
    return checked.withColumn("is_valid", F.size("quality_errors") == 0)


def valid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(F.col("is_valid"))


def invalid_rows(validated: DataFrame) -> DataFrame:
    return validated.where(~F.col("is_valid"))


def count_columns() -> list:
    """Total, valid and invalid row counts, in one pass."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if("is_valid").alias("valid_rows"),
        F.count_if(~F.col("is_valid")).alias("invalid_rows"),
    ]


def batch_counts(validated: DataFrame, *by: str) -> DataFrame:
    return validated.groupBy(*by).agg(*count_columns())


def error_counts(validated: DataFrame, *by: str) -> DataFrame:
    """Rows per broken rule (a row counts once under each of its rules)."""
    errors = validated.select(*by, F.explode("quality_errors").alias("error"))
    return errors.groupBy(*by, "error").agg(F.count(F.lit(1)).alias("row_count"))
