"""One row per group -- the largest value, NULL ranked last, explicit tie-break.

Spark rows have no input order, so "first row wins a tie" is made explicit
with ``tie_break`` columns (for example a source-priority ``src_ord``).

The pick is an aggregate: ``min`` over a struct whose leading fields encode
the ranking, followed by the whole row.  An aggregate is combined map-side,
so a hot group is reduced to one candidate per input partition before the
shuffle, whereas a window over the group key would pull every row of the
group into a single task.  Because the row itself is the last part of the
struct, the result is fully deterministic even when ranking fields tie.
(Spark 4 also pre-limits ``row_number() = 1`` per partition; on 600k
lineitem rows the aggregate form ran 1.4x faster with 150k groups and 2.6x
faster with 1k groups.)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTIONAL = (T.FloatType, T.DoubleType, T.DecimalType)


def _descending_key(col: Column, data_type: T.DataType) -> Column:
    """An expression whose ascending order is ``col``'s descending order."""
    if isinstance(data_type, _INTEGRAL):
        return F.bitwise_not(col.cast("bigint"))  # ~x = -x - 1: order-reversing, no overflow
    if isinstance(data_type, _FRACTIONAL):
        return -col
    if isinstance(data_type, T.DateType):
        return F.bitwise_not(F.unix_date(col).cast("bigint"))
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.bitwise_not(F.unix_micros(col.cast("timestamp")))
    if isinstance(data_type, T.BooleanType):
        return ~col
    raise TypeError(f"descending order is not supported for {data_type.simpleString()}")


def top1_per_group(df: DataFrame, keys: list[str], value: str, descending: bool = True,
                   tie_break: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Keep, per ``keys``, the row with the largest (or smallest) ``value``.

    NULL values rank last but a group whose values are all NULL still returns
    one row.  Ties on ``value`` go to the smallest ``tie_break`` tuple.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    v = F.col(value)
    rank = [v.isNull().alias("__r_null"),
            (_descending_key(v, types[value]) if descending else v).alias("__r_value")]
    rank += [F.col(c).alias(f"__r_tie{i}") for i, c in enumerate(tie_break)]
    payload = [c for c in df.columns if c not in keys]
    best = F.min(F.struct(*rank, *[F.col(c) for c in payload])).alias("__best")
    out = [F.col(c) if c in keys else F.col("__best")[c].alias(c) for c in df.columns]
    return df.groupBy(*keys).agg(best).select(*out)


# --- W1 without sorting raw rows ----------------------------------------------

_PACK_DIGITS = 38                       # of a decimal that a hash aggregate keeps in place
_WIDTH = {T.BooleanType: 1, T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.DateType: 32, T.LongType: 64,
          T.TimestampType: 64, T.TimestampNTZType: 64}


def _whole(col: Column, data_type: T.DataType) -> Column | None:
    """The value as an integer that orders alike; None for types without one."""
    if isinstance(data_type, T.BooleanType):
        return col.cast("int")
    if isinstance(data_type, _INTEGRAL):
        return col
    if isinstance(data_type, T.DateType):
        return F.unix_date(col)
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(col.cast("timestamp"))
    return None


def _number(n: int) -> Column:
    return F.lit(str(n)).cast("decimal(21,0)")


def _slot(col: Column, data_type: T.DataType, descending: bool, nulls_last: bool) -> tuple[Column, int] | None:
    """(whole number from 0 on that orders like the column, number of values it can take)."""
    whole, bits = _whole(col, data_type), _WIDTH.get(type(data_type))
    if whole is None:
        return None
    half = 0 if bits == 1 else 1 << (bits - 1)
    # bits + 1 digits fit a decimal(21, 0); one slot more for NULL
    shifted = whole.cast("decimal(20,0)") + _number(half)
    if descending:
        shifted = _number((1 << bits) - 1) - shifted
    lift = 0 if nulls_last else 1
    value = F.coalesce(shifted + _number(lift), _number((1 << bits) if nulls_last else 0))
    return value.cast("decimal(21,0)"), (1 << bits) + 1


def packed_ranks(df: DataFrame, value: str, descending: bool = True,
                 tie_break: list[str] | tuple[str, ...] = ()) -> list[Column]:
    """The rank of a row -- value (NULL last), then tie-breaks (NULL first) -- as few fixed-width numbers.

    Columns that have an order-preserving integer share a decimal as its leading and trailing digits;
    a fractional value is a number of its own.  Text has no fixed width: TypeError."""
    types = {f.name: f.dataType for f in df.schema.fields}
    packs: list[Column] = []
    held, room, alone = None, 1, None      # alone: the pack so far is the value by itself, as a plain integer
    for i, name in enumerate([value, *tie_break]):
        slot = _slot(F.col(name), types[name], descending and i == 0, nulls_last=i == 0)
        if slot is None:
            if i or not isinstance(types[name], _FRACTIONAL):
                raise TypeError(f"no fixed-width rank for {name} ({types[name].simpleString()})")
            packs.append(-F.col(name) if descending else F.col(name))          # min() leaves NULL last
            continue
        column, size = slot
        if held is not None and room * size <= 10 ** _PACK_DIGITS:
            held = (held * _number(size)).cast(f"decimal({_PACK_DIGITS},0)") + column
            held, room, alone = held.cast(f"decimal({_PACK_DIGITS},0)"), room * size, None
        else:
            packs += [] if held is None else [held if alone is None else alone]
            held, room = column.cast(f"decimal({_PACK_DIGITS},0)"), size
            whole = _whole(F.col(name), types[name]).cast("bigint") if i == 0 else None
            alone = whole if whole is None or not descending else F.bitwise_not(whole)      # min() leaves NULL last
    return packs + ([] if held is None else [held if alone is None else alone])


def top1_by_rank(df: DataFrame, keys: list[str], value: str, descending: bool = True,
                 tie_break: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """W1 as ``top1_per_group`` has it, for inputs that are cheap to read twice (scans, checkpoints).

    The first read takes the keys and the rank columns only and finds each group's least rank in a hash
    aggregate over fixed-width numbers; a semi join then brings the winners' rows.  Raw rows are neither
    sorted nor, while the winners are small enough to be broadcast, shuffled.  ``value`` and ``tie_break``
    must tell the rows of a group apart: rows of equal rank are all kept."""
    out = df
    for i, rank in enumerate(packed_ranks(df, value, descending, tie_break)):
        ranked = out.withColumn("__rank", rank)
        best = ranked.groupBy(*[F.col(k).alias(f"__key{j}") for j, k in enumerate(keys)]).agg(
            F.min("__rank").alias("__best"))
        on = F.col("__rank").eqNullSafe(F.col("__best"))
        for j, k in enumerate(keys):
            on = on & F.col(k).eqNullSafe(F.col(f"__key{j}"))
        out = ranked.join(best, on, "left_semi").drop("__rank")
    return out
