"""Deterministic one-row-per-key reduction in one scan.

``first(c, ignorenulls=True)`` depends on row order, so reruns can differ.
Here "first" means: the value of ``c`` on the first row, by the given order,
among rows where ``c`` is not NULL.  As in the original job, each column's
first value may come from a different row.

Everything that every row takes part in is a hash aggregation of fixed-width
values, so a key holding a third of all rows is combined on the map side and
the input is never sorted:

* By a unique fixed-width order key, fixed-width columns use ``min_by``.  Text
  goes through the same aggregation as a lossless number: an ISO date as its
  digits, a text of up to seven bytes as its bytes.
* Without a unique key the order is a list of columns.  A leading (date,
  latitude, longitude) is packed into one decimal whose order agrees with the
  columns'; the values are read back from it.

What a number cannot hold (longer texts, coordinates of more than ten decimal
places on the winning row, columns after the packed ones) is fetched: keys
with such a column are joined with the rows, and their candidates are ranked.
In ordinary data no key needs that.  The join's small side is then empty, and
adaptive execution drops the second scan.  Values are taken as they are; no
date format is assumed.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DoubleType, NumericType, StringType, TimestampType

_FIXED = (NumericType, BooleanType, DateType, TimestampType)

#: A text of up to this many bytes has a number.
SHORT = 7


def is_fixed_width(kind: DataType) -> bool:
    return isinstance(kind, _FIXED)


def first_by(column: str, order_key: Column | str) -> Column:
    """First non-null value of ``column`` by ``order_key``."""
    c = F.col(column)
    order = F.col(order_key) if isinstance(order_key, str) else order_key
    return F.min_by(c, F.when(c.isNotNull(), order))


def _iso(c: Column) -> Column:
    return (F.octet_length(c) == 10) & c.rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}")


def _digits(c: Column) -> Column:
    return F.translate(c, "-", "").cast("int")


def _iso_text(digits: Column) -> Column:
    d = F.lpad(digits.cast("string"), 8, "0")
    return F.concat_ws("-", F.substring(d, 1, 4), F.substring(d, 5, 2), F.substring(d, 7, 2))


def text_code(c: Column) -> Column:
    """A long that a text can be read back from, or 0 if it has none (NULL stays NULL).

    ISO dates are negative; other texts of up to :data:`SHORT` bytes are their
    bytes behind a leading 1.
    """
    code = F.conv(F.concat(F.lit("1"), F.hex(c)), 16, 10).cast("long")
    return F.when(_iso(c), (-_digits(c) - 1).cast("long")).when(F.octet_length(c) <= SHORT, code) \
        .when(c.isNotNull(), F.lit(0).cast("long"))


def text_of(code: Column) -> Column:
    """The text of a :func:`text_code` (NULL for 0)."""
    raw = F.unhex(F.substring(F.hex(code), 2, 2 * SHORT))
    return F.when(code < 0, _iso_text(-code - 1)).when(code > 0, raw.cast("string"))


@dataclass
class _First:
    """How the first value of one column is found."""
    name: str
    value: Column  # over the per-key table
    need: Column | None = None  # over the per-key table: the value has to be fetched
    same: Column | None = None  # over a row joined with the per-key table: the row may hold the value


def _by_key(df: DataFrame, order_keys: dict[str, str], columns: list[str]):
    """By a unique fixed-width key per column: preparation of rows, aggregates, columns, order of candidates."""
    aggs, found = [], []
    for i, name in enumerate(columns):
        c, kind, order = F.col(name), df.schema[name].dataType, F.col(order_keys[name])
        if is_fixed_width(kind):
            aggs.append(first_by(name, order).alias(f"_v{i}"))
            found.append(_First(name, F.col(f"_v{i}")))
            continue
        text = isinstance(kind, StringType)
        aggs.append(F.min(F.when(c.isNotNull(), order)).alias(f"_o{i}"))
        known = F.lit(None).cast(kind)
        need = F.col(f"_o{i}").isNotNull()
        if text:
            aggs.append(F.min_by(text_code(c), F.when(c.isNotNull(), order)).alias(f"_c{i}"))
            known = text_of(F.col(f"_c{i}"))
            need = need & (F.col(f"_c{i}") == 0)  # both columns are read on either side, so the two branches share one plan
        found.append(_First(name, known, need, order == F.col(f"_o{i}")))
    return lambda rows: rows, aggs, found, []


# The packed order: 8 digits of date, 13 of the first coordinate, 1 (is it exact), 13 of the second, 1 (is it exact).
# The upper 18 digits hold the date and the first coordinate but for its last three digits.
_SCALE, _ZERO = 1e10, 1_800_000_000_001
_HALF = 10 ** 18


def _coordinate(c: Column) -> tuple[Column, Column, Column]:
    """Code (0 for NULL; never falls as the value rises), is it exact, can it be coded."""
    whole = F.rint(c * _SCALE)
    fits = F.coalesce((c >= -180.0) & (c <= 180.0), c.isNull())
    code = F.when(c.isNull(), 0).when(fits, whole.cast("long") + _ZERO).otherwise(0).cast("long")
    return code, F.coalesce((whole / _SCALE == c).cast("int"), F.lit(1)), fits


def _by_content(df: DataFrame, parts: list[str], columns: list[str]):
    """By a list of columns (NULL first): preparation of rows, aggregates, columns, order of candidates."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rest = list(parts)
    date = rest.pop(0) if rest and isinstance(kinds[rest[0]], StringType) else None
    at = [rest.pop(0) for _ in range(2) if rest and isinstance(kinds[rest[0]], DoubleType)]
    day, fits = F.lit(0).cast("long"), F.lit(True)
    if date:
        d = F.col(date)
        day = F.when(_iso(d), _digits(d)).otherwise(0).cast("long")
        fits = fits & F.coalesce(_iso(d) & (day > 0), d.isNull())
    codes = []
    for i in range(2):
        code, exact, ok = _coordinate(F.col(at[i])) if i < len(at) else (F.lit(0).cast("long"), F.lit(1), F.lit(True))
        codes.append((code, exact))
        fits = fits & ok
    (x, x_exact), (y, y_exact) = codes
    packed = F.col("_hi").cast("decimal(18,0)") * F.lit(_HALF).cast("decimal(19,0)") + F.col("_lo").cast("decimal(18,0)")

    def prepared(rows: DataFrame) -> DataFrame:
        return (rows.withColumn("_x", x).withColumn("_hi", day * 10_000_000_000 + F.expr("_x div 1000"))
                .withColumn("_lo", (F.col("_x") % 1000) * 10 ** 15 + x_exact * F.lit(10 ** 14) + y * 10 + y_exact)
                .withColumn("_odd", (~fits).cast("int")).drop("_x").withColumn("_rank", packed.cast("decimal(38,0)")))
    aggs = [F.max("_odd").alias("_odds")]
    found = []
    for i, name in enumerate(columns):
        aggs.append(F.min(F.when(F.col(name).isNotNull(), F.col("_rank"))).alias(f"_m{i}"))
        m = f"`_m{i}`"
        hi, lo = F.expr(f"{m} div {_HALF}bd"), F.expr(f"cast({m} % {_HALF}bd as long)")
        lo_x, lo_rest = F.expr(f"cast({m} % {_HALF}bd as long) div {10 ** 15}L"), lo % 10 ** 15
        x_code = (hi % 10_000_000_000) * 1000 + lo_x
        x_ok, y_ok = lo_rest >= 10 ** 14, lo_rest % 10 == 1
        y_code = F.expr(f"(cast({m} % {_HALF}bd as long) % {10 ** 14}L) div 10L")
        open_, known = F.col("_odds") == 1, F.lit(None).cast(kinds[name])
        if name == date:
            known = _iso_text(F.expr(f"({m} div {_HALF}bd) div 10000000000L"))
        elif at and name == at[0]:
            open_, known = open_ | ~x_ok, (x_code - _ZERO).cast("double") / _SCALE
        elif len(at) > 1 and name == at[1]:
            open_, known = open_ | ~x_ok | ~y_ok, (y_code - _ZERO).cast("double") / _SCALE
        else:  # behind the packed columns
            open_ = F.col("_odds").isNotNull()
        same = (F.col("_odds") == 1) | ((F.col("_hi") == hi) & (F.expr(f"_lo div {10 ** 15}L") == lo_x))
        found.append(_First(name, known, F.col(f"_m{i}").isNotNull() & open_, same))
    return prepared, aggs, found, [F.col(c) for c in parts]


def reduce_rows(df: DataFrame, key: str, order_key: str | list[str] | dict[str, str], first_columns: list[str],
                more: dict[str, Column], prefix: str = "", null_keys: bool = True, max_keys: int | None = None,
                all_rows: DataFrame | None = None) -> DataFrame:
    """One row per ``key``: first values of ``first_columns`` (with ``prefix``) and the fixed-width aggregates ``more``.

    ``order_key`` as in :func:`dedupe_first`, or a unique fixed-width order
    column for each of ``first_columns``.  If ``df`` holds only some keys of a
    table, ``all_rows`` is that table: values are fetched from it without
    choosing the keys again.
    """
    if isinstance(order_key, str) and is_fixed_width(df.schema[order_key].dataType):
        order_key = {c: order_key for c in first_columns}
    if isinstance(order_key, dict):
        prepared, aggs, found, order = _by_key(df, order_key, first_columns)
        ordered = list(order_key.values())
    else:
        ordered = [order_key] if isinstance(order_key, str) else order_key
        prepared, aggs, found, order = _by_content(df, ordered, first_columns)
    best = prepared(df).groupBy(key).agg(*aggs, *[v.alias(f"_a{i}") for i, v in enumerate(more.values())])
    means = [F.col(f"_a{i}").alias(c) for i, c in enumerate(more)]
    held = [f for f in found if f.need is not None]
    if not held:
        return best.select(key, *[f.value.alias(f"{prefix}{f.name}") for f in found], *means)
    need = reduce(or_, [F.coalesce(f.need, F.lit(False)) for f in held])
    plain = best.where(~need).select(key, *[f.value.alias(f"{prefix}{f.name}") for f in found], *means)

    # the per-key table is read through one exchange: both branches use all of its columns
    from .sizing import broadcast_if_bounded
    wanted = best.where(need).withColumnRenamed(key, "_key")
    payload = [c for c in wanted.columns if c != "_key"]
    if max_keys is not None:
        wanted = broadcast_if_bounded(wanted, max_keys)
    src = prepared(df if all_rows is None else all_rows)
    own = [c for c in dict.fromkeys([key, *ordered, "_hi", "_lo", "_odd", *[f.name for f in held]]) if c in src.columns]
    same_key = src[key].eqNullSafe(F.col("_key")) if null_keys else src[key] == F.col("_key")
    columns = F.array(*[F.when(f.need & f.same & F.col(f.name).isNotNull(), F.lit(i)) for i, f in enumerate(held)])
    rows = src.select(*own).join(wanted, same_key).withColumn("_i", F.explode(F.filter(columns, lambda i: i.isNotNull())))
    ranked = Window.partitionBy(key, "_i").orderBy(*order, *[F.when(F.col("_i") == i, F.col(f.name)) for i, f in enumerate(held)])
    won = rows.withColumn("_nth", F.row_number().over(ranked)).where("_nth = 1")
    picked = won.groupBy(key, *payload).agg(F.map_from_entries(F.collect_list(
        F.struct("_i", F.struct(*[F.col(f.name).alias(f"_{i}") for i, f in enumerate(held)])))).alias("_won"))
    at = {f.name: F.when(F.coalesce(f.need, F.lit(False)), F.element_at("_won", F.lit(i))[f"_{i}"]).otherwise(f.value)
          for i, f in enumerate(held)}
    fetched = picked.select(key, *[at.get(f.name, f.value).alias(f"{prefix}{f.name}") for f in found], *means)
    return plain.unionAll(fetched)


def dedupe_first(df: DataFrame, key: str, order_key: str | list[str], columns: list[str] | None = None,
                 prefix: str = "", null_keys: bool = True, max_keys: int | None = None,
                 all_rows: DataFrame | None = None) -> DataFrame:
    """One row per ``key``; every other column is its first non-null value.

    ``order_key`` is the name of a column that is unique within a key (of
    rows that tie, any one's value is taken), or a list of columns to order
    by, NULL first (rows that tie in all of them and in the value give the
    same result).  ``null_keys=False`` says that the key is never NULL, which
    lets a table bucketed on the key be reduced without a shuffle.
    ``max_keys`` is a proven bound on the number of keys, if there is one, and
    ``all_rows`` the table of which ``df`` holds the rows of some keys.
    """
    order = [order_key] if isinstance(order_key, str) else order_key
    cols = columns if columns is not None else [c for c in df.columns if c != key and c not in order]
    return reduce_rows(df, key, order_key, cols, {}, prefix, null_keys, max_keys, all_rows)


def dedupe_avg(df: DataFrame, key: str, order_key: str | list[str], avg_columns: list[str],
               first_columns: list[str], prefix: str = "", null_keys: bool = True, max_keys: int | None = None,
               all_rows: DataFrame | None = None) -> DataFrame:
    """One row per ``key``: averages for ``avg_columns``, first values (as in :func:`dedupe_first`) for the rest."""
    return reduce_rows(df, key, order_key, first_columns, {f"{prefix}{c}": F.avg(c) for c in avg_columns}, prefix, null_keys, max_keys,
                       all_rows)
