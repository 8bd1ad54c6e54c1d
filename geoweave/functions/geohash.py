"""Geohash as native Spark column expressions (no Python UDF).

A geohash of precision ``p`` interleaves ``5p`` bits, longitude first:
``ceil(5p/2)`` longitude bits and ``floor(5p/2)`` latitude bits, written
five bits per character in base 32.  Here a cell is kept as two integer
indexes (latitude band, longitude band) and packed row-major into one
``bigint``::

    cell = lat_index << lng_bits | lng_index

Equal cells <=> equal geohash strings of that precision, so joins and
groupings use the ``bigint`` (HashAggregate-friendly, cheap inferred
``isnotnull`` filters) and the text is produced only for output.

The text is made from the geohash integer (the two indexes interleaved by
10-bit lookups in a spread table) with ``conv`` to base 32 and
``translate`` to the geohash alphabet, so an encode reads each index once
per 10 bits and the expression stays small enough for whole-stage codegen
however it is nested.  Decoding reverses it (``translate`` + ``conv``) and
gathers alternate bits by 8-bit table lookups.  NULL is carried by
arithmetic (``+ when(valid, 0)``), not by a CASE around the work, so shared
parts stay eligible for common-subexpression elimination.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import context_key

# The geohash base-32 alphabet (no a, i, l, o).
BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"

MAX_PRECISION = 12  # 60 bits, fits a signed long
_FULL_BITS = 30  # bits per axis at MAX_PRECISION

# Neighbour offsets by direction: (d_lat_index, d_lng_index).
DIRECTIONS = {
    "n": (1, 0), "ne": (1, 1), "e": (0, 1), "se": (-1, 1),
    "s": (-1, 0), "sw": (-1, -1), "w": (0, -1), "nw": (1, -1),
}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _memo(fn):
    """Reuse the built Column when every argument is a plain name or number.

    Building these expressions costs hundreds of JVM round trips; a Column
    is an unresolved expression, so the same object can serve any number of
    DataFrames.  Keyed by the active SparkContext object, so a restarted
    session never sees stale JVM objects.
    """
    cache: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kw):
        plain = all(isinstance(a, (str, int, float)) for a in (*args, *kw.values()))
        if not plain:
            return fn(*args, **kw)
        key = (context_key(), args, tuple(sorted(kw.items())))
        col = cache.get(key)
        if col is None:
            col = cache[key] = fn(*args, **kw)
        return col

    return wrapper


def bit_split(precision: int) -> tuple[int, int]:
    """(longitude bits, latitude bits) of a geohash with ``precision`` chars."""
    if not 1 <= precision <= MAX_PRECISION:
        raise ValueError(f"precision must be in 1..{MAX_PRECISION}, got {precision}")
    bits = 5 * precision
    return (bits + 1) // 2, bits // 2


@_memo
def valid_coordinates(lat, lng) -> Column:
    """TRUE when both are non-null and inside [-90,90] x [-180,180] (NaN is out)."""
    lat, lng = _c(lat), _c(lng)
    return lat.between(-90.0, 90.0) & lng.between(-180.0, 180.0)


def _axis_index(v: Column, lo: float, hi: float, bits: int) -> Column:
    """Band index = number of bisection steps to the right, exactly.

    The floor formula can be off by one when ``v - lo`` rounds (a value a
    few ulps below a band edge).  Band edges ``lo + k * width`` are exact
    doubles for up to 30 bits, so the estimate is checked against its own
    lower and upper edge and moved by one where needed.
    """
    # no pre-clamp needed: the final clamp to [0, 2^bits - 1] puts the poles and
    # +-180 in the outermost bands, as the 1e-9 pull-inside of the original did
    est = F.floor((v - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(1 << bits))).cast("long")
    width = (hi - lo) / (1 << bits)
    lower = F.lit(lo) + est.cast("double") * F.lit(width)
    idx = (F.when(v < lower, est - F.lit(1))
           .when(v >= lower + F.lit(width), est + F.lit(1))
           .otherwise(est))
    return F.least(F.greatest(idx, F.lit(0)), F.lit((1 << bits) - 1))


@_memo
def lat_index(lat, precision: int = 4) -> Column:
    """Latitude band index (0 = southmost) at ``precision``."""
    _, nt = bit_split(precision)
    return _axis_index(_c(lat), -90.0, 90.0, nt)


@_memo
def lng_index(lng, precision: int = 4) -> Column:
    """Longitude band index (0 = at -180) at ``precision``."""
    nl, _ = bit_split(precision)
    return _axis_index(_c(lng), -180.0, 180.0, nl)


def pack(lat_idx, lng_idx, precision: int = 4) -> Column:
    nl, _ = bit_split(precision)
    return F.shiftleft(_c(lat_idx), nl).bitwiseOR(_c(lng_idx))


@_memo
def cell_id(lat, lng, precision: int = 4) -> Column:
    """Packed geohash cell as ``bigint``; NULL for null / out-of-range / NaN input."""
    lat, lng = _c(lat), _c(lng)
    return F.when(valid_coordinates(lat, lng),
                  pack(lat_index(lat, precision), lng_index(lng, precision), precision))


def cell_lat_index(cell, precision: int = 4) -> Column:
    nl, _ = bit_split(precision)
    return F.shiftright(_c(cell), nl)


def cell_lng_index(cell, precision: int = 4) -> Column:
    nl, _ = bit_split(precision)
    return _c(cell).bitwiseAND(F.lit((1 << nl) - 1))


def _spread10(i: int) -> int:
    """Bit k of i moved to bit 2k (for a 10-bit i)."""
    out = 0
    for k in range(10):
        out |= ((i >> k) & 1) << (2 * k)
    return out


# 1024-entry spread table, built by rule.  A numpy array becomes one array
# Literal node (a Python list would be 1024 child expressions to analyse).
_SPREAD = np.array([_spread10(i) for i in range(1024)], dtype=np.int64)
_SPREAD_SQL = "array(" + ", ".join(f"{int(v)}L" for v in _SPREAD) + ")"  # for the SQL function
_CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # digit set of conv(..., 32)


def _spread(x: Column, bits: int) -> Column:
    """Low ``bits`` bits of ``x`` moved to the even bit positions (10-bit table lookups)."""
    table = F.lit(_SPREAD)
    out = None
    for j in range(0, bits, 10):
        # never a NULL index: on a literal array it is read as -1 (the last element)
        chunk = F.coalesce((F.shiftright(x, j) if j else x).bitwiseAND(F.lit(1023)), F.lit(0).cast("long"))
        part = F.element_at(table, (chunk + F.lit(1)).cast("int"))
        part = F.shiftleft(part, 2 * j) if j else part
        out = part if out is None else out.bitwiseOR(part)
    return out


def _morton(lat_i: Column, lng_i: Column, precision: int) -> Column:
    """The geohash integer: index bits interleaved, longitude in the top bit."""
    nl, nt = bit_split(precision)
    if nl == nt:
        return F.shiftleft(_spread(lng_i, nl), 1).bitwiseOR(_spread(lat_i, nt))
    return _spread(lng_i, nl).bitwiseOR(F.shiftleft(_spread(lat_i, nt), 1))


def _code_text(code: Column, precision: int) -> Column:
    """Base-32 text of a geohash integer; NULL stays NULL (no CASE needed)."""
    digits = F.lpad(F.conv(code.cast("string"), 10, 32), precision, "0")
    return F.translate(digits, _CONV_DIGITS, BASE32)


def _text(lat_i: Column, lng_i: Column, precision: int) -> Column:
    """Geohash text from band indexes at a fixed precision.

    Each index is read once per 10 bits and the text is made by ``conv``
    from the interleaved integer, so the expression stays linear in size.
    """
    return _code_text(_morton(lat_i, lng_i, precision), precision)


@_memo
def cell_to_geohash(cell, precision: int = 4) -> Column:
    """Text geohash of a packed cell id of the given precision (NULL for NULL).

    NULL travels by arithmetic (``+ cell * 0``) rather than a CASE, so the
    shared parts stay eligible for common-subexpression elimination.
    """
    cell = _c(cell)
    code = _morton(cell_lat_index(cell, precision), cell_lng_index(cell, precision), precision)
    return _code_text(code + cell * F.lit(0), precision)


@_memo
def geohash(lat, lng, precision: int = 4) -> Column:
    """Geohash text of (lat, lng); NULL when either is null or out of range.

    ``df.withColumn("geohash", geohash("lat", "lng", 4))``; one native
    expression in place of a row-at-a-time Python UDF.  Built straight from
    the two band indexes (each read once), not through :func:`cell_id`, so
    the generated method stays small enough for the JIT.
    """
    lat, lng = _c(lat), _c(lng)
    guard = F.when(valid_coordinates(lat, lng), F.lit(0).cast("long"))  # NULL when invalid
    code = _morton(lat_index(lat, precision), lng_index(lng, precision), precision) + guard
    return _code_text(code, precision)


# ---------------------------------------------------------------- decode ---

_VALID_RE = "^[0-9b-hjkmnp-z]{1,12}$"
_VALID_RE_ANY_CASE = "^(?i)[0-9b-hjkmnp-z]{1,12}$"


def _compact8(i: int) -> int:
    """Bits 0, 2, 4, 6 of an 8-bit i gathered into 4 bits."""
    return sum(((i >> (2 * k)) & 1) << k for k in range(4))


# 256-entry compaction table, built by rule (one array Literal, see _SPREAD)
_COMPACT = np.array([_compact8(i) for i in range(256)], dtype=np.int64)


def _gather_even(x: Column, out_bits: int) -> Column:
    """Even-position bits of ``x`` gathered into an ``out_bits``-bit value (8-bit lookups)."""
    table = F.lit(_COMPACT)
    out = None
    for j in range(0, 2 * out_bits, 8):
        chunk = F.coalesce((F.shiftright(x, j) if j else x).bitwiseAND(F.lit(255)), F.lit(0).cast("long"))
        part = F.element_at(table, (chunk + F.lit(1)).cast("int"))
        part = F.shiftleft(part, j // 2) if j else part
        out = part if out is None else out.bitwiseOR(part)
    return out


def _parse(gh) -> dict:
    """Band indexes of a geohash string of any length 1..12 (per-row length).

    The string becomes its integer with ``translate`` + ``conv``; longitude
    and latitude bits are then gathered from alternate positions.  Returns
    columns: ok, n (length), nl / nt (bits per axis), lat_idx, lng_idx.
    Values are meaningful only where ``ok``.
    """
    g = F.lower(_c(gh))
    n = F.length(g)
    ok = F.coalesce(g.rlike(_VALID_RE), F.lit(False))
    code = F.conv(F.translate(g, BASE32, _CONV_DIGITS), 32, 10).cast("long")
    bits = F.lit(5) * n
    # the top bit (bits - 1) is longitude, so longitude sits on that parity
    lng_src = F.call_function("shiftright", code, ((bits - F.lit(1)) % F.lit(2)).cast("int"))
    lat_src = F.call_function("shiftright", code, (bits % F.lit(2)).cast("int"))
    nl = F.floor((bits + F.lit(1)) / F.lit(2)).cast("int")
    nt = F.floor(bits / F.lit(2)).cast("int")
    return dict(ok=ok, n=n, nl=nl, nt=nt, lat_idx=_gather_even(lat_src, _FULL_BITS),
                lng_idx=_gather_even(lng_src, _FULL_BITS))


@_memo
def geohash_to_cell(gh, precision: int = 4, fit: str = "exact") -> Column:
    """Packed cell id at ``precision`` of a geohash string; NULL for invalid text.

    A valid geohash of another length stops the job (``fit="exact"``).  With
    ``fit="prefix"`` a finer one is taken as its enclosing cell, its first
    ``precision`` characters, and a coarser one gives NULL.
    """
    if fit not in ("exact", "prefix"):
        raise ValueError("fit must be 'exact' or 'prefix'")
    g = _c(gh)
    if fit == "exact":
        odd = g.rlike(_VALID_RE_ANY_CASE) & (F.length(g) != F.lit(precision))
        g = F.when(odd, F.raise_error(F.concat(F.lit(f"a stored geohash does not have {precision} characters: "), g))
                   .cast("string")).otherwise(g)
    p = _parse(F.substr(g, F.lit(1), F.lit(precision)))
    guard = F.when(p["ok"] & (p["n"] == F.lit(precision)) & g.rlike(_VALID_RE_ANY_CASE), F.lit(0).cast("long"))
    return pack(p["lat_idx"], p["lng_idx"], precision) + guard


@_memo
def decode(gh) -> Column:
    """Centre of the geohash cell as ``struct<lat double, lng double>``.

    Null, empty or invalid strings give ``(NULL, NULL)``.  NULL travels by
    arithmetic, not a CASE, so the parsed parts are shared by both fields.
    """
    p = _parse(gh)
    guard = F.when(p["ok"], F.lit(0.0))
    lat = F.lit(-90.0) + (p["lat_idx"].cast("double") + F.lit(0.5)) * F.lit(180.0) / F.pow(F.lit(2.0), p["nt"])
    lng = F.lit(-180.0) + (p["lng_idx"].cast("double") + F.lit(0.5)) * F.lit(360.0) / F.pow(F.lit(2.0), p["nl"])
    return F.struct((lat + guard).alias("lat"), (lng + guard).alias("lng"))


def _let(value: Column, fn) -> Column:
    """Evaluate ``value`` once and hand it to ``fn`` as a lambda variable.

    Keeps expressions that use their input many times linear in size when
    they are nested (e.g. the neighbours of a neighbour).
    """
    return F.element_at(F.transform(F.array(value), fn), 1)


@_memo
def neighbours(gh) -> Column:
    """Adjacent cells as ``map<string,string>`` keyed n, ne, e, se, s, sw, w, nw.

    Labels follow geometry.  Longitude wraps at +-180; nothing lies beyond
    a pole, so polar cells have five entries.  Null, empty or invalid input
    gives an empty map.  For many rows prefer :func:`explode_neighbours`,
    which stays in generated code.
    """
    def build(s: Column) -> Column:
        n, nl, nt = s["n"], s["nl"], s["nt"]
        lat_span = F.call_function("shiftleft", F.lit(1).cast("long"), nt)
        lng_span = F.call_function("shiftleft", F.lit(1).cast("long"), nl)
        keys, values = [], []
        for name, (dlat, dlng) in DIRECTIONS.items():
            lat2 = s["lat_idx"] + F.lit(dlat)
            lng2 = F.pmod(s["lng_idx"] + F.lit(dlng), lng_span)
            inside = s["ok"] & (lat2 >= F.lit(0)) & (lat2 < lat_span)
            lat_full = F.call_function("shiftleft", lat2, F.lit(_FULL_BITS) - nt)
            lng_full = F.call_function("shiftleft", lng2, F.lit(_FULL_BITS) - nl)
            text = F.substr(_text(lat_full, lng_full, MAX_PRECISION), F.lit(1), n)
            values.append(F.when(inside, text))
            keys.append(F.when(inside, F.lit(name)))
        return F.map_from_arrays(F.array_compact(F.array(*keys)), F.array_compact(F.array(*values)))

    def parsed(g: Column) -> Column:
        p = _parse(g)
        return F.struct(*[p[k].alias(k) for k in ("ok", "n", "nl", "nt", "lat_idx", "lng_idx")])

    return _let(_c(gh), lambda g: _let(parsed(g), build))


def explode_neighbours(df, gh_col: str = "geohash", direction: str = "direction",
                       neighbour: str = "neighbour"):
    """Long form of :func:`neighbours`: one row per (input row, direction).

    The string is parsed once into columns, the eight directions are fanned
    out with ``inline``, and each output row encodes a single cell, so the
    generated code stays small.  Rows whose geohash is null, empty or
    invalid produce no output; polar cells produce five rows.

    The validity test is applied only above the generator: a filter on the
    parsed columns below it would be pushed down through the projections
    and inline the whole geohash derivation into the scan filter.
    """
    p = _parse(gh_col)
    staged = df.select("*", p["n"].alias("_gw_n"), p["nl"].alias("_gw_nl"), p["nt"].alias("_gw_nt"),
                       p["lat_idx"].alias("_gw_ti"), p["lng_idx"].alias("_gw_li"), p["ok"].alias("_gw_ok"))
    dirs = F.array(*[F.struct(F.lit(k).alias(direction), F.lit(a).alias("_gw_dlat"), F.lit(b).alias("_gw_dlng"))
                     for k, (a, b) in DIRECTIONS.items()])
    fan = staged.select("*", F.inline(dirs))
    nt, nl = F.col("_gw_nt"), F.col("_gw_nl")
    lat2 = F.col("_gw_ti") + F.col("_gw_dlat")
    lng2 = F.pmod(F.col("_gw_li") + F.col("_gw_dlng"), F.call_function("shiftleft", F.lit(1).cast("long"), nl))
    fan = fan.select("*", lat2.alias("_gw_t2"), lng2.alias("_gw_l2"))
    keep = F.col("_gw_ok") & (F.col("_gw_t2") >= F.lit(0)) & \
        (F.col("_gw_t2") < F.call_function("shiftleft", F.lit(1).cast("long"), nt))
    lat_full = F.call_function("shiftleft", F.col("_gw_t2"), F.lit(_FULL_BITS) - nt)
    lng_full = F.call_function("shiftleft", F.col("_gw_l2"), F.lit(_FULL_BITS) - nl)
    text = F.substr(_text(lat_full, lng_full, MAX_PRECISION), F.lit(1), F.col("_gw_n"))
    out = fan.select(*df.columns, direction, F.when(keep, text).alias(neighbour))
    return out.where(F.col(neighbour).isNotNull())


@_memo
def neighbour_cells(cell, precision: int = 4) -> Column:
    """Array of the packed ids of the (up to 8) neighbours of ``cell``."""
    nl, nt = bit_split(precision)
    lat_i, lng_i = cell_lat_index(cell, precision), cell_lng_index(cell, precision)
    out = []
    for dlat, dlng in DIRECTIONS.values():
        lat2 = lat_i + F.lit(dlat)
        lng2 = F.pmod(lng_i + F.lit(dlng), F.lit(1 << nl))
        inside = (lat2 >= F.lit(0)) & (lat2 < F.lit(1 << nt))
        out.append(F.when(inside, pack(lat2, lng2, precision)))
    return F.array_compact(F.array(*out))


def sql_geohash_expr(lat: str, lng: str, precision: int = 4, spread_fn: str = "gw_spread10") -> str:
    """Spark SQL text of :func:`geohash` over two column or parameter names.

    ``spread_fn`` is a SQL function spreading a 10-bit value (registered by
    :func:`register_sql_functions`).
    """
    nl, nt = bit_split(precision)

    def index(v: str, lo: float, hi: float, bits: int) -> str:
        est = (f"CAST(floor(({v} - CAST({lo!r} AS DOUBLE)) / CAST({hi - lo!r} AS DOUBLE)"
               f" * CAST({float(1 << bits)!r} AS DOUBLE)) AS BIGINT)")
        width = (hi - lo) / (1 << bits)
        lower = f"(CAST({lo!r} AS DOUBLE) + CAST({est} AS DOUBLE) * CAST({width!r} AS DOUBLE))"
        idx = (f"CASE WHEN {v} < {lower} THEN {est} - 1 "
               f"WHEN {v} >= {lower} + CAST({width!r} AS DOUBLE) THEN {est} + 1 ELSE {est} END")
        return f"least(greatest({idx}, 0), {(1 << bits) - 1})"

    def spread(x: str, bits: int) -> str:
        parts = [f"({spread_fn}(({x} >> {j}) & 1023) << {2 * j})" for j in range(0, bits, 10)]
        return "(" + " | ".join(parts) + ")"

    la, lo_ = index(lat, -90.0, 90.0, nt), index(lng, -180.0, 180.0, nl)
    code = (f"(({spread(lo_, nl)} << 1) | {spread(la, nt)})" if nl == nt
            else f"({spread(lo_, nl)} | ({spread(la, nt)} << 1))")
    guard = f"CASE WHEN {lat} BETWEEN -90 AND 90 AND {lng} BETWEEN -180 AND 180 THEN 0L END"
    return (f"translate(lpad(conv(CAST({code} + {guard} AS STRING), 10, 32), {precision}, '0'), "
            f"'{_CONV_DIGITS}', '{BASE32}')")


def register_sql_functions(spark, precision: int = 4, name: str = "geohash") -> None:
    """``CREATE TEMPORARY FUNCTION <name>(lat, lng)`` returning the geohash text."""
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION gw_spread10(x BIGINT) RETURNS BIGINT "
              f"RETURN element_at({_SPREAD_SQL}, CAST(coalesce(x, 0) + 1 AS INT))")
    body = sql_geohash_expr("lat", "lng", precision)
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(lat DOUBLE, lng DOUBLE) "
              f"RETURNS STRING RETURN {body}")
