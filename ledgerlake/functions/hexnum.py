"""Hex decoding as native Spark expressions.

No UDF anywhere: every function returns a Column built from ``rlike``,
``regexp_extract``, ``lpad``, ``conv`` and the ``try_*`` arithmetic, so the
decode stays inside whole-stage codegen and column pruning sees through it.

Conventions of the archive: wei and ``log_index`` are lowercase ``0x`` hex,
``0x`` alone is zero, null and ``""`` are null.  Anything else that is not
``0x`` followed by hex digits is null (and counted by :func:`decode_audit`).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType

from ledgerlake.schemas import INT_COLUMNS, WEI_COLUMNS, WEI_TYPE, check_kind

# The accepted pattern (exactly 0x and hex digits; ``\z`` is
# the absolute end, so a trailing newline does not pass) and the
# significant-digit capture.
HEX_PATTERN = r"^0[xX][0-9a-fA-F]+\z"
SIGNIFICANT = r"^0[xX]0*([0-9a-fA-F]*)\z"
TWO_POW_64 = Decimal(2 ** 64)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _significant(c: Column) -> Column:
    return F.regexp_extract(c, SIGNIFICANT, 1)


# The same expressions as SQL text: a column given by name is decoded with one
# ``expr`` call instead of a few dozen Column-builder round trips.  ``{s}`` is
# the significant digits (only read once the value is known to be valid):
# ``trim(LEADING '0' FROM substring(c, 3))``, much cheaper than a regex.
_HEX_SQL = "'" + HEX_PATTERN.replace("\\", "\\\\") + "'"
_DIGITS_SQL = "trim(LEADING '0' FROM substring({c}, 3))"
_WEI_FROM = (
    "CASE WHEN {c} = '0x' THEN CAST(0 AS DECIMAL(38,0)) "
    "WHEN {c} RLIKE " + _HEX_SQL + " AND length({s}) <= 32 THEN CAST(try_add("
    "try_multiply(CAST(conv(substring(lpad({s}, 32, '0'), 1, 16), 16, 10) AS DECIMAL(38,0)), "
    "CAST(18446744073709551616 AS DECIMAL(20,0))), "
    "CAST(conv(substring(lpad({s}, 32, '0'), 17, 16), 16, 10) AS DECIMAL(38,0))) "
    "AS DECIMAL(38,0)) ELSE CAST(NULL AS DECIMAL(38,0)) END")
_INT_FROM = (
    "CASE WHEN {c} = '0x' THEN CAST(0 AS BIGINT) "
    "WHEN {c} RLIKE " + _HEX_SQL + " AND length({s}) <= 16 "
    "THEN try_cast(conv(lpad({s}, 16, '0'), 16, 10) AS BIGINT) "
    "ELSE CAST(NULL AS BIGINT) END")


def _wei_sql(c: str, s: str | None = None) -> str:
    return _WEI_FROM.format(c=c, s=s or _DIGITS_SQL.format(c=c))


def _int_sql(c: str, s: str | None = None) -> str:
    return _INT_FROM.format(c=c, s=s or _DIGITS_SQL.format(c=c))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def wei(c) -> Column:
    """Hex string to DECIMAL(38,0) via two 64-bit limbs.

    Above 32 significant hex digits, or above 10^38-1, the result is null.
    """
    if isinstance(c, str):
        return F.expr(_wei_sql(_quoted(c)))
    c = _col(c)
    digits = F.lpad(_significant(c), 32, "0")
    hi = F.conv(F.substring(digits, 1, 16), 16, 10).cast(WEI_TYPE)
    lo = F.conv(F.substring(digits, 17, 16), 16, 10).cast(WEI_TYPE)
    fits = c.rlike(HEX_PATTERN) & (F.length(_significant(c)) <= 32)
    value = F.try_add(F.try_multiply(hi, F.lit(TWO_POW_64).cast(DecimalType(20, 0))), lo)
    return (F.when(c == "0x", F.lit(0).cast(WEI_TYPE))
             .when(fits, value.cast(WEI_TYPE))
             .otherwise(F.lit(None).cast(WEI_TYPE)))


def hex_int(c) -> Column:
    """Hex string to BIGINT; null when invalid or above 2^63-1.

    ``conv`` alone stops at the first bad digit and raises above 64 bits under
    ANSI, so the pattern and length are tested first.
    """
    if isinstance(c, str):
        return F.expr(_int_sql(_quoted(c)))
    c = _col(c)
    fits = c.rlike(HEX_PATTERN) & (F.length(_significant(c)) <= 16)
    value = F.conv(F.lpad(_significant(c), 16, "0"), 16, 10).try_cast(LongType())
    return (F.when(c == "0x", F.lit(0).cast(LongType()))
             .when(fits, value)
             .otherwise(F.lit(None).cast(LongType())))


def decode_hex_columns(df: DataFrame, kind: str) -> DataFrame:
    """Decode the wei and int columns of ``kind`` that are present.

    Absent columns are skipped; other columns are left untouched.
    """
    check_kind(kind)
    present = set(df.columns)
    todo = [(n, True) for n in WEI_COLUMNS[kind] if n in present]
    todo += [(n, False) for n in INT_COLUMNS[kind] if n in present]
    if not todo:
        return df
    # The significant digits go in their own projection first: each is used
    # two or three times below, and a separate (non-collapsed) projection
    # evaluates it once per value.
    helper = {n: f"__ll_digits_{n}" for n, _ in todo}
    staged = df.withColumns({helper[n]: F.expr(_DIGITS_SQL.format(c=_quoted(n))) for n, _ in todo})
    exprs = {n: F.expr((_wei_sql if is_wei else _int_sql)(_quoted(n), _quoted(helper[n])))
             for n, is_wei in todo}
    return staged.withColumns(exprs).drop(*helper.values())


# Audit measures, in output order (fixed names).
AUDIT_MEASURES = ("rows", "nulls", "empties", "zero_markers", "invalid", "too_large", "decoded")


def _audit_exprs(name: str, decoded: str) -> list[Column]:
    c, dec = F.col(name), F.col(decoded)
    valid = c.rlike(HEX_PATTERN)
    return [
        F.count(F.lit(1)),
        F.count_if(c.isNull()),
        F.count_if(c == ""),
        F.count_if(c == "0x"),
        F.count_if(c.isNotNull() & (c != "") & (c != "0x") & ~valid),
        F.count_if(valid & dec.isNull()),
        F.count_if(dec.isNotNull()),
    ]


def decode_audit(df: DataFrame, kind: str, by: list[str] | None = None) -> DataFrame:
    """C4: per decoded column, count null-in, empty, zero marker, invalid,
    too large and decoded values, in one aggregation pass over raw rows.

    Output: (*by, kind, column, rows, nulls, empties, zero_markers, invalid,
    too_large, decoded).  ``by`` is typically ``["date"]``.
    """
    check_kind(kind)
    by = list(by or [])
    cols = [(n, True) for n in WEI_COLUMNS[kind] if n in df.columns]
    cols += [(n, False) for n in INT_COLUMNS[kind] if n in df.columns]
    if not cols:
        raise ValueError(f"no decodable column of {kind} present")
    # Decode once (the staged form) next to the raw values, then count.
    raw = df.select(*by, *[F.col(n).alias(f"__ll_raw_{n}") for n, _ in cols],
                    *[F.col(n) for n, _ in cols])
    both = decode_hex_columns(raw, kind)
    aggs = []
    for i, (name, _) in enumerate(cols):
        for m, e in zip(AUDIT_MEASURES, _audit_exprs(f"__ll_raw_{name}", name)):
            aggs.append(e.alias(f"c{i}_{m}"))
    wide = both.groupBy(*by).agg(*aggs) if by else both.agg(*aggs)
    # One row per column: an array of structs exploded (no second pass).
    rows = F.array(*[
        F.struct(F.lit(name).alias("column"),
                 *[F.col(f"c{i}_{m}").cast("bigint").alias(m) for m in AUDIT_MEASURES])
        for i, (name, _) in enumerate(cols)
    ])
    return (wide.select(*by, F.inline(rows))
                .select(*by, F.lit(kind).alias("kind"), "column", *AUDIT_MEASURES))


def norm_key(c) -> Column:
    """Lookup keys are compared lower-case."""
    return F.lower(_col(c))


def register_sql_functions(spark, prefix: str = "ll_") -> list[str]:
    """Make C1, C2 and C5 callable from SQL as temporary SQL functions
    (``ll_wei``, ``ll_hex_int``, ``ll_norm_key``).  Their bodies are SQL
    expressions, inlined into the plan like any built-in (no Python)."""
    bodies = {
        "wei": ("DECIMAL(38,0)", _wei_sql("s")),
        "hex_int": ("BIGINT", _int_sql("s")),
        "norm_key": ("STRING", "lower(s)"),
    }
    names = []
    for name, (rtype, body) in bodies.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {prefix}{name}(s STRING) "
                  f"RETURNS {rtype} RETURN {body}")
        names.append(prefix + name)
    return names
