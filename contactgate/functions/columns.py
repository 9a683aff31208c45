"""Column expressions.  All are built-in Spark functions, so they stay inside
whole-stage codegen; none is a Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the data contract.
DATE_FORMAT = "yyyy-MM-dd"            # dates inside the delivery files
FILE_DATE_FORMAT = "yyyyMMdd"         # date stamp inside the delivery file name
FILE_DATE_PATTERN = r"-(\d{8})\d+-"   # first 8 digits of the 17-digit stamp
PHONE_PREFIX = "+1"                   # published phone numbers carry the country code
NORMALIZED_PHONE_PATTERN = r"^\+1\d{10}$"
SEND_SOURCES = ("CLIENT",)            # only client-provided numbers may be texted


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- SQL-text forms --------------------------------------------------------
# The same rules as SQL expressions over a column name, for plans that build
# wide projections with one ``selectExpr`` call.  The Column helpers below
# are defined through these, so both forms cannot drift apart.

def account_from_legacy_sql(col: str) -> str:
    return f"substring({col}, 1, length({col}) - 1)"


def normalize_phone_sql(col: str) -> str:
    return f"concat('{PHONE_PREFIX}', {col})"


def tri_state_sql(col: str, true_value: str = "Y", false_value: str = "N") -> str:
    return f"CASE {col} WHEN '{true_value}' THEN true WHEN '{false_value}' THEN false END"


def parse_date_sql(col: str, fmt: str = DATE_FORMAT) -> str:
    return f"try_to_date({col}, '{fmt}')"


def pad(col: str | Column, width: int) -> Column:
    """Left-pad the string form of ``col`` with zeros."""
    return F.lpad(_c(col).cast("string"), width, "0")


def parse_date(col: str | Column, fmt: str = DATE_FORMAT) -> Column:
    """Lenient date parse: a malformed or empty value becomes NULL instead of
    failing the job (Spark 4 runs with ANSI mode on)."""
    if isinstance(col, str):
        return F.expr(parse_date_sql(col, fmt))
    return F.try_to_date(col, fmt)


def file_date_from_name(name: str | Column, pattern: str = FILE_DATE_PATTERN,
                        fmt: str = FILE_DATE_FORMAT) -> Column:
    """Delivery date encoded in a file name (``…-20190101000000863-…``).  A name without a
    stamp has none; it is not parsed, as a failing parse costs far more than a good one."""
    stamp = F.regexp_extract(_c(name), pattern, 1)
    return F.when(stamp != "", parse_date(stamp, fmt))


def account_from_legacy(legacy: str | Column) -> Column:
    """Account number = legacy identifier without its one-character suffix."""
    if isinstance(legacy, str):
        return F.expr(account_from_legacy_sql(legacy))
    return legacy.substr(F.lit(1), F.length(legacy) - 1)


def normalize_phone(col: str | Column) -> Column:
    """Prefix the country code.  NULL stays NULL; no digit cleaning."""
    if isinstance(col, str):
        return F.expr(normalize_phone_sql(col))
    return F.concat(F.lit(PHONE_PREFIX), col)


def normalize_phone_input(col: str | Column) -> Column:
    """For lookups: a bare 10-digit number gets the prefix, anything else is
    passed through unchanged (already ``+1…`` or malformed)."""
    c = _c(col)
    return F.when(c.rlike(r"^\d{10}$"), normalize_phone(c)).otherwise(c)


def tri_state(col: str | Column, true_value: str = "Y", false_value: str = "N") -> Column:
    """Map a flag to TRUE / FALSE / NULL; anything else (NULL, '') is NULL."""
    if isinstance(col, str):
        return F.expr(tri_state_sql(col, true_value, false_value))
    return (
        F.when(col == true_value, F.lit(True))
        .when(col == false_value, F.lit(False))
        .otherwise(F.lit(None).cast("boolean"))
    )


def can_send_rule(source: str | Column = "phone_source",
                  deleted: str | Column = "is_deleted",
                  consent: str | Column = "has_sms_consent",
                  allowed_sources: tuple[str, ...] = SEND_SOURCES) -> Column:
    """Permission rule for one published row: allowed source AND not deleted AND
    consent not withdrawn (a missing consent counts as implicit consent).
    Never NULL."""
    return (
        F.coalesce(_c(source).isin(*allowed_sources), F.lit(False))
        & F.coalesce(~_c(deleted), F.lit(False))
        & F.coalesce(_c(consent), F.lit(True))
    )
