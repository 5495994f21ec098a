"""Column expressions for transaction flags and ids; all run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlens.sources import schema as S

# 10^15, and 2^64 and 2^128 modulo it.
_M, _TWO64, _TWO128 = 10**15, 744073709551616, 607431768211456


def md5_id(text: Column) -> Column:
    """The last 15 decimal digits of the text's MD5 read as a signed 128-bit number."""
    h = F.md5(text)
    part = lambda at: F.conv(F.substring(h, at, 16), 16, 10).cast("decimal(20,0)") % F.lit(_M)
    dec = lambda c: c.cast("decimal(15,0)")
    u = ((dec(part(1)) * F.lit(_TWO64).cast("decimal(15,0)") + dec(part(17))) % F.lit(_M)).cast("long")
    return F.when(F.substring(h, 1, 1) >= "8", F.pmod(F.lit(_TWO128) - u, F.lit(_M))).otherwise(u)


def bkdr_hash(text: Column, mask: int = 0x7FFFFFFF) -> Column:
    """h = (131 h + code) & mask over the characters."""
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0).cast("long"), lambda h, c: (h * 131 + F.ascii(c)).bitwiseAND(F.lit(mask)))


def keyed_hash(text: Column, key: str) -> Column:
    """A keyed one-way stand-in for account numbers."""
    return F.sha2(F.concat(F.lit(key), F.reverse(text)), 256)


def hour(tm: Column) -> Column:
    """Hour of an HHmmss text, -1 where there is none."""
    return F.coalesce(F.left(tm, F.lit(2)).try_cast("int"), F.lit(-1))


def is_night(tm: Column) -> Column:
    return hour(tm).isin(*S.NIGHT_HOURS).cast("double")


def rmb(fen: Column) -> Column:
    return F.floor(fen / 100).cast("long")


def multiple_of(amount: Column, of: int) -> Column:
    return (amount % of == 0).cast("double")


def is_large_integer(amount: Column) -> Column:
    """Over 1000 and within 1 % a leading digit followed by zeros: |c - round(c)| / b < 0.01, b digits, c = amount / 10^(b-1)."""
    b = F.length(amount.cast("string"))
    c = amount / F.pow(F.lit(10.0), b - 1)
    return ((F.abs(c - F.round(c)) / b < 0.01) & (amount > 1000)).cast("double")


def count_89(amount: Column) -> Column:
    """How many digits of the amount are 8 or 9."""
    return F.length(F.regexp_replace(amount.cast("string"), "[^89]", "")).cast("double")


def in_list(c: Column, values) -> Column:
    return c.isin(*values).cast("double")


def differs(c: Column, value: str) -> Column:
    return (c != value).cast("double")


def minutes_between(later: Column, earlier: Column) -> Column:
    return F.abs(F.unix_timestamp(later) - F.unix_timestamp(earlier)) / 60.0


def two_places(c: Column) -> Column:
    return F.round(c, 2)


def rank_ratio(value: Column, rank: Column) -> Column:
    return F.try_divide(value.cast("double"), rank)


def number_or_zero(text: Column) -> Column:
    return F.coalesce(text.try_cast("double"), F.lit(0.0))


def event_time(day: Column, tm: Column) -> Column:
    """Timestamp of yyyyMMdd and HHmmss; null unless they are 14 characters of a real time."""
    both = F.concat(day, tm)
    return F.when(F.length(both) == 14, F.try_to_timestamp(both, F.lit("yyyyMMddHHmmss")))
