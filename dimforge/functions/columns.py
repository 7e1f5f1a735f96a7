"""Column expressions (row-local, JVM-side, inside whole-stage codegen): no UDFs.

Used by the operators; each takes and returns ``Column`` objects.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: date-list bitmap window and weekly masks (bit 31 = as-of day)
WINDOW_DAYS = 32
MASK_LAST_7 = 0xFE000000      # days 0-6 before the as-of day
MASK_PREV_7 = 0x01FC0000      # days 7-13


def tier(col: Column | str, thresholds: Sequence[float],
         labels: Sequence[str] = ("star", "good", "average", "bad")) -> Column:
    """Searched CASE: first threshold exceeded wins; the last label is the default."""
    c = F.col(col) if isinstance(col, str) else col
    out = F.when(c > thresholds[0], F.lit(labels[0]))
    for th, lab in zip(thresholds[1:], labels[1:]):
        out = out.when(c > th, F.lit(lab))
    return out.otherwise(F.lit(labels[len(thresholds)]))


def flag_in(text: str, token: str) -> Column:
    """``coalesce(position(token in text), 0) > 0``."""
    return F.coalesce(F.instr(F.col(text), token), F.lit(0)) > 0


def minutes_of(text: str) -> Column:
    """'mm:ss' -> minutes as a double; 'mm' alone is whole minutes; anything unparsable -> NULL."""
    mm = F.split_part(F.col(text), F.lit(":"), F.lit(1)).try_cast("double")
    ss = F.nullif(F.split_part(F.col(text), F.lit(":"), F.lit(2)), F.lit("")).try_cast("double")
    return mm + F.coalesce(ss, F.lit(0.0)) / 60.0


def md5_bucket(col: str, buckets: int = 100) -> Column:
    """Stable bucket in [0, buckets): first 32 bits of md5(text) mod buckets."""
    h = F.conv(F.substring(F.md5(F.col(col).cast("string")), 1, 8), 16, 10).cast("bigint")
    return h % buckets


def experiment_bucket(key: Column, salt: str, buckets: int = 100) -> Column:
    """Bucket in [0, buckets) from md5(salt || key): stable across processes and engines."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(salt), key.cast("string"))), 1, 8), 16, 10).cast("bigint")
    return h % buckets


def datelist_bits(dates: Column, ds: str, window: int = WINDOW_DAYS) -> Column:
    """Date array -> bigint bitmap: bit (31 - days_since) set for each date in the window.

    Row-local ``aggregate`` over the array: no join with a date series and
    no shuffle. Today is the top bit (31), 31 days ago bit 0.
    """
    d0 = F.lit(ds).cast("date")
    inside = F.filter(dates, lambda d: F.datediff(d0, d).between(0, window - 1))
    # 2^k as a double is exact for k < 53, so the cast back to bigint is lossless
    return F.aggregate(inside, F.lit(0).cast("bigint"),
                       lambda acc, d: acc.bitwiseOR(F.pow(F.lit(2.0), (window - 1) - F.datediff(d0, d))
                                                    .cast("bigint")))


def referrer_host(col: str) -> Column:
    return F.try_parse_url(F.col(col), F.lit("HOST"))


def ip_of(user_id: Column) -> Column:
    """A dotted address standing for the visitor: the user number's three low bytes after a first
    part that starts at 10 and is not bounded, so no two visitors share an address."""
    u = user_id.cast("bigint")
    part = lambda d: (F.floor(u / d) % 256).cast("string")
    first = (F.floor(u / 16777216) + 10).cast("string")
    return F.concat(first, F.lit("."), part(65536), F.lit("."), part(256), F.lit("."), (u % 256).cast("string"))


def ip_number(ip: Column) -> Column:
    p = F.split(ip, r"\.")
    return ((F.get(p, 0).cast("bigint") - 10) * 16777216 + F.get(p, 1).cast("bigint") * 65536 + F.get(p, 2).cast("bigint") * 256 + F.get(p, 3).cast("bigint"))
