"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from riskweave.functions import constants as K


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_divide(n: Column | str, d: Column | str) -> Column:
    """n / d, null where d is null or zero."""
    return F.try_divide(col(n), F.nullif(col(d), F.lit(0.0)))


def guarded_ratio(n: Column | str, d: Column | str, default: float | None = None) -> Column:
    """n / d only for a positive d; `default` (or null) otherwise."""
    ratio = F.when(col(d) > 0, col(n) / col(d))
    return ratio if default is None else ratio.otherwise(F.lit(default))


def clamp(c: Column | str, low: Column | float, high: Column | float) -> Column:
    lo = low if isinstance(low, Column) else F.lit(float(low))
    hi = high if isinstance(high, Column) else F.lit(float(high))
    # least and greatest skip nulls, so a null has to be kept apart
    return F.when(col(c).isNotNull(), F.greatest(F.least(col(c), hi), lo))


def at_most(c: Column | str, high: float) -> Column:
    return F.when(col(c).isNotNull(), F.least(col(c), F.lit(float(high))))


def pad_cik(c: Column | str) -> Column:
    """Ten digits where the id is a number; other ids stay as they are."""
    text = F.trim(col(c).cast("string"))
    number = F.regexp_extract(text, r"^(\d{1,18})(?:\.0*)?$", 1)
    return F.when(number != "", F.lpad(number.cast("bigint").cast("string"), 10, "0")).otherwise(text)


def derived_cik(ticker: Column | str) -> Column:
    """A stable seven-digit id made from the ticker, padded."""
    head = F.conv(F.substring(F.md5(col(ticker)), 1, 8), 16, 10).cast("bigint")
    return F.lpad((head % 9_000_000 + 1_000_000).cast("string"), 10, "0")


def surrogate_key(*fields: Column | str) -> Column:
    """md5 over the fields as text, nulls as empty text, joined by '|'."""
    return F.md5(F.concat_ws("|", *[F.coalesce(col(f).cast("string"), F.lit("")) for f in fields]))


def strict_key(*fields: Column | str) -> Column:
    """md5 of the '|'-joined fields; null where a field is null."""
    parts: list[Column] = []
    for f in fields:
        parts += [F.lit("|"), col(f).cast("string")]
    return F.md5(F.concat(*parts[1:]))


def row_hash(names: Sequence[str]) -> Column:
    """First 16 hex digits of the sha-256 of the sorted fields as JSON."""
    return F.substring(F.sha2(F.to_json(F.struct(*[F.col(n) for n in sorted(names)])), 256), 1, 16)


def synthetic_accession(cik: Column | str, year: Column | str) -> Column:
    """cik-year-10K##### with digits taken from an md5, so it is the same on every run."""
    number = F.conv(F.substring(F.md5(F.concat(col(cik), col(year).cast("string"))), 1, 8), 16, 10).cast("bigint") % 100_000
    return F.concat(F.lpad(col(cik), 10, "0"), F.lit("-"), col(year).cast("string"), F.lit("-10K"),
                    F.lpad(number.cast("string"), 5, "0"))


def lookup(mapping: dict, key: Column | str) -> Column:
    """Value of a small fixed table, null where the key is not in it."""
    pairs: list[Column] = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), col(key))


def tier(score: Column | str, scale: str = "scorer") -> Column:
    cuts, rest = K.TIERS[scale]
    out = None
    for cut, name in cuts:
        out = F.when(col(score) >= cut, name) if out is None else out.when(col(score) >= cut, name)
    return out.otherwise(F.lit(rest))


def tier_rank(name: Column | str) -> Column:
    return F.coalesce(lookup({t: i for i, t in enumerate(K.TIER_ORDER)}, name), F.lit(len(K.TIER_ORDER)))


def unit_noise(*keys: Column | str) -> Column:
    """A number in [0, 1) fixed by the keys: the same on every run and partitioning."""
    return F.pmod(F.xxhash64(*[col(k) for k in keys]), F.lit(1 << 52)) / F.lit(float(1 << 52))


def count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def rate(cond: Column) -> Column:
    return F.avg(F.when(cond, 1.0).otherwise(0.0))
