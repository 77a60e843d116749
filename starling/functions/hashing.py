"""Stable, reproducible "random" values derived from business keys.

The reference draws ``random``/``uuid4`` values once in pandas.  A lazy Spark
plan may be evaluated several times (retries, several sinks, a lost executor
recomputing a partition), so every such value here is a pure function of the
row's key: the first 32 bits of ``md5(salt | key...)``.  The same value is
computable in plain SQL elsewhere, e.g.
``CAST(('0x' || substr(md5(concat_ws('|', salt, key)), 1, 8)) AS BIGINT)``.

All of it is native Spark expressions (md5, substring, conv): no Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TWO_POW_32 = 4294967296


def _key(salt: str, parts) -> Column:
    cols = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.concat_ws("|", F.lit(salt), *[c.cast("string") for c in cols])


def md5_hex(salt: str, *parts) -> Column:
    """32 hex chars of md5(salt|parts...); also a stable 32-char identifier."""
    return F.md5(_key(salt, parts))


def slice32(hex_col: Column, i: int) -> Column:
    """The i-th (0..3) 32-bit unsigned slice of an md5 hex string, as BIGINT."""
    return F.conv(F.substring(hex_col, 1 + 8 * i, 8), 16, 10).cast("bigint")


def hash32(salt: str, *parts) -> Column:
    """Unsigned 32-bit stable hash of the key, in [0, 2^32)."""
    return slice32(md5_hex(salt, *parts), 0)


def below(h: Column, p: float) -> Column:
    """True with probability ~p for a uniform 32-bit hash (integer threshold, exact in any engine)."""
    return h < F.lit(int(round(p * TWO_POW_32)))


def pick(values: Sequence[str], h: Column) -> Column:
    """Uniform choice from a fixed list, indexed by a 32-bit hash."""
    arr = F.array(*[F.lit(v) for v in values])
    return F.element_at(arr, (F.pmod(h, F.lit(len(values))) + 1).cast("int"))


def int_between(h: Column, lo: int, hi: int) -> Column:
    """Integer uniform on [lo, hi] (both inclusive), like ``random.randint``."""
    return (F.lit(lo) + F.pmod(h, F.lit(hi - lo + 1))).cast("int")


def stable_id(prefix: str, *parts) -> Column:
    """Deterministic replacement for ``str(uuid4())``: md5 of the business key."""
    return md5_hex(prefix, *parts)
