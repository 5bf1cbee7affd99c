"""The polynomial string hash used as a bitmap offset.

h = h * 61 + code(c) for every character, then ``& mask``. Masking after every
step gives the same low bits as masking once at the end (low bits only depend
on low bits) and keeps the value far from long overflow, so the expression is
exact under ANSI mode and stays a JVM-side higher-order function.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Multiplier and default mask (2^29 - 1, a 64 MB bitmap).
HASH_SEED = 61
DEFAULT_MASK = (1 << 29) - 1


def poly_hash(s: str | Column, mask: int = DEFAULT_MASK) -> Column:
    col = F.col(s) if isinstance(s, str) else s
    chars = F.filter(F.split(col, ""), lambda x: x != F.lit(""))
    return F.aggregate(
        chars, F.lit(0).cast("long"),
        lambda acc, ch: (acc * F.lit(HASH_SEED) + F.ascii(ch).cast("long"))
        .bitwiseAND(F.lit(mask).cast("long")))
