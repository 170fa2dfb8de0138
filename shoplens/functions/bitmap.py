"""Bit offset of a user id in the visitor bitmap."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# longest decimal text of a BIGINT, sign included
_LONGEST = 20


def bit_offset(column: str, bits: int = 29, seed: int = 61) -> Column:
    """Polynomial hash of the id's decimal text, cut to ``bits`` bits; a longer text than a BIGINT's is an error.

    Every power of the seed is reduced first, so each term stays below
    2**(bits + 7) and their sum inside a BIGINT; the result equals the unreduced
    polynomial cut at the end.  Written out term by term, it stays in codegen.
    """
    if bits > 50:
        raise ValueError("bits must be at most 50")
    size = 1 << bits
    backwards = F.reverse(F.col(column).cast("string"))
    total = F.lit(0).cast("bigint")
    for place in range(_LONGEST):
        digit = F.ascii(F.substring(backwards, place + 1, 1)).cast("bigint")
        total = total + digit * F.lit(pow(seed, place, size)).cast("bigint")
    whole = F.when(F.length(backwards) > _LONGEST, F.raise_error(F.lit("the id is longer than a BIGINT"))).otherwise(total)
    return F.pmod(whole.cast("bigint"), F.lit(size).cast("bigint"))
