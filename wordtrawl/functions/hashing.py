"""Token hashes and signature arithmetic, all as JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIGNATURE_BITS = 64


def token_hash64(term: Column) -> Column:
    """Last eight bytes of the MD5 of the UTF-8 term, as a BIGINT with the same bits.

    ``conv`` with a negative target base writes the 64 bits as a signed number, so the cast cannot overflow.
    """
    return F.conv(F.substring(F.md5(term.cast("binary")), 17, 16), 16, -10).cast("bigint")


def hamming(a: Column, b: Column) -> Column:
    """Number of differing signature bits."""
    return F.bit_count(a.bitwiseXOR(b))


def bit_similarity(a: Column, b: Column) -> Column:
    """Share of equal bits of two 64-bit signatures."""
    return F.lit(1.0) - hamming(a, b) / F.lit(float(SIGNATURE_BITS))


def max_differing_bits(threshold: float) -> int:
    """Largest Hamming distance whose similarity still reaches ``threshold``."""
    if not 0.0 <= threshold <= 1.0:
        raise ValueError("threshold must lie in [0, 1]")
    return max(d for d in range(SIGNATURE_BITS + 1) if (SIGNATURE_BITS - d) / SIGNATURE_BITS >= threshold)
