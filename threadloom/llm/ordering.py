"""Exact selection of the k-th key without sorting; numbers in a total order come from the engine's own operator."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.operators.ordering import numbered

__all__ = ["at_most", "numbered", "radix_select"]

SIGN = 1 << 63


def radix_select(keys: DataFrame, columns: list[str], k: int, bits: int = 12) -> tuple[int, ...] | None:
    """The ``k``-th smallest (from 1) composite key of ``columns`` (integers, none null), or None where there are fewer.

    Each round counts the next ``bits`` bits of the key's digits among the rows that agree
    with the digits found so far, at most 2 ** bits rows, and follows the digit in which
    the k-th row lies.
    """
    if k < 1:
        return None
    ends = keys.agg(*(F.min(c).alias(f"lo{i}") for i, c in enumerate(columns)), *(F.max(c).alias(f"hi{i}") for i, c in enumerate(columns)), F.count("*").alias("n")).first()
    if ends["n"] < k:
        return None
    found, left, rest = [], k, keys
    for i, c in enumerate(columns):
        # With its sign bit turned, a number's bits order as numbers do; those above ``width`` are the same in all.
        least, most = (int(ends[f"{side}{i}"]) % 2**64 ^ SIGN for side in ("lo", "hi"))
        width = (least ^ most).bit_length()
        value = least >> width
        bits_of = F.col(c).cast("bigint").bitwiseXOR(F.lit(-SIGN))
        while width > 0:
            step = min(bits, width)
            width -= step
            digit = F.shiftrightunsigned(bits_of, width).bitwiseAND(F.lit((1 << step) - 1))
            counts = rest.groupBy(digit.alias("digit")).agg(F.count("*").alias("n")).collect()  # 2 ** bits rows at most
            for row in sorted(counts, key=lambda r: r["digit"]):
                if row["n"] >= left:
                    value = value << step | row["digit"]
                    rest = rest.where(digit == row["digit"])
                    break
                left -= row["n"]
        found.append(value - SIGN)
    return tuple(found)


def at_most(columns: list[str], bound: tuple[int, ...]) -> Column:
    """Whether the composite key of ``columns`` is ``bound`` or smaller."""
    made = F.lit(True)
    for c, b in reversed([*zip(columns, bound, strict=True)]):
        made = (F.col(c) < b) | ((F.col(c) == b) & made)
    return made
