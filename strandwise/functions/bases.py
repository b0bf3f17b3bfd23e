"""Bases, pairings, strands and the expressions on them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The order of bases and of pairings (genome base first, then read base).
BASES = ("A", "C", "G", "T")
N = 4
PAIRINGS = tuple(x + y for x in BASES for y in BASES)
EDITS = tuple(p for p in PAIRINGS if p[0] != p[1])
FREQS = ("fa", "fc", "fg", "ft")


def base_code(base: Column) -> Column:
    """A, C, G, T as 0 to 3; anything else, null included, as 4."""
    at = F.when(F.length(base) == 1, F.instr(F.lit("ACGT"), base)).otherwise(0)
    return F.coalesce(F.when(at > 0, at - 1), F.lit(N)).cast("tinyint")


def strand_code(strand: Column, codes: dict[str, int]) -> Column:
    """A caller's strand code as -1, 0 or 1; an unknown one raises."""
    out = None
    for text, value in codes.items():
        out = F.when(strand == text, F.lit(value)) if out is None else out.when(strand == text, F.lit(value))
    return out.otherwise(F.raise_error(F.concat(F.lit("unknown strand code "), F.coalesce(strand, F.lit("null")))).cast("int")).cast("tinyint")


def int_list(text: Column) -> Column:
    """'[a, b]' or 'a,b' as an array of integers."""
    return F.transform(F.split(F.regexp_replace(text, r"[\[\]\s]", ""), ","), lambda x: x.cast("int"))


def vector_item(vector: Column, index: int) -> Column:
    """An element of a comma vector, as a long; null outside of it."""
    return F.get(F.split(vector, ","), F.lit(index)).cast("bigint")


def vector(*columns: Column) -> Column:
    """Numbers as a comma vector."""
    return F.concat_ws(",", *(c.cast("string") for c in columns))


def a_to_g(sequence: Column) -> Column:
    """The sequence with its adenines as guanines, in either case."""
    return F.translate(sequence, "Aa", "Gg")


def log2_ratio(a: Column, b: Column) -> Column:
    """log2(a / b) if both are above 0."""
    return F.when((a > 0) & (b > 0), F.log2(a / b))


def score10(p: Column) -> Column:
    """-log10 of a p-value, clipped at 1e-300."""
    return -F.log10(F.greatest(p, F.lit(1e-300)))
