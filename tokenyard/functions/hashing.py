"""Repeatable uniforms from a row id and a seed, independent of partitioning.

Only integer arithmetic below 2^62 is used (masking, xor, shifts, products of a 31-bit value and a
27-bit constant), so the same numbers can be computed exactly by any SQL engine with 64-bit ints.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

M31 = (1 << 31) - 1  # mask and modulus (2^31 - 1 is prime)
MIX = 0x45D9F3B  # odd 27-bit multiplier of a 32-bit integer finaliser
TWO31 = 1 << 31
TWO62 = float(1 << 62)


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it several times in ``body`` (keeps the expression linear)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _mix31(x: Column) -> Column:
    for _ in range(2):
        x = _let(x, lambda v: (F.shiftright(v, 16).bitwiseXOR(v) * F.lit(MIX)).bitwiseAND(F.lit(M31)))
    return _let(x, lambda v: F.shiftright(v, 16).bitwiseXOR(v))


def hash62(row_id: Column, seed: int) -> Column:
    """A well-mixed value in [0, 2^62) for a non-negative row id."""
    def body(rid):
        lo = F.pmod(rid, F.lit(M31))
        hi = F.pmod(F.floor(rid / F.lit(M31)).cast("long"), F.lit(M31))
        h1 = _mix31(lo.bitwiseXOR(_mix31(hi.bitwiseXOR(F.lit(seed & M31)))))
        return _let(h1, lambda h: h * F.lit(TWO31) + _mix31(h.bitwiseXOR(F.lit((seed * 7919 + 1) & M31))))

    return _let(row_id.cast("long"), body)


def uniform_index(row_id: Column, seed: int, n: Column | int) -> Column:
    """T5: an integer in [0, n), uniform up to a bias of n / 2^62."""
    n = F.lit(n) if isinstance(n, int) else n
    return F.pmod(hash62(row_id, seed), n.cast("long"))


def uniform01(row_id: Column, seed: int) -> Column:
    """A double in [0, 1)."""
    return hash62(row_id, seed).cast("double") / F.lit(TWO62)


def hash62_sql(row_id: str, seed: int) -> str:
    """The same function as DuckDB SQL text (for the oracle queries)."""

    def mix(x: str) -> str:
        for _ in range(2):
            x = f"((xor(({x}) >> 16, ({x})) * {MIX}) & {M31})"
        return f"xor(({x}) >> 16, ({x}))"

    lo = f"(({row_id}) % {M31})"
    hi = f"((({row_id}) // {M31}) % {M31})"
    h1 = mix(f"xor({lo}, {mix(f'xor({hi}, {seed & M31})')})")
    h2 = mix(f"xor({h1}, {(seed * 7919 + 1) & M31})")
    return f"(({h1}) * {TWO31} + ({h2}))"
