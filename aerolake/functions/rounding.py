"""Averages, deviations and rounding (F1, F1b and the exact sums).

Floating-point sums depend on the order rows arrive in, which differs between engines and between runs
with different partitioning. Rounding to 2 decimals then turns last-digit noise into visibly different
results on ties such as 33.425. ``exact_avg`` removes the order dependence: it adds the readings' bits, not their
rounded partial sums.

A reading is split on a fixed binary grid into four integer limbs of 60 bits: [2^60, 2^120), [1, 2^60), [2^-60, 1) and
[2^-120, 2^-60). The split is exact, limbs are added as DECIMAL(38,0) (room for 10^10 times 10^10 rows), and only the
group's four sums are carried into each other and rounded once, correctly, to a double. So the sum is the double
nearest to the true sum of the readings, whatever their order, partitioning or partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BITS = 60
_UP, _DOWN = f"{float(2**_BITS)!r}D", f"{2.0**-_BITS!r}D"
_BASE = f"CAST({2**_BITS} AS DECIMAL(38,0))"
_FAR = f"{2.0**(2 * _BITS)!r}D"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``value``, which is evaluated once."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def _limbs(x: str) -> str:
    """The four limb sums of a group as a struct; a limb of zero is left out of its sum, which costs nothing then."""
    def total(limb: str) -> str:
        return f"COALESCE(SUM(CAST(NULLIF({limb}, 0L) AS DECIMAL(28,0))), CAST(0 AS DECIMAL(38,0)))"

    near = f"CASE WHEN abs({x}) < {_FAR} THEN CAST({x} AS DOUBLE) END"
    h = f"CAST({near} * {_DOWN} AS BIGINT)"
    low = f"({near} - {h} * {_UP})"
    i = f"CAST({low} AS BIGINT)"
    frac = f"(({low} - {i}) * {_UP})"
    a = f"CAST({frac} AS BIGINT)"
    rest = f"(({frac} - {a}) * {_UP})"
    b = f"CAST({rest} AS BIGINT)"
    # Readings that the grid does not hold: as large as 2^120, with bits below 2^-120, NaN or infinite.
    odd = f"COUNT_IF({x} IS NOT NULL AND COALESCE({rest} <> {b}, TRUE))"
    return (f"named_struct('h', {total(h)}, 'i', {total(i)}, 'a', {total(a)}, 'b', {total(b)}, "
            f"'n', COUNT({x}), 'odd', {odd})")


def _carried() -> str:
    """``s`` with its limbs carried upwards: all but the highest in [0, 2^60)."""
    def step(at: str, to: str, body: str) -> str:
        fields = {c: f"s.{c}" for c in "hiab"}
        fields[at] = f"CAST(pmod(s.{at}, {_BASE}) AS DECIMAL(38,0))"
        fields[to] = f"CAST(s.{to} + (s.{at} - pmod(s.{at}, {_BASE})) / {_BASE} AS DECIMAL(38,0))"
        return _let("named_struct(" + ", ".join(f"'{c}', {e}" for c, e in fields.items()) + ")", "s", body)

    def joined(high: str, low: str, rest: str) -> str:
        """(high * 2^60 + low) * 2 plus one bit for anything below: rounds like the whole number."""
        return f"CAST(({high} * {_BASE} + {low}) * 2 + CASE WHEN {rest} THEN 1 ELSE 0 END AS DOUBLE)"

    whole = f"(s.h * {_BASE} + s.i)"
    value = (f"CASE WHEN s.h NOT IN (0, -1) THEN {joined('s.h', 's.i', 's.a <> 0 OR s.b <> 0')} * 0.5D "
             f"WHEN {whole} NOT IN (0, -1) THEN {joined(whole, 's.a', 's.b <> 0')} * 0.5D * {_DOWN} "
             f"ELSE CAST(({whole} * {_BASE} + s.a) * {_BASE} + s.b AS DOUBLE) * {_DOWN} * {_DOWN} END")
    return step("b", "a", step("a", "i", step("i", "h", value)))


def exact_sum_sql(x: str) -> str:
    """The double nearest to the sum of the non-null values of SQL expression ``x``; NULL for an all-null group."""
    return _let(_limbs(x), "s", f"CASE WHEN s.odd = 0 AND s.n > 0 THEN {_carried()} END")


def exact_avg_sql(x: str) -> str:
    """``exact_avg`` as SQL text, for a column name or any scalar expression of one."""
    mean = _let(_limbs(x), "s", f"CASE WHEN s.odd = 0 AND s.n > 0 THEN {_carried()} / s.n END")
    return f"COALESCE({mean}, AVG({x}))"


def exact_avg(c: str, exact: bool = True) -> Column:
    """Mean of the non-null values of a column or SQL expression ``c``; NULL for an all-null group.

    ``exact=True``: the nearest double to the true sum, divided by the count: independent of row order and
    partitioning. Only a group with a reading that the grid does not hold (2^120 = 1.3e36 or more, bits below
    2^-120 = 7.5e-37, NaN, infinity) gets the plain double average. ``exact=False``: always the plain average."""
    return F.expr(exact_avg_sql(c)) if exact else F.avg(F.expr(c))


def exact_std(c: str, mean: float | None) -> Column:
    """Sample deviation of column ``c`` about its mean, which the caller has computed: the squares of the distances are
    added exactly, so the result does not depend on row order or partitioning. Squares below 2^-66 (a distance of
    1.2e-10) count as zero. Readings that the grid does not hold: Spark's own deviation."""
    if mean is None or not abs(mean) < 2.0**(2 * _BITS):
        return F.stddev_samp(c)
    off = f"(`{c}` - ({mean!r}D))"
    square = f"CASE WHEN {off} * {off} < {2.0**-66!r}D THEN 0D ELSE {off} * {off} END"
    return F.coalesce(F.sqrt(F.expr(exact_sum_sql(square)) / F.nullif(F.count(c) - 1, F.lit(0))), F.stddev_samp(c))


def round2_half_even(c) -> Column:
    """Round to 2 decimals the way numpy does: ``rint(x * 100) / 100`` (ties to even on the scaled value)."""
    return F.rint(_col(c) * 100.0) / 100.0


def round2_half_away(c) -> Column:
    """SQL ``ROUND(x, 2)``: ties away from zero, applied to the scaled binary value on both signs."""
    x = _col(c)
    up = F.floor(x * 100.0 + 0.5).cast("double") / 100.0
    down = -F.floor(-x * 100.0 + 0.5).cast("double") / 100.0
    return F.when(x >= 0, up).otherwise(down)
