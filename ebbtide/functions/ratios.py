"""Guarded arithmetic, as SQL expression text.

The feature families hold hundreds of expressions, so they are written as SQL
text and parsed in one go. Division never raises and never yields infinity.
"""

from __future__ import annotations

# Sums of money and volume are kept on a fixed decimal grid, so the order in
# which tasks add doubles cannot show in results, ranks or ties.
SUM_DECIMALS = 6


def zero_sum(*values: str) -> str:
    """Row-wise sum with null as zero."""
    return "(" + " + ".join(f"coalesce({v}, 0)" for v in values) + ")"


def ratio_or_zero(num: str, den: str) -> str:
    """``num / den``; zero for a zero or missing denominator."""
    return f"coalesce({num} / nullif({den}, 0), 0D)"


def ratio_or_sign(num: str, den: str) -> str:
    """``num / den``; with a zero denominator the sign of ``num``."""
    return f"coalesce({num} / nullif({den}, 0), signum({num}), 0D)"


def relative_change(recent: str, base: str) -> str:
    """``(recent - base) / base``; growth from zero counts as plus or minus one."""
    return ratio_or_sign(f"(coalesce({recent}, 0) - coalesce({base}, 0))", f"coalesce({base}, 0)")


def rate_change(num_recent: str, den_recent: str, num_base: str, den_base: str) -> str:
    """Relative change between two rates given as sum and volume.

    A rate with no volume is unbounded when its sum is not zero: unbounded
    against a bounded base counts as one with the sign of both, and an
    unbounded base makes the change undefined, which counts as zero.
    """
    recent, base = ratio_or_zero(num_recent, den_recent), ratio_or_zero(num_base, den_base)
    return (
        f"CASE WHEN coalesce({den_base}, 0) = 0 AND coalesce({num_base}, 0) <> 0 THEN 0D"
        f" WHEN coalesce({den_recent}, 0) = 0 AND coalesce({num_recent}, 0) <> 0"
        f" THEN signum({num_recent}) * CASE WHEN {base} < 0 THEN -1 ELSE 1 END"
        f" ELSE {relative_change(recent, base)} END"
    )
