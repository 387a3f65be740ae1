"""Sums that do not depend on row order.

Amounts arrive as doubles. Adding doubles in whatever order tasks finish gives a slightly
different total on every run, so a re-run would rewrite marts with noise and reconciliations
would need tolerances. Facts are therefore added as whole ten-millionths in a long (one
multiply and one add per row, all in generated code, eight bytes of state per group), and
the much smaller aggregates above them as decimals.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

UNITS_PER_ONE = 10_000_000.0


def to_units(amount: Column) -> Column:
    return F.rint(amount * F.lit(UNITS_PER_ONE)).cast("long")


def sum_units(amount: Column) -> Column:
    """Fact-level sum in units; a long holds 9.2e11 currency units per group, overflow raises."""
    return F.sum(to_units(amount))


def merge_units(units: Column) -> Column:
    """Sum already aggregated units, with room for any number of groups."""
    return F.sum(units.cast("decimal(20,0)"))


def from_units(units: Column) -> Column:
    return units.cast("double") / F.lit(UNITS_PER_ONE)


def stable_sum(value: Column, scale: int = 8) -> Column:
    """Order-independent sum of doubles that carry at most ``scale`` meaningful decimals."""
    return F.sum(value.cast(f"decimal(28,{scale})")).cast("double")
