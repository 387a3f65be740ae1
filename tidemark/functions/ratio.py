"""Division and currency choice."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column, otherwise: float | None = 0.0) -> Column:
    """``num / den`` where ``den`` is positive, else ``otherwise`` (None leaves it NULL)."""
    ratio = F.when(den > 0, F.try_divide(num.cast("double"), den.cast("double")))
    return ratio if otherwise is None else F.when(den > 0, ratio).otherwise(F.lit(otherwise))


def plain_ratio(num: Column, den: Column) -> Column:
    """Unguarded division: a zero denominator gives NULL, which the not-null gate drops."""
    return F.try_divide(num.cast("double"), den.cast("double"))


def round_half_up(value: Column, digits: int) -> Column:
    """Round a quotient as written in decimals.

    A quotient meant to end in exactly 5 lands a hair above or below it as a double; nine
    decimals drop that hair first, so ties always go up, on any engine.
    """
    return F.round(value.cast("decimal(38,9)"), digits).cast("double")


def currency_pick(
    gbp: Column, eur: Column, product_pl: str = "product_pl", region: str | None = None, total: str = "EUR"
) -> Column:
    """Sterling for the UK line, euro elsewhere.

    With ``region`` the UK line must also be the United Kingdom region (the customer metrics'
    rule). ``total`` names the currency of the UK & EU line.
    """
    pl = F.col(product_pl)
    if region is None:
        sterling = pl.isNull() | (pl == "UK")
    else:
        rg = F.col(region)
        sterling = (pl.isNull() & rg.isNull()) | ((pl == "UK") & (rg == "United Kingdom"))
    if total == "GBP":
        sterling = sterling | (pl == "UK & EU")
    return F.when(sterling, gbp).otherwise(eur)
