"""Money measures of invoice and order lines: tax split of discounts and
bonuses, nett amounts, prices.

Notation: a taxable line carries a tax base ``dpp`` and a tax ``tax``.
``split(x)`` is the part of an amount ``x`` that belongs to the base,
``x * dpp / (dpp + tax)``, and ``split_tax(x)`` the part that belongs to the
tax, ``x * tax / (dpp + tax)``. Only taxable lines with ``dpp + tax <> 0`` are
split. ``B`` is a line's summed bonus and ``Bt`` the tax part of that bonus.

Every function returns a Column; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .exprs import col, or_zero


def base(dpp, tax) -> Column:
    return col(dpp) + col(tax)


def split(x, dpp, tax) -> Column:
    return col(x) * col(dpp) / (col(dpp) + col(tax))


def split_tax(x, dpp, tax) -> Column:
    return col(x) * col(tax) / (col(dpp) + col(tax))


def splittable(taxable, dpp, tax) -> Column:
    """``bTaxable = 1 AND dpp + tax <> 0``."""
    return col(taxable) & (base(dpp, tax) != 0)


# ---------------------------------------------------------------- invoice line

def price(amount, qty) -> Column:
    """M1 ``ISNULL(amount / NULLIF(qty, 0), 0)``."""
    return F.coalesce(F.try_divide(col(amount), F.nullif(col(qty), F.lit(0))), F.lit(0))


def gross_amount(taxable, amount, dpp, tax, discount) -> Column:
    """M2: untaxed lines keep the amount; taxed lines show the base plus the
    base part of the line discount; a taxed line with zero base shows
    ``dpp + tax``."""
    return (F.when(~col(taxable), col(amount))
            .when(base(dpp, tax) != 0, col(dpp) + split(discount, dpp, tax))
            .otherwise(base(dpp, tax)))


def tax_total(tax, bonus_tax) -> Column:
    """M3 line tax plus the tax part of its bonus."""
    return col(tax) + or_zero(bonus_tax)


def nett_amount(taxable, amount, dpp, tax, discount, bonus) -> Column:
    """M4 amount after line discount and bonus, before tax."""
    b = or_zero(bonus)
    return (F.when(~col(taxable), col(amount) - col(discount) - b)
            .when(base(dpp, tax) != 0, col(dpp) - split(b, dpp, tax))
            .otherwise(base(dpp, tax)))


def nett_amount_inc_tax(taxable, amount, dpp, tax, discount, bonus, bonus_tax) -> Column:
    """M5 = M4 + line tax + bonus tax."""
    return nett_amount(taxable, amount, dpp, tax, discount, bonus) + col(tax) + or_zero(bonus_tax)


def discount_item(taxable, dpp, tax, discount) -> Column:
    """M7 base part of the line discount (``dpp + tax`` for a zero base)."""
    return (F.when(~col(taxable), col(discount))
            .when(base(dpp, tax) != 0, split(discount, dpp, tax))
            .otherwise(base(dpp, tax)))


def discount_total(taxable, dpp, tax, discount, bonus) -> Column:
    """M6 = M7 + base part of the bonus (the whole bonus when not split)."""
    b = or_zero(bonus)
    bonus_part = (F.when(~col(taxable), b)
                  .when(base(dpp, tax) != 0, split(b, dpp, tax))
                  .otherwise(b))
    return discount_item(taxable, dpp, tax, discount) + bonus_part


def bonus_tax_term(bonus, line_tax, line_discount) -> Column:
    """M9 tax share of one bonus row: ``bonus * tax / discount``, 0 when the
    line has no discount."""
    return (F.when(col(line_discount) == 0, F.lit(0))
            .otherwise(col(bonus) * col(line_tax) / col(line_discount)))


# ------------------------------------------------------------------ order line

# Discount kinds of an order line's principal discount reference.
DISC_ITEM = "Invoice Disc. Item"
DISC_ITEM_2 = "Invoice Disc. Item 2"
DISC_INVOICE = "Invoice Disc."


def bonus_dpp_weight(taxable, dpp, tax) -> Column:
    """Share of a bonus that goes to the base: ``dpp/(dpp+tax)`` when split,
    else the whole bonus (weight 1)."""
    return F.when(splittable(taxable, dpp, tax), col(dpp) / base(dpp, tax)).otherwise(F.lit(1.0))


def bonus_tax_weight(taxable, dpp, tax, untaxed_counts: bool) -> Column:
    """Share of a bonus that goes to the tax. When the line is not split the
    source counts the whole bonus for the second and invoice discount kinds
    (``untaxed_counts=True``) and nothing for the first kind (M11)."""
    return (F.when(splittable(taxable, dpp, tax), col(tax) / base(dpp, tax))
            .otherwise(F.lit(1.0 if untaxed_counts else 0.0)))


def po_discount_dpp(taxable, dpp, ppn, discount) -> Column:
    """M12 base part of a purchase line discount."""
    return F.when(splittable(taxable, dpp, ppn), split(discount, dpp, ppn)).otherwise(col(discount))


def po_discount_tax(taxable, dpp, ppn, discount) -> Column:
    """M12 tax part of a purchase line discount (0 when not split)."""
    return F.when(splittable(taxable, dpp, ppn), split_tax(discount, dpp, ppn)).otherwise(F.lit(0))


def unit_price_net(taxable, dpp, tax, unit_price) -> Column:
    """M13 unit price without tax."""
    return F.when(splittable(taxable, dpp, tax), split(unit_price, dpp, tax)).otherwise(col(unit_price))


def nett_amount_incl_ppn(amount, faktur_dpp, faktur_tax) -> Column:
    """M14 ``amount - ISNULL(faktur_dpp, 0) - ISNULL(faktur_tax, 0)``."""
    return col(amount) - or_zero(faktur_dpp) - or_zero(faktur_tax)


def positive_load(qty, spec, divisor: float = 1000.0) -> Column:
    """M25 ``CASE WHEN qty <= 0 THEN 0 ELSE qty * ISNULL(spec, 0) / 1000 END``."""
    return F.when(col(qty) <= 0, F.lit(0)).otherwise(col(qty) * or_zero(spec) / F.lit(divisor))
