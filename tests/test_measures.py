from hypothesis import given, settings
from hypothesis import strategies as st

from tradeflow.functions import measures as M

COLS = "taxable boolean, amount double, dpp double, tax double, disc double, bonus double, btax double, qty double"


def py_line(taxable, amount, dpp, tax, disc, bonus, btax, qty):
    """The CASE rules of the source SQL, written out in Python."""
    b, bt = bonus or 0.0, btax or 0.0
    base = dpp + tax
    price = amount / qty if qty else 0
    if taxable is False:   # null is unknown: the source takes the taxed branch
        gross, nett, item = amount, amount - disc - b, disc
        bonus_part = b
    elif base != 0:
        gross, nett, item = dpp + disc * dpp / base, dpp - b * dpp / base, disc * dpp / base
        bonus_part = b * dpp / base
    else:
        gross = nett = item = base
        bonus_part = b
    return dict(Price=price, Amount=gross, Tax=tax + bt, NettAmount=nett, NettAmountIncTax=nett + tax + bt,
                Discount=item + bonus_part, DiscountItem=item)


ROWS = [
    (False, 100.0, 90.0, 9.0, 10.0, 5.0, 0.5, 2.0),     # untaxed
    (True, 100.0, 90.0, 9.0, 10.0, 5.0, 0.5, 2.0),      # taxed, split
    (True, 0.0, 0.0, 0.0, 0.0, 3.0, None, 0.0),         # taxed, zero base, zero qty
    (True, 50.0, 45.0, 4.5, 0.0, None, None, -1.0),     # no discount, no bonus, negative qty
    (None, 10.0, 9.0, 0.9, 1.0, 1.0, 0.1, 1.0),         # unknown taxable follows the taxed branch
]


def _eval(spark, rows):
    df = spark.createDataFrame(rows, COLS)
    c = ("taxable", "amount", "dpp", "tax", "disc", "bonus", "btax")
    return df.select(
        M.price("amount", "qty").alias("Price"),
        M.gross_amount("taxable", "amount", "dpp", "tax", "disc").alias("Amount"),
        M.tax_total("tax", "btax").alias("Tax"),
        M.nett_amount(*c[:6]).alias("NettAmount"),
        M.nett_amount_inc_tax(*c).alias("NettAmountIncTax"),
        M.discount_total("taxable", "dpp", "tax", "disc", "bonus").alias("Discount"),
        M.discount_item("taxable", "dpp", "tax", "disc").alias("DiscountItem")).collect()


def test_line_measures_every_branch(spark):
    for row, got in zip(ROWS, _eval(spark, ROWS)):
        exp = py_line(*row)
        for k, v in exp.items():
            assert abs(got[k] - v) < 1e-9, (row, k, got[k], v)


@settings(max_examples=25, deadline=None)
@given(st.floats(0.01, 1e6), st.floats(0.0, 0.5), st.floats(0.0, 1e5))
def test_split_parts_add_up(spark, dpp, rate, bonus):
    tax = dpp * rate
    df = spark.createDataFrame([(True, dpp, tax, bonus)], "t boolean, dpp double, tax double, b double")
    r = df.select(M.split("b", "dpp", "tax").alias("d"), M.split_tax("b", "dpp", "tax").alias("x")).first()
    assert abs(r.d + r.x - bonus) <= 1e-9 * max(1.0, bonus)


def test_bonus_weights_asymmetric_default(spark):
    df = spark.createDataFrame([(False, 10.0, 1.0)], "t boolean, dpp double, tax double")
    r = df.select(M.bonus_dpp_weight("t", "dpp", "tax").alias("d"),
                  M.bonus_tax_weight("t", "dpp", "tax", False).alias("t1"),
                  M.bonus_tax_weight("t", "dpp", "tax", True).alias("t2")).first()
    assert (r.d, r.t1, r.t2) == (1.0, 0.0, 1.0)


def test_positive_load(spark):
    df = spark.createDataFrame([(0.0, 5.0), (-2.0, 5.0), (3.0, None), (4.0, 500.0)], "q double, s double")
    got = [r.v for r in df.select(M.positive_load("q", "s").alias("v")).collect()]
    assert got == [0.0, 0.0, 0.0, 2.0]
