"""Edge rows of every cleaning rule."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from sparkmart.functions.dates import segment
from sparkmart.functions.parse import NULL_TOKENS, null_if_token, typed
from sparkmart.operators import cleaning
from sparkmart.plans import transforms

DAY = dt.date(2026, 3, 10)


def column(df, name):
    return [r[name] for r in df.collect()]


def test_first_copy_wins_even_if_it_is_bad(extract, staging):
    rows = [(1, "lamp", None, D(5), "s"), (1, "lamp", "light", D(5), "s"), (2, "cup", "k", D(1), "s")]
    result = transforms.transform_products(extract("products", rows), DAY, staging)
    assert column(result.rows, "product_id") == [2]
    assert result.output == 1
    assert result.input == 3
    assert result.nulls == {"product_id": 0, "product_name": 0, "category": 1}


@pytest.mark.parametrize("parts", [1, 3, 7])
def test_keep_first_does_not_depend_on_partitioning(spark, parts):
    rows = [(k, p) for p in range(40) for k in (p % 5, None)]
    df = spark.createDataFrame(rows, "k INT, p INT").repartition(parts, "p")
    first = cleaning.keep_first(df, ["k"], ["p"])
    assert sorted(map(tuple, first.collect()), key=str) == [
        (0, 0), (1, 1), (2, 2), (3, 3), (4, 4), (None, 0),
    ]


def test_keep_first_over_whole_rows_and_without_order(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, 2)], "a INT, b INT")
    assert cleaning.keep_first(df).count() == 2
    with pytest.raises(ValueError):
        cleaning.keep_first(df, ["a"])


def test_copies_are_counted(spark):
    df = spark.createDataFrame([(1, 5), (1, 4), (2, 3), (None, 2), (None, 1)], "k INT, p INT")
    rows = cleaning.keep_first(df, ["k"], ["p"], copies="n").collect()
    assert sorted(map(tuple, rows), key=str) == [(1, 4, 2), (2, 3, 1), (None, 1, 2)]


SIGN_CASES = {
    "no negatives": ([(3, 1), (0, 1), (None, 1)], {}, 3),
    "one negative": ([(3, 1), (0, 1), (None, 1), (-1, 1)], {"quantity": 1}, 2),
    "row gone for the second column": ([(-1, -1), (2, None), (3, 4)], {"quantity": 1}, 2),
    "both columns": ([(-1, 1), (2, -2), (3, None), (4, 4)], {"quantity": 1, "price": 1}, 1),
    "second only": ([(None, 1), (2, -2), (3, 4)], {"price": 1}, 2),
    "empty": ([], {}, 0),
}


@pytest.mark.parametrize("case", SIGN_CASES)
def test_sign_rule(spark, case):
    rows, expected, kept = SIGN_CASES[case]
    df = spark.createDataFrame(rows, "quantity INT, price INT")
    columns = ("quantity", "price")
    figures = df.agg(*[f.alias(n) for n, f in cleaning.sign_counts(columns, F.lit(True)).items()])
    seen = figures.first().asDict()
    flagged = cleaning.flagged_columns(columns, seen)
    assert flagged == expected
    assert list(flagged) == list(expected)
    assert cleaning.kept_rows(flagged, seen) == kept
    left = rows
    for i, name in enumerate(columns):  # the rule as it is stated
        if any(r[i] is not None and r[i] < 0 for r in left):
            left = [r for r in left if r[i] is not None and r[i] >= 0]
    known = cleaning.keep_non_negative(df, flagged)
    assert sorted(map(str, map(tuple, known.collect()))) == sorted(map(str, left))
    assert known.count() == kept


def test_sign_messages(extract, staging):
    rows = [(i, 1, 1, 1, q, D(p), DAY) for i, (q, p) in enumerate([(-1, 5), (-2, 5), (3, -1), (4, 5)])]
    products = extract("products", [(1, "lamp", "light", D(2), "s")]).rows
    result = transforms.transform_sales(extract("sales", rows), products, staging)
    assert result.messages == [
        "Found 2 negative values in quantity", "Found 1 negative values in price",
    ]
    assert result.output == 1


def test_missing_values_and_addresses_are_reported(extract, staging):
    names = ("a", "b")
    rows = [(k, *names, mail, None, "c", "s", DAY) for k, mail in enumerate(["x@y", "xy", None, "z"])]
    result = transforms.transform_customers(extract("customers", rows), DAY, staging)
    assert result.warnings == [
        "Found 1 null values in required column: email", "Found 2 invalid email addresses",
    ]
    assert result.figures == {"nulls_email": 1, "invalid_emails": 2} and result.output == 3


def test_email_repair(spark):
    df = spark.createDataFrame([("abc",), ("a@b",), ("@",), (None,)], "email STRING")
    assert column(cleaning.repair_email(df), "email") == [
        "invalid@email.com", "a@b", "@", "invalid@email.com",
    ]


def test_segment_bounds(spark):
    ages = [-1, 0, 1, 30, 31, 90, 91, 365, 366]
    rows = [(DAY - dt.timedelta(days=a),) for a in ages] + [(None,)]
    df = spark.createDataFrame(rows, "d DATE").select(segment(F.col("d"), DAY).alias("s"))
    assert column(df, "s") == [
        None, None, "New", "New", "Recent", "Recent", "Established", "Established", "Loyal", None,
    ]


def test_null_tokens(spark):
    assert len(NULL_TOKENS) == 19
    df = spark.createDataFrame([(t,) for t in [*NULL_TOKENS, "none", "0", "x"]], "t STRING")
    kept = df.select(null_if_token(F.col("t")).alias("t")).where("t IS NOT NULL")
    assert column(kept, "t") == ["none", "0", "x"]


@pytest.mark.parametrize(
    "text, kind, value",
    [
        ("12", "id", 12), (" 12 ", "id", 12), ("12.0", "id", 12), ("12.5", "id", None),
        ("x", "int", None), (" 7.25", "money", D("7.250000")), ("1.005", "money", D("1.005")),
        ("2026-03-10", "date", DAY), ("2026-03-10 11:12:13", "date", DAY), ("soon", "date", None),
        (" a ", "text", " a "),
    ],
)
def test_typed(spark, text, kind, value):
    df = spark.createDataFrame([(text,)], "t STRING")
    assert df.select(typed(F.col("t"), kind).alias("v")).first().v == value


def test_unknown_products_and_costs(extract, staging):
    """Absent product, product without cost, product removed by the sign rule."""
    products = [
        (1, "lamp", "light", D(2), "s"), (2, "cup", "kitchen", None, "s"), (3, "pan", "kitchen", D(-1), "s"),
    ]
    clean_products = transforms.transform_products(extract("products", products), DAY, staging)
    assert column(clean_products.rows, "product_id") == [1]  # a NULL cost goes once one is negative
    sales = [(i, p, 1, 1, 2, D(5), DAY) for i, p in enumerate([1, 2, 3, 4])]
    result = transforms.transform_sales(extract("sales", sales), clean_products.rows, staging)
    row = result.rows.first()
    assert (row.order_id, row.revenue, row.cost, row.profit) == (0, D(10), D(4), D(6))
    assert result.output == result.rows.count() == 1


def test_known_product_without_cost(extract, staging):
    products = extract("products", [(1, "lamp", "light", None, "s")])
    clean_products = transforms.transform_products(products, DAY, staging)
    assert clean_products.output == 1
    sales = extract("sales", [(1, 1, 1, 1, 2, D(5), DAY)])
    assert transforms.transform_sales(sales, clean_products.rows, staging).output == 0


def test_customers_and_stores(extract, staging):
    customers = [
        (1, "A", "B", "nobody", None, "c", "s", DAY - dt.timedelta(days=10)),
        (2, "A", "B", None, None, "c", "s", None),
        (3, "A", "B", "a@b", None, None, None, None),
    ]
    result = transforms.transform_customers(extract("customers", customers), DAY, staging)
    rows = {r.customer_id: (r.email, r.customer_segment) for r in result.rows.collect()}
    assert rows == {1: ("invalid@email.com", "New"), 3: ("a@b", None)}
    stores = [(1, "a", "b", None, "r", None, None), (2, "a", "b", "s", None, None, None)]
    result = transforms.transform_stores(extract("stores", stores), staging)
    assert column(result.rows, "store_id") == [1]
