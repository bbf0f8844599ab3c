"""Random rows through the cleaning of sales, against a plain loop that says the same."""

from __future__ import annotations

import datetime as dt
import uuid
from decimal import Decimal as D

from hypothesis import HealthCheck, given, settings, strategies as st

from sparkmart.plans import transforms
from sparkmart.schemas import SALES
from sparkmart.staging import Staging

DAY = dt.date(2026, 3, 10)
COSTS = {1: D("2.5"), 2: D("0"), 3: None}

small = st.one_of(st.none(), st.integers(1, 4))
sale = st.tuples(
    st.one_of(st.none(), st.integers(1, 6)),
    small,
    small,
    small,
    st.one_of(st.none(), st.integers(-1, 3)),
    st.one_of(st.none(), st.sampled_from([D("-1.5"), D("0"), D("1.005"), D("9.99")])),
)


def expected(rows):
    """The rules one after the other, each over the whole list."""
    first = {}
    for row in rows:
        first.setdefault(row[0], row)
    kept = [r for r in first.values() if None not in r[:4]]
    messages = []
    for at, name in ((4, "quantity"), (5, "price")):
        negative = sum(r[at] is not None and r[at] < 0 for r in kept)
        if negative:
            messages.append(f"Found {negative} negative values in {name}")
            kept = [r for r in kept if r[at] is not None and r[at] >= 0]
    known = [r for r in kept if COSTS.get(r[1]) is not None]
    measures = []
    for order_id, product, _, _, quantity, price in known:
        revenue = None if None in (quantity, price) else quantity * price
        cost = None if quantity is None else quantity * COSTS[product]
        profit = None if None in (revenue, cost) else revenue - cost
        measures.append((order_id, revenue, cost, profit))
    return sorted(measures), messages


@settings(
    max_examples=12,
    deadline=None,
    suppress_health_check=[HealthCheck.function_scoped_fixture],
)
@given(rows=st.lists(sale, max_size=25))
def test_sales_cleaning(spark, extract, tmp_path, rows):
    costs = spark.createDataFrame(list(COSTS.items()), "product_id BIGINT, unit_cost DECIMAL(18,6)")
    staging = Staging(spark, str(tmp_path / uuid.uuid4().hex))
    sales = extract(SALES.name, [(*r, DAY) for r in rows])
    result = transforms.transform_sales(sales, costs, staging)
    got = result.rows.select("order_id", "revenue", "cost", "profit").collect()
    measures, messages = expected(rows)
    assert sorted(map(tuple, got)) == measures
    assert result.messages == messages
    assert (result.input, result.output) == (len(rows), len(measures))
