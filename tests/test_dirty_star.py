"""The analytic rewrites (eager aggregation, semi joins, the total over all lines)
against plain Python over the rows of a star with duplicate dimension keys, NULL
and dangling fact keys, and one store holding a third of all lines."""

import datetime as dt
import decimal
import random
from collections import defaultdict

import pytest

from loomstar.plans import analytics as A


def make_star():
    rnd = random.Random(11)
    fact = []
    for i in range(900):
        store = 1 if i % 3 == 0 else rnd.choice([2, 3, 4, 5, 99, None])   # 99 dangles
        product = rnd.choice([10, 11, 12, 13, 77, None])                  # 77 dangles
        fact.append((rnd.randint(0, 59), store, product, rnd.randint(1, 50)))
    store = [(1, "Web Portal", 10, "L1", "C1"), (2, "Kind A", 20, "L1", "C2"),
             (3, "Kind A", 30, "L2", "C1"), (4, "Kind B", 5, "L3", "C2"),
             (4, "Kind B", 5, "L3", "C2"),                                 # duplicate key
             (5, None, 7, None, "C3")]
    product = [(10, decimal.Decimal("1.10")), (11, decimal.Decimal("2.25")),
               (12, decimal.Decimal("999.99")), (12, decimal.Decimal("999.99")),  # duplicate
               (13, decimal.Decimal("0.01"))]
    base = dt.datetime(2020, 1, 1)
    date_dim = [(k, base + dt.timedelta(days=7 * k), 2020 + (7 * k) // 366,
                 (base + dt.timedelta(days=7 * k)).month) for k in range(55)]  # keys 55-59 dangle
    return fact, store, product, date_dim


@pytest.fixture(scope="module")
def star(spark):
    fact, store, product, date_dim = make_star()
    frames = {
        "fact": spark.createDataFrame(fact, "date_key long, store_code long, product_code long, product_quantity smallint"),
        "store": spark.createDataFrame(store, "store_code long, store_type string, staff_numbers smallint, locality string, country_code string"),
        "product": spark.createDataFrame(product, "product_code long, product_price decimal(12,2)"),
        "date_dim": spark.createDataFrame(date_dim, "date_key long, datetime timestamp_ntz, year int, month int"),
    }
    return frames


def lines():
    """(date key, store code, pieces, amount) of every line and listed product."""
    fact, _, product, _ = make_star()
    return [(day, code, n, n * price) for day, code, item, n in fact for key, price in product if key == item]


def summed(pairs):
    out = defaultdict(decimal.Decimal)
    for key, amount in pairs:
        out[key] += amount
    return {k: float(v) for k, v in out.items()}


def test_sales_by_month(star):
    days = make_star()[3]
    want = summed((month, amount) for day, _, _, amount in lines() for key, _, _, month in days if key == day)
    got = A.sales_by_month_top(star["fact"], star["date_dim"], star["product"], 12).collect()
    assert {r.month: r.total_sales for r in got} == pytest.approx(want)
    assert [r.total_sales for r in got] == sorted(want.values(), reverse=True)


def test_sales_by_year_month_with_filter_only_store_join(star):
    _, store, _, days = make_star()
    want = summed(((year, month), amount) for day, code, _, amount in lines() for s in store if s[0] == code
                  for key, _, year, month in days if key == day)
    got = A.sales_by_year_month_top(star["fact"], star["store"], star["product"], star["date_dim"], 100).collect()
    assert {(r.year, r.month): r.total_sales for r in got} == pytest.approx(want)


def test_online_vs_offline(star):
    want = {"Online": [0, 0], "Offline": [0, 0]}
    for _, code, pieces, _ in lines():
        for s in make_star()[1]:
            if s[0] == code:
                entry = want["Online" if s[1] == "Web Portal" else "Offline"]
                entry[0] += 1
                entry[1] += pieces
    got = A.online_vs_offline(star["fact"], star["store"], star["product"]).collect()
    assert {r.location: [r.total_sales, r.total_products_sold] for r in got} == want


def test_share_of_total(star):
    amounts = lines()
    everything = float(sum(x[3] for x in amounts))
    want = summed((s[1], amount) for _, code, _, amount in amounts for s in make_star()[1] if s[0] == code)
    got = A.sales_share_by_type(star["fact"], star["store"], star["product"]).collect()
    assert {r.store_type: r.total_sales for r in got} == pytest.approx(want)
    assert {r.store_type: r.percentage_total for r in got} == pytest.approx(
        {k: round(v * 100 / everything, 2) for k, v in want.items()})


def test_share_of_total_scans_the_fact_once(star, spark, tmp_dir):
    star["fact"].write.parquet(f"{tmp_dir}/fact")
    df = A.sales_share_by_type(spark.read.parquet(f"{tmp_dir}/fact"), star["store"], star["product"])
    assert df._jdf.queryExecution().optimizedPlan().toString().count("parquet") == 1


def test_distinct_stores(star):
    sold = {code for _, code, _, _ in make_star()[0]}
    want = defaultdict(set)
    for s in make_star()[1]:
        if s[0] in sold:
            want[s[4]].add(s[0])
    got = A.stores_per_country(star["fact"], star["store"]).collect()
    assert {r.country_code: r.num_stores for r in got} == {k: len(v) for k, v in want.items()}
