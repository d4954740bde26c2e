import datetime as dt

from helpers import money, rows

from bankmart.plans import indicators

D = dt.date


def fact(spark, *records):
    """account, date, amount, region; the year as in the stored fact."""
    return spark.createDataFrame(
        [(a, d, money(v), r, d and d.year) for a, d, v, r in records],
        "account_id long, date_key date, transaction_amount decimal(15,2), customer_region string, year int",
    )


def sample(spark):
    return fact(
        spark,
        (1, D(2024, 1, 1), "10.00", "W"), (1, D(2024, 1, 1), "2.00", "W"), (1, D(2024, 1, 30), "4.00", "W"),
        (1, D(2024, 1, 31), "1.00", "W"), (2, D(2024, 1, 3), "8.00", "E"), (2, None, "100.00", None),
    )


def calendar(spark):
    days = [(D(2024, 1, d), 2024) for d in range(1, 32)]
    return spark.createDataFrame(days, "date_key date, year int")


def test_daily_volume_shows_empty_days(spark):
    got = rows(indicators.daily_volume(sample(spark), calendar(spark)))
    assert len(got) == 31
    assert got[:3] == [(D(2024, 1, 1), 2, money("12.00")), (D(2024, 1, 2), 0, money("0.00")), (D(2024, 1, 3), 1, money("8.00"))]


def test_date_range_includes_both_ends(spark):
    got = rows(indicators.daily_volume(sample(spark), calendar(spark), D(2024, 1, 30), D(2024, 1, 31)), "date_key", "txn_count")
    assert got == [(D(2024, 1, 30), 1), (D(2024, 1, 31), 1)]


def test_rolling_average_is_over_days_with_transactions(spark):
    got = rows(indicators.rolling_30d(sample(spark)))
    m = money
    assert got == [
        (1, D(2024, 1, 1), m("12.00"), m("12.00")),
        (1, D(2024, 1, 30), m("4.00"), m("8.00")),
        (1, D(2024, 1, 31), m("1.00"), m("2.50")),
        (2, D(2024, 1, 3), m("8.00"), m("8.00")),
    ]


def test_rolling_average_of_a_range_sees_the_days_before_it(spark):
    everything = [r for r in rows(indicators.rolling_30d(sample(spark))) if r[1] >= D(2024, 1, 30)]
    assert rows(indicators.rolling_30d(sample(spark), D(2024, 1, 30))) == everything


def test_branch_rank(spark):
    got = rows(indicators.branch_volume_rank(sample(spark)))
    assert got == [(None, 1, money("100.00"), 1), ("E", 1, money("8.00"), 3), ("W", 4, money("17.00"), 2)]
    ranged = indicators.branch_volume_rank(sample(spark), D(2024, 1, 1), D(2024, 1, 3))
    assert rows(ranged) == [("E", 1, money("8.00"), 2), ("W", 2, money("12.00"), 1)]


def accounts(spark):
    return spark.createDataFrame(
        [("S", "OPEN", "W", money("10.00")), ("S", "OPEN", "W", money("60000.00")), ("S", "CLOSED", "E", money("49999.99")),
         ("C", "OPEN", "E", money("50000.00")), ("C", "OPEN", None, money("-0.01"))],
        "account_type string, account_status string, customer_region string, balance decimal(15,2)",
    )


def test_branch_liquidity_counts_open_accounts(spark):
    assert rows(indicators.branch_liquidity(accounts(spark))) == [
        (None, 1, money("-0.01")), ("E", 1, money("50000.00")), ("W", 2, money("60010.00")),
    ]


def test_balance_distribution(spark):
    assert rows(indicators.balance_distribution(accounts(spark))) == [
        ("C", -50000, 1), ("C", 50000, 1), ("S", 0, 2), ("S", 50000, 1),
    ]


def test_type_breakdown_with_and_without_filter(spark):
    everything = [("C", 2, money("49999.99")), ("S", 3, money("110009.99"))]
    assert rows(indicators.account_type_breakdown(accounts(spark))) == everything
    assert rows(indicators.account_type_breakdown(accounts(spark), ["S"])) == everything[1:]
