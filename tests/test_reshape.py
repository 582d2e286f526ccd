"""The card feed: lookups, median, single-use cards, skewed and missing cards."""

import pytest
from pyspark.sql import functions as F

from orderrisk.functions import fixed_values as fixed
from orderrisk.functions.lookups import email_country
from orderrisk.operators import reshape
from orderrisk.operators.quantiles import exact_median, exact_quantiles
from orderrisk.sources import files

CARD_SCHEMA = (
    "TransactionID bigint, TransactionDT bigint, TransactionAmt double, ProductCD string, card1 double,"
    " card4 string, addr2 double, P_emaildomain string, R_emaildomain string, D1 double, isFraud int"
)


def card(number, **changes):
    row = {
        "TransactionID": number,
        "TransactionDT": 0,
        "TransactionAmt": 10.0,
        "ProductCD": "W",
        "card1": 5.0,
        "card4": "visa",
        "addr2": 87.0,
        "P_emaildomain": "gmail.com",
        "R_emaildomain": "gmail.com",
        "D1": 1.0,
        "isFraud": 0,
    }
    row.update(changes)
    return tuple(row.values())


def reshaped(spark, rows):
    feed = spark.createDataFrame(rows, CARD_SCHEMA)
    return {r["order_id"]: r for r in reshape.reshape_card_txns(feed).collect()}


@pytest.mark.parametrize(
    ("domain", "country"),
    [
        (None, "US"),
        ("gmail.com", "US"),
        ("Gmail.com", "US"),
        ("yahoo.co.uk", "GB"),
        ("x.uk", "GB"),
        ("web.de", "DE"),
        ("yahoo.co.jp", "JP"),
        ("yahoo.com.mx", "MX"),
        ("uol.com.br", "BR"),
        ("hotmail.es", "US"),
        ("x.DE", "US"),
        ("de", "US"),
        ("", "US"),
    ],
)
def test_email_country(spark, domain, country):
    row = spark.createDataFrame([(domain,)], "d string").select(email_country("d")).first()
    assert row[0] == country


def test_last_labels_decide_like_the_suffix_list(spark):
    suffixes = fixed.COUNTRY_BY_EMAIL_SUFFIX
    domains = [start + end for start in ("", "a", "a.b", "gmail.com") for end in suffixes]
    domains += [d + tail for d in domains for tail in (".", ".com", "x")] + [d.lstrip(".") for d in domains]

    def listed(domain):
        if domain in fixed.US_EMAIL_DOMAINS:
            return "US"
        return next((country for suffix, country in suffixes.items() if domain.endswith(suffix)), "US")

    rows = spark.createDataFrame([(d,) for d in domains], "d string").select("d", email_country("d").alias("c"))
    assert {r["d"]: r["c"] for r in rows.collect()} == {d: listed(d) for d in domains}


def test_fields_and_defaults(spark):
    got = reshaped(
        spark,
        [
            card(1, TransactionDT=86400 + 3661, TransactionAmt=12.5, card1=7.0),
            card(2, ProductCD=None, card4=None, addr2=999.0, card1=None, D1=None),
            card(3, ProductCD="X", addr2=None, P_emaildomain="web.de", R_emaildomain="x.fr", D1=2.5),
            card(4, ProductCD="H", addr2=32.0, D1=3.5),
        ],
    )
    assert str(got["1"]["order_date"]) == "2017-12-01" and got["1"]["order_hour"] == 1
    assert got["1"]["customer_id"] == "C7" and got["1"]["is_new_customer"] == 1
    two = got["2"]
    assert (two["product_category"], two["payment_method"], two["billing_country"]) == ("Electronics", "visa", "US")
    assert two["customer_id"] == "C0" and two["is_new_customer"] == 0
    assert (got["3"]["shipping_country"], got["3"]["ip_country"]) == ("FR", "DE")
    assert (got["4"]["product_category"], got["4"]["billing_country"]) == ("Home & Garden", "GB")
    # The median of 1, 2.5, 3.5 is 2.5; halves go to the even number.
    assert [got[i]["account_age_days"] for i in ("1", "2", "3", "4")] == [1, 2, 2, 4]


def test_single_use_cards(spark):
    rows = [(1, 5.0), (2, 5.0), (3, 6.0), (4, None), (5, None), (6, 7.0)]
    df = spark.createDataFrame(rows, "id bigint, card double")
    got = {r["id"]: r["flag"] for r in reshape.singleton_flag(df, "card", "id", "flag").collect()}
    assert got == {1: 0, 2: 0, 3: 1, 4: 0, 5: 0, 6: 1}


def test_a_missing_card_on_a_third_of_the_rows_is_spread(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(3000).select(
            F.col("id"), F.when(F.col("id") % 3 > 0, F.col("id").cast("double")).alias("card")
        )
        flagged = reshape.singleton_flag(df, "card", "id", "flag")
        sizes = [
            r["count"]
            for r in flagged.where("card is null").groupBy(F.spark_partition_id().alias("p")).count().collect()
        ]
        assert sum(sizes) == 1000 and max(sizes) < 250
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.mark.parametrize(
    ("values", "median"),
    [([3.0], 3.0), ([1.0, 2.0], 1.5), ([5.0, 1.0, 1.0, 9.0], 3.0), ([2.5, None, 2.5], 2.5), ([-1.5, -0.5, 4.0], -0.5)],
)
def test_exact_median(spark, values, median):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert exact_median(df, "v").collect() == [(median,)]


def test_median_without_values(spark):
    assert exact_median(spark.createDataFrame([(None,)], "v double"), "v").collect() == []


def test_quantiles_match_the_built_in(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_type", "value")
    shares = [(1, 10), (1, 4), (1, 2), (9, 10)]
    ends = exact_quantiles(events, ["event_type"], F.col("value"), F.floor("value"), shares)
    den = F.element_at(F.array(*[F.lit(d) for _, d in shares]), F.col("q") + 1)
    got = {
        (r["event_type"], r["q"]): r["v"]
        for r in ends.select(
            "event_type", "q", (F.col("lo") + (F.col("hi") - F.col("lo")) * F.col("part") / den).alias("v")
        ).collect()
    }
    exact = events.groupBy("event_type").agg(
        F.percentile("value", F.array(*[F.lit(n / d) for n, d in shares])).alias("p")
    )
    for row in exact.collect():
        for q, value in enumerate(row["p"]):
            assert got[(row["event_type"], q)] == pytest.approx(value, abs=1e-9)


def test_columns_are_found_by_name_and_broken_rows_refused(spark, folder):
    orders = spark.createDataFrame(
        [("US", "1", "2024-01-01")], "billing_country string, order_id string, order_date string"
    )
    files.write_csv(orders, f"{folder}/orders")
    back = files.read_csv_text(spark, f"{folder}/orders", ["order_id", "billing_country"])
    assert back.collect() == [("1", "US")]
    with open(f"{folder}/broken.csv", "w") as out:
        out.write("order_id,billing_country\n1,US\n2,CA,extra\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        files.read_csv_text(spark, f"{folder}/broken.csv", ["order_id", "billing_country"]).collect()


def test_export_quotes_every_field(spark, folder):
    df = spark.createDataFrame([('say "hi", you', None)], "a string, b string")
    files.write_csv(df.coalesce(1), f"{folder}/out", quote_all=True)
    text = spark.read.text(f"{folder}/out").collect()
    assert [r[0] for r in text] == ['"a","b"', '"say ""hi"", you",""']


def test_amounts_round_like_scaled_numbers(spark):
    import numpy as np
    import pandas as pd

    amounts = [i / 1000 for i in range(1, 200_000)]
    raw = spark.createDataFrame(pd.DataFrame({"a": amounts}))
    found = [r[0] for r in raw.select(F.rint(F.col("a") * 100.0) / 100.0).collect()]
    assert found == np.round(amounts, 2).tolist()
