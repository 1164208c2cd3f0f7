import pytest
from pyspark.sql import functions as F

from fleetmart.functions import draws
from fleetmart.plans import generate as g
from tests.conftest import rows

N = 20_000


@pytest.fixture(scope="module")
def orders(spark):
    return g.generate_orders(g.series(spark, N)).cache()


def test_draws_look_random(spark):
    df = spark.range(N).select(*[(draws.draw(F.col("id"), s) / draws.SPAN).alias(f"u{s}") for s in (1, 2, 65)])
    stats = df.agg(
        F.avg("u1"), F.stddev("u1"), F.corr("u1", "u2"), F.corr("u1", "u65"), F.min("u1"), F.max("u1")
    ).first()
    assert abs(stats[0] - 0.5) < 0.01 and abs(stats[1] - 12**-0.5) < 0.01
    assert abs(stats[2]) < 0.03 and abs(stats[3]) < 0.03
    assert stats[4] >= 0 and stats[5] < 1
    lagged = spark.range(N).select(draws.draw(F.col("id"), 1).alias("a"), draws.draw(F.col("id") + 1, 1).alias("b"))
    assert abs(lagged.agg(F.corr("a", "b")).first()[0]) < 0.03


def test_partitions_do_not_matter(spark):
    series = g.series(spark, 500)
    for make in (g.generate_orders, g.generate_customers, g.generate_drivers, g.generate_locations):
        assert rows(make(series.repartition(7))) == rows(make(series.coalesce(1)))
    assert rows(g.generate_orders(series, seed=2)) != rows(g.generate_orders(series, seed=1))


def test_shares_and_bounds(orders):
    s = orders.agg(
        F.count("*").alias("n"),
        F.countDistinct("external_order_id").alias("keys"),
        F.avg((F.col("current_status") == 5).cast("int")).alias("done"),
        F.avg((F.col("current_status") == 6).cast("int")).alias("cancelled"),
        F.avg(F.col("driver_id").isNull().cast("int")).alias("driverless"),
        F.min("price").alias("p0"),
        F.max("price").alias("p1"),
        F.min("distance_km").alias("k0"),
        F.max("distance_km").alias("k1"),
        F.min("driver_id").alias("d0"),
        F.max("driver_id").alias("d1"),
        F.max("customer_id").alias("c1"),
        F.max("tariff_id").alias("t1"),
        F.min("created_at").cast("string").alias("from"),
        F.max("created_at").cast("string").alias("to"),
        F.min("current_status").alias("s0"),
    ).first()
    assert s.n == s["keys"] == N
    assert abs(s.done - 0.85) < 0.01 and abs(s.cancelled - 0.10) < 0.01 and abs(s.driverless - 0.10) < 0.01
    assert 150 <= s.p0 and s.p1 <= 2500 and 1 <= s.k0 and s.k1 <= 60
    assert 1 <= s.d0 and s.d1 <= 2_000 and s.c1 <= 10_000 and s.t1 == 5 and s.s0 == 1
    assert s["from"] >= "2026-02-01" and s["to"] < "2026-03-18"


def test_delivery_follows_status(orders):
    assert orders.where("(current_status = 5) <> (delivered_at IS NOT NULL)").isEmpty()
    ride = F.unix_micros("delivered_at") - F.unix_micros("created_at")
    low, high = orders.agg(F.min(ride), F.max(ride)).first()
    assert 600_000_000 <= low and high <= 3_600_000_000


def test_plates_are_unique(spark):
    assert g.generate_drivers(g.series(spark, 20_000)).select("vehicle_number").distinct().count() == 20_000
    assert spark.range(1).select(g.plate(F.lit(1))).first()[0] == "В007АА66"
    far = spark.range(1, 1_000_000, 997).select(g.plate(F.col("id")))
    assert far.distinct().count() == far.count()


def test_phones_keep_all_digits(spark):
    numbers = spark.range(1, 10**9, 99_999_999).withColumnRenamed("id", "i")
    found = [r.phone for r in g.generate_customers(numbers).collect()]
    assert found[:2] == ["+79990000001", "+7999100000000"] and len(set(found)) == len(found)


def test_draws_differ_beyond_the_low_word(spark):
    columns = [c for c in g.generate_orders(g.series(spark, 1)).columns if c not in ("order_id", "external_order_id")]
    near = spark.range(1, 300).withColumnRenamed("id", "i")
    for step in (1 << 32, (1 << 32) - 73244475, (1 << 32) + 73244475):
        far = near.select((F.col("i") + step).alias("i"))
        a, b = ({tuple(r) for r in g.generate_orders(d).select(columns).collect()} for d in (near, far))
        assert not a & b


def test_events(frame):
    orders = frame(
        "order_id bigint, current_status int, created_at timestamp_ntz, delivered_at timestamp_ntz",
        *[],
    )
    assert g.order_events(orders).isEmpty()


def test_event_per_order_and_end(orders):
    events = g.order_events(orders)
    counts = {r.status_id: r["count"] for r in events.groupBy("status_id").count().collect()}
    by_status = {r.current_status: r["count"] for r in orders.groupBy("current_status").count().collect()}
    assert counts == {1: N, 5: by_status[5], 6: by_status[6]}
    late = events.where("status_id = 6").join(orders, "order_id").where("event_time <> created_at + INTERVAL 5 MINUTES")
    assert late.isEmpty()
