import datetime
import decimal

from fleetmart.plans import marts
from tests.conftest import rows

D = decimal.Decimal
SCHEMA = (
    "order_id bigint, external_order_id string, customer_id bigint, driver_id bigint, tariff_id int, price decimal(10,2), "
    "distance_km decimal(7,3), created_at timestamp_ntz, delivered_at timestamp_ntz, current_status int"
)
T0 = datetime.datetime(2026, 1, 1, 2)


def order(n, customer=1, driver=1, price="10.00", km="2.000", at=T0, done=None, status=5):
    return (n, f"o{n}", customer, driver, 1, D(price), D(km), at, done, status)


def test_driver_report(frame):
    drivers = frame("driver_id bigint, name string, vehicle_number string", (1, "A", "A1"), (2, "B", "B1"), (3, "C", "C1"))
    orders = frame(SCHEMA, order(1, price="10.00", km="3.000"), order(2, price="0.01", km="0.000", status=None), order(3, driver=None), order(4, driver=2, km="0.000"))
    assert rows(marts.drivers_efficiency(orders, drivers)) == [
        (1, "A", "A1", 2, D("10.01"), D("5.01"), D("3.000"), D("3.34")),
        (2, "B", "B1", 1, D("10.00"), D("10.00"), D("0.000"), D("0.00")),
    ]


def test_average_is_rounded_once(frame):
    """200 prices with a mean of 1.004999…: rounding in two steps gives 1.01."""
    orders = frame(SCHEMA, *[order(n, price="1.00" if n % 200 > 99 or n == 0 else "1.01") for n in range(200)])
    drivers = frame("driver_id bigint, name string, vehicle_number string", (1, "A", "A1"))
    total = sum(D("1.00") if n % 200 > 99 or n == 0 else D("1.01") for n in range(200))
    expected = (total / 200).quantize(D("0.01"), decimal.ROUND_HALF_UP)
    assert rows(marts.drivers_efficiency(orders, drivers), "avg_order_value") == [(expected,)] == [(D("1.00"),)]


def test_customer_report(frame):
    customers = frame("customer_id bigint, name string, email string", (1, "A", "a@x"), (2, "B", None))
    later = datetime.datetime(2026, 3, 5, 1)
    orders = frame(SCHEMA, order(1), order(2, price="5.00", at=later))
    assert rows(marts.customer_analytics(orders, customers)) == [
        (1, "A", "a@x", 2, D("15.00"), D("7.50"), D("4.000"), T0, later, 62),
        (2, "B", None, 0, D("0.00"), D("0.00"), D("0.000"), None, None, None),
    ]


def test_turnaround_report(frame):
    statuses = frame("status_id int, name string", (5, "done"))
    tariffs = frame("tariff_id int, name string", (1, "plain"))

    def after(seconds):
        return T0 + datetime.timedelta(seconds=seconds)

    orders = frame(
        SCHEMA,
        order(1, done=after(30)),
        order(2, done=after(29)),
        order(3, done=after(-30)),
        order(4),
        order(5, status=None),
        order(6, status=6),
    )
    got = rows(marts.orders_sla(orders, statuses, tariffs), "order_id", "total_duration_minutes", "final_status", "tariff_name")
    assert got == [(1, 1, "done", "plain"), (2, 0, "done", "plain"), (3, -1, "done", "plain"), (4, None, "done", "plain")]
