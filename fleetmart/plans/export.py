"""The warehouse back to the files it can be loaded from."""

from __future__ import annotations

from pyspark.sql import DataFrame

from fleetmart.contracts import RAW_FILES, TABLES
from fleetmart.operators.lookup import fits_broadcast, heavy_keys, lookup
from fleetmart.session import together
from fleetmart.sources.csv_files import write_csv
from fleetmart.sources.warehouse import Warehouse

SMALL = ("tariffs", "statuses")
# id of the order, dimension, its name, column of the file, kind of lookup
NAMES = (
    ("customer_id", "customers", "external_id", "customer_external_id", "inner"),
    ("driver_id", "drivers", "external_id", "driver_external_id", "left"),
    ("pickup_location_id", "locations", "address", "pickup_address", "inner"),
    ("dropoff_location_id", "locations", "address", "dropoff_address", "inner"),
    ("tariff_id", "tariffs", "name", "tariff_name", "inner"),
)


def export_dimension(rows: DataFrame, entity: str) -> DataFrame:
    """Natural columns in the order of the ids, which themselves stay behind."""
    raw = RAW_FILES[entity]
    return rows.orderBy(raw.table.identity).select(*raw.required)


def export_orders(orders: DataFrame, dims: dict[str, DataFrame]) -> DataFrame:
    """Orders with names in place of ids, as a delivery file has them.

    The hot ids of all columns that look into a large dimension are found in one pass.
    """
    out = orders
    far = [column for column, dim, natural, _, _ in NAMES if not fits_broadcast(dims[dim].select(TABLES[dim].identity, natural))]
    hot = heavy_keys(orders, far) if far else {}
    for column, dim, natural, name, how in NAMES:
        identity = TABLES[dim].identity
        out = lookup(out, dims[dim], (column, identity), {natural: name}, how, keys_from=orders, hot=hot.get(column))
    return out.select(*RAW_FILES["orders"].required, "delivered_at", "current_status")


def export_all(warehouse: Warehouse, folder: str) -> dict[str, str]:
    """All six files; loading them again gives the same warehouse."""
    dims = {r.table.name: warehouse.read(r.table.name) for r in RAW_FILES.values() if r.entity != "orders"}

    def write(entity: str) -> str:
        if entity == "orders":
            rows = export_orders(warehouse.read("orders"), dims)
        else:
            rows = export_dimension(dims[RAW_FILES[entity].table.name], entity)
        return write_csv(rows, f"{folder}/{entity}.csv", single_file=entity in SMALL)

    return dict(zip(RAW_FILES, together([lambda entity=entity: write(entity) for entity in RAW_FILES])))
