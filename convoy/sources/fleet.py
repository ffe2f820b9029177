"""Fleet tables.

Two ways in:

* :func:`load_fleet` reads fleet tables written earlier (``vehicles/``,
  ``drivers/`` ... parquet folders) - the production path.
* :func:`fleet_from_tpch` derives the six fleet tables from the driver's
  TPC-H-style parquet tables (``supplier`` -> vehicles, ``customer`` ->
  drivers, ``nation`` pairs -> routes, ``orders`` -> trips, ``lineitem`` ->
  deliveries, ``part`` -> maintenance). Every column is a pure expression of
  the input rows, so the same rows can be rebuilt in SQL by the oracle.

Everything is lazy: the returned DataFrames are plans, and Catalyst prunes the
columns each query does not use down to the parquet scan.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from convoy.sources.schemas import FLEET_SCHEMAS

# Fixed value of the fleet mapping: route ids are origin * 25 + destination.
ROUTE_KEY_SPACE = 25

#: Rows that one task sorts at most, so that no sort outgrows its memory (and
#: spills) however many rows there are.
SORT_ROWS = 500_000

FLEET_TABLES = ("vehicles", "drivers", "routes", "trips", "deliveries", "maintenance")


@dataclass
class Fleet:
    vehicles: DataFrame
    drivers: DataFrame
    routes: DataFrame
    trips: DataFrame
    deliveries: DataFrame
    maintenance: DataFrame

    def items(self):
        return [(f.name, getattr(self, f.name)) for f in fields(self)]

    def register(self, prefix: str = "") -> "Fleet":
        """Expose the tables as temp views for ``spark.sql`` users."""
        for name, df in self.items():
            df.createOrReplaceTempView(prefix + name)
        return self


def read_driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def load_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Read one fleet table previously written under ``base`` with its explicit schema."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}")
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in FLEET_SCHEMAS[name].fields])


def load_fleet(spark: SparkSession, base: str) -> Fleet:
    """Read fleet tables previously written under ``base`` with explicit schemas."""
    return Fleet(**{t: load_table(spark, base, t) for t in FLEET_TABLES})


class LazyFleet(Fleet):
    """Fleet tables that ``table(name)`` brings when they are first asked for."""

    def __init__(self, table: Callable[[str], DataFrame] | None = None, **tables: DataFrame):
        self._table = table
        for name, df in tables.items():
            setattr(self, name, df)

    def __getattr__(self, name: str) -> DataFrame:  # a table not asked for before
        if name not in FLEET_TABLES:
            raise AttributeError(name)
        df = self._table(name)
        setattr(self, name, df)
        return df


def sort_tasks(spark: SparkSession, rows: int) -> list[int]:
    """Number of partitions, as an optional argument, that a sort of ``rows`` is dealt
    to: none (the session's, joined by AQE) while those hold :data:`SORT_ROWS` each at most."""
    width = -(-rows // SORT_ROWS)
    return [width] if width > int(spark.conf.get("spark.sql.shuffle.partitions")) else []


def _days(n) -> F.Column:
    return F.make_dt_interval(days=n.cast("int"))


def _hours(n) -> F.Column:
    return F.make_dt_interval(hours=n.cast("int"))


def _minutes(n) -> F.Column:
    return F.make_dt_interval(mins=n.cast("int"))


def fleet_from_tpch(spark: SparkSession, sf_dir: str) -> Fleet:
    read = lambda n: read_driver_table(spark, sf_dir, n)

    supplier = read("supplier")
    # Vehicle count is a one-row scalar subquery, evaluated once per query.
    n_vehicles = supplier.select(F.count(F.lit(1))).scalar()

    # vehicles <- supplier
    k = F.col("s_suppkey")
    vehicles = supplier.select(
        k.alias("vehicle_id"),
        F.concat(F.lit("VEH"), k.cast("string")).alias("license_plate"),
        F.when(k % 4 == 0, "Camion Grande").when(k % 4 == 1, "Camion Mediano")
         .when(k % 4 == 2, "Van").otherwise("Motocicleta").alias("vehicle_type"),
        F.when(k % 4 == 0, 5000).when(k % 4 == 1, 3000).when(k % 4 == 2, 1500)
         .otherwise(50).cast("decimal(10,2)").alias("capacity_kg"),
        F.when(k % 4 < 2, "diesel").otherwise("gasolina").alias("fuel_type"),
        F.date_add(F.lit("1990-01-01").cast("date"), (k % 3000).cast("int")).alias("acquisition_date"),
        F.when(k % 10 == 9, "maintenance").otherwise("active").alias("status"),
    )

    # drivers <- customer (namesakes on purpose: last name cycles every 700 keys)
    c = F.col("c_custkey")
    drivers = read("customer").select(
        c.alias("driver_id"),
        F.concat(F.lit("EMP"), c.cast("string")).alias("employee_code"),
        F.col("c_mktsegment").alias("first_name"),
        F.concat(F.lit("D"), (c % 700).cast("string")).alias("last_name"),
        F.concat(F.lit("LIC"), c.cast("string")).alias("license_number"),
        (F.lit("2001-07-01 00:00:00").cast("timestamp_ntz") + _days(c % 1125))
        .cast("date").alias("license_expiry"),
        F.concat(F.lit("300"), F.lpad((c % 10000000).cast("string"), 7, "0")).alias("phone"),
        F.date_add(F.lit("1990-01-01").cast("date"), (c % 4000).cast("int")).alias("hire_date"),
        F.when(c % 20 == 19, "inactive").otherwise("active").alias("status"),
    )

    # routes <- ordered pairs of distinct nations. Route ids are
    # origin * 25 + destination, so the key space is 25 nations; each origin
    # is expanded to the other keys of that space and resolved with an
    # equi-join (no pair enumeration, no nested-loop join).
    nation = read("nation").select("n_nationkey", "n_name")
    origins = nation.select(
        F.col("n_nationkey").alias("o_key"), F.col("n_name").alias("origin_city"),
        F.explode(F.sequence(F.lit(0), F.lit(ROUTE_KEY_SPACE - 1))).alias("d_key")
    ).where(F.col("d_key") != F.col("o_key"))
    dest = nation.select(F.col("n_nationkey").alias("d_key"), F.col("n_name").alias("destination_city"))
    pairs = origins.join(F.broadcast(dest), "d_key")
    prod = (F.col("o_key") + 1) * (F.col("d_key") + 1)
    dist = F.lit(120) + (prod * 37) % 981
    rid = (F.col("o_key") * 25 + F.col("d_key")).cast("bigint")
    routes = pairs.select(
        rid.alias("route_id"),
        F.concat(F.lit("R"), rid.cast("string")).alias("route_code"),
        "origin_city", "destination_city",
        dist.cast("decimal(10,2)").alias("distance_km"),
        (F.lit(2) + prod % 14).cast("decimal(5,2)").alias("estimated_duration_hours"),
        (F.lit(15000) * F.floor(dist / 100).cast("int")).cast("decimal(10,2)").alias("toll_cost"),
    )

    # trips <- orders (status P = still under way, arrival NULL)
    o = F.col("o_orderkey")
    cu = F.col("o_custkey")
    open_trip = F.col("o_orderstatus") == "P"
    orders = read("orders")
    trips = orders.select(
        o.alias("trip_id"),
        (o % n_vehicles).alias("vehicle_id"),
        cu.alias("driver_id"),
        ((o % 25) * 25 + ((o % 25) + 1 + (cu % 24)) % 25).cast("bigint").alias("route_id"),
        (F.col("o_orderdate") + _hours(F.lit(6) + o % 14)).alias("departure_datetime"),
        F.when(open_trip, F.lit(None).cast("timestamp_ntz"))
         .otherwise(F.col("o_orderdate") + _hours(F.lit(8) + o % 14 + cu % 12)).alias("arrival_datetime"),
        (F.lit(10) + (cu * 7 + o) % 150).cast("decimal(10,2)").alias("fuel_consumed_liters"),
        (F.lit(20) + (o * 13) % 2500).cast("decimal(10,2)").alias("total_weight_kg"),
        F.when(open_trip, "in_progress").otherwise("completed").alias("status"),
    )

    # deliveries <- lineitem: one delivery per order line, numbered within the
    # order (window partitioned by l_orderkey: the shuffle on the order key is
    # reused by the join to trips below). The window group is one order's
    # lines, which the TPC-H layout bounds (a handful per order), so no group
    # grows with the data; this numbering is part of the test-data mapping,
    # not of the reports.
    w = Window.partitionBy("l_orderkey").orderBy(
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_shipdate")
    lines = read("lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_returnflag", "l_shipdate")
    rows = {"trips": orders.count(), "deliveries": lines.count()}  # from the file footers
    if width := sort_tasks(spark, rows["deliveries"]):
        lines = lines.repartition(*width, "l_orderkey")
    lines = lines.withColumn("rn", F.row_number().over(w))
    t = trips.select("trip_id", "route_id", "departure_datetime", "arrival_datetime")
    r = routes.select("route_id", "destination_city")
    x = lines.join(t, lines.l_orderkey == t.trip_id).join(r, "route_id")
    late_min = F.when(F.col("l_partkey") % 10 == 0,
                      F.lit(60) + (F.col("l_orderkey") + F.col("l_suppkey")) % 121) \
                .otherwise(F.col("l_partkey") % 61 - 30)
    arrived = F.col("arrival_datetime").isNotNull()
    # Narrow rows: what write_fleet sorts; the texts are made of them after it.
    narrow = x.select(
        (F.col("l_orderkey") * 100 + F.col("rn")).alias("delivery_id"),
        "l_orderkey", "l_partkey", "l_suppkey", "destination_city",
        F.col("l_quantity").cast("decimal(10,2)").alias("package_weight_kg"),
        (F.col("departure_datetime") + _minutes(F.col("rn") * 30)).alias("scheduled_datetime"),
        F.when(arrived, F.col("departure_datetime") + _minutes(F.col("rn") * 30 + late_min))
         .alias("delivered_datetime"),
        arrived.alias("arrived"),
        (arrived & (F.col("l_returnflag") != "R")).alias("recipient_signature"),
    )

    # maintenance <- part
    p = F.col("p_partkey")
    mdate = (F.lit("1995-01-01 00:00:00").cast("timestamp_ntz") + _days(p % 2400)).cast("date")
    maintenance = read("part").select(
        p.alias("maintenance_id"),
        (p % n_vehicles).alias("vehicle_id"),
        mdate.alias("maintenance_date"),
        F.col("p_type").alias("maintenance_type"),
        F.concat(F.col("p_type"), F.lit(" programado para "),
                 F.date_format(mdate, "yyyy-MM-dd")).alias("description"),
        F.col("p_retailprice").cast("decimal(10,2)").alias("cost"),
        F.date_add(mdate, (F.lit(30) + F.col("p_size") % 61).cast("int")).alias("next_maintenance_date"),
        F.concat(F.lit("Tecnico "), F.col("p_brand")).alias("performed_by"),
    )

    return DerivedFleet(vehicles, drivers, routes, trips, _delivery_columns(narrow), maintenance, narrow, rows)


@dataclass
class DerivedFleet(Fleet):
    """Fleet tables with the rows that the deliveries are made of, and the number of
    source rows of the tables that are sorted."""
    delivery_rows: DataFrame
    source_rows: dict[str, int]

    def items(self):
        return super().items()[:len(FLEET_TABLES)]


def _delivery_columns(rows: DataFrame) -> DataFrame:
    did = F.col("delivery_id").cast("string")
    return rows.select(
        "delivery_id",
        F.col("l_orderkey").alias("trip_id"),
        F.concat(F.lit("FL"), did).alias("tracking_number"),
        F.concat(F.lit("Customer "), F.col("l_partkey").cast("string")).alias("customer_name"),
        F.concat(F.lit("Calle "), F.col("l_suppkey").cast("string"), F.lit(", "),
                 F.col("destination_city")).alias("delivery_address"),
        "package_weight_kg",
        "scheduled_datetime",
        "delivered_datetime",
        F.when(F.col("arrived"), "delivered").otherwise("pending").alias("delivery_status"),
        "recipient_signature",
    )


def write_table(fleet: Fleet, name: str, path: str, mode: str = "overwrite") -> None:
    """Materialise one fleet table.

    Trips and deliveries are range-partitioned on their main timestamp
    before writing, so every file (and parquet row group) covers a narrow
    time range: time filters are answered from the min/max statistics and
    skip most files, and no task writes more than its share of the range.
    """
    # The id is a second range key: rows sharing one timestamp value (e.g.
    # the NULL delivered time of every pending delivery) are still split
    # over many tasks instead of forming one huge range.
    order = {"trips": ["departure_datetime", "trip_id"],
             "deliveries": ["delivered_datetime", "delivery_id"]}
    narrow = name == "deliveries" and isinstance(fleet, DerivedFleet)
    df = fleet.delivery_rows if narrow else getattr(fleet, name)
    if name in order:
        width = sort_tasks(df.sparkSession, fleet.source_rows[name] if isinstance(fleet, DerivedFleet) else df.count())
        df = df.repartitionByRange(*width, *order[name]).sortWithinPartitions(*order[name])
    if narrow:
        df = _delivery_columns(df)
    df.write.mode(mode).parquet(path)


def write_fleet(fleet: Fleet, base: str, mode: str = "overwrite") -> None:
    """Materialise the fleet tables (:func:`write_table`)."""
    for name in FLEET_TABLES:
        write_table(fleet, name, f"{base.rstrip('/')}/{name}", mode)


_CACHE: dict[tuple[str, str, str], str] = {}
_PROCESS_TOKEN = uuid.uuid4().hex[:12]


def _fingerprint(sf_dir: str) -> str:
    """Identity of a driver-table folder: names, sizes and mtimes of its files."""
    h = hashlib.sha1(os.path.abspath(sf_dir).encode())
    try:
        for name in sorted(os.listdir(sf_dir)):
            st = os.stat(os.path.join(sf_dir, name))
            h.update(f"{name}:{st.st_size}:{int(st.st_mtime)}".encode())
    except OSError:  # remote file system: the path alone identifies it
        pass
    return h.hexdigest()[:16]


def cached_fleet(spark: SparkSession, sf_dir: str) -> Fleet:
    """Fleet tables derived from ``sf_dir``, each written once to the shared
    checkpoint folder when a query first asks for it, then read back by every
    query (instead of re-deriving them from the TPC-H tables in every plan)."""
    from convoy.session import checkpoint_dir

    root, print_ = checkpoint_dir(spark).rstrip("/"), _fingerprint(sf_dir)

    def table(name: str) -> DataFrame:
        key = (root, print_, name)
        if key not in _CACHE:
            base = f"{root}/convoy-fleet-{print_}-{_PROCESS_TOKEN}"
            write_table(fleet_from_tpch(spark, sf_dir), name, f"{base}/{name}")
            _CACHE[key] = base
        return load_table(spark, _CACHE[key], name)

    return LazyFleet(table)
