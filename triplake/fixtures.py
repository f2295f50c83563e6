"""Trips and zones made from the given tables, as FIXTURES.md maps them.

A line item is a trip and a nation is a zone. Key arithmetic places NULLs and
faults, so that every quality rule finds rows at every scale.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from triplake.functions.trips import OBJECT_PREFIX, OBJECT_SUFFIX, source_month
from triplake.operators.align import align, union_aligned
from triplake.schemas import BRONZE_TRIPS, ZONES
from triplake.session import scratch_dir
from triplake.sources.lake import gathered
from triplake.sources.objects import file_system, glob_objects


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _null_where(broken: Column, value: Column) -> Column:
    return F.when(~broken, value)


def trips_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze trips with the name of the object each would be delivered in."""
    item, part, price = F.col, F.col("l_partkey"), F.col("l_extendedprice")
    # The customer is joined to the order, not to its many lines, so that on large
    # tables the lines are shuffled once less.
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    joined = (
        table(spark, sf_dir, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    )
    # Line 7 arrives in the object of a month that it does not belong to.
    month = F.when(item("l_linenumber") == 7, "1900-01").otherwise(
        F.date_format("o_orderdate", "yyyy-MM")
    )
    values = {
        "file_name": F.concat(F.lit(OBJECT_PREFIX), month, F.lit(OBJECT_SUFFIX)),
        "VendorID": item("l_linenumber").cast("bigint"),
        "tpep_pickup_datetime": _null_where(part % 103 == 0, item("o_orderdate")),
        "tpep_dropoff_datetime": _null_where(part % 101 == 0, item("l_shipdate")),
        "passenger_count": _null_where(item("l_quantity") == 50, item("l_quantity") % 12 - 1),
        "trip_distance": _null_where(part % 97 == 0, item("l_discount")),
        "RatecodeID": item("l_linenumber").cast("double"),
        "store_and_fwd_flag": item("l_returnflag"),
        "PULocationID": item("s_nationkey").cast("bigint"),
        "DOLocationID": item("c_nationkey").cast("bigint"),
        "payment_type": item("l_linenumber").cast("bigint"),
        "fare_amount": _null_where(
            part % 89 == 0, F.when(part % 53 == 0, -price).otherwise(price)
        ),
        "extra": item("l_tax"),
        "mta_tax": F.lit(0.5),
        "tip_amount": item("l_discount"),
        "tolls_amount": F.lit(0.0),
        "improvement_surcharge": F.lit(1.0),
        "total_amount": price,
        "congestion_surcharge": _null_where(item("l_linenumber") == 1, F.lit(2.5)),
        "airport_fee": F.lit(None).cast("double"),
    }
    return joined.select(*(value.alias(name) for name, value in values.items()))


def trips_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips joined and stored once, for what reads them more than once."""
    root, trips = scratch_dir(spark, "joined"), trips_source(spark, sf_dir)
    trips.write.option("compression", "zstd").parquet(root)
    return spark.read.schema(trips.schema).parquet(root)


def trips_aligned(spark: SparkSession, sf_dir: str, trips: DataFrame | None = None) -> DataFrame:
    month = source_month(F.col("file_name")).alias("source_month")
    return align(trips_source(spark, sf_dir) if trips is None else trips, BRONZE_TRIPS, month)


def trips_drifted(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The same trips as three deliveries whose schemas have drifted apart: one
    with other numeric types and another case, one with a column missing, one
    with its columns in another order."""
    root, vendor = scratch_dir(spark, "deliveries"), F.col("VendorID")
    delivery = F.when(vendor > 4, "retyped").when(vendor > 1, "shorter").otherwise("first")
    trips = trips_source(spark, sf_dir)
    # Joined and stored once, and not once for each delivery.
    trips.withColumn("delivery", delivery).write.partitionBy("delivery").parquet(root)
    stored = spark.read.schema(trips.schema.add("delivery", "string")).parquet(root)
    retyped, shorter, first = (
        stored.filter(F.col("delivery") == name).drop("delivery")
        for name in ("retyped", "shorter", "first")
    )
    retyped = retyped.withColumnsRenamed({"airport_fee": "Airport_fee", "VendorID": "vendorid"})
    retyped = retyped.withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("bigint"),
            "RatecodeID": F.col("RatecodeID").cast("string"),
            "vendorid": F.col("vendorid").cast("int"),
        }
    )
    shorter, first = shorter.drop("airport_fee"), first.drop("congestion_surcharge")
    return [retyped, shorter, first.select(*reversed(first.columns))]


def trips_zoned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same trips, whose pickups are delivered as instants."""
    at = F.col("tpep_pickup_datetime")
    day = F.year(at), F.month(at), F.day(at)
    time = F.hour(at), F.minute(at), F.extract(F.lit("SECOND"), at)
    instant = F.make_timestamp(*day, *time, F.lit("UTC"))
    return trips_source(spark, sf_dir).withColumn("tpep_pickup_datetime", instant)


def trips_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = source_month(F.col("file_name")).alias("source_month")
    return union_aligned(align(df, BRONZE_TRIPS, month) for df in trips_drifted(spark, sf_dir))


def deliver_trips(spark: SparkSession, trips: DataFrame, folder: str, *more: DataFrame) -> None:
    """Store trips as a source delivers them: one Parquet object for each month. ``more``
    trips come as further parts of the same objects, in schemas of their own."""
    for part in (trips, *more):
        gathered(part, "file_name").write.mode("append").partitionBy("file_name").parquet(folder)
    # Spark names the folders after the column as well; objects have plain names.
    for found in glob_objects(spark, f"{folder}/file_name=*"):
        name = found.name.removeprefix("file_name=")
        (stored, fs), (named, _) = file_system(spark, found.path), file_system(spark, f"{folder}/{name}")
        if not fs.rename(stored, named):
            raise OSError(f"cannot rename {found.path}")


def deliver_again(spark: SparkSession, folder: str, name: str, schema: StructType, wanted: Column) -> None:
    """Deliver an object anew with only its ``wanted`` trips; without any, if it never came.
    ``schema`` is that of trips with the names of their objects."""
    path, fewer = f"{folder}/{name}", scratch_dir(spark, "again")
    columns = StructType([field for field in schema if field.name != "file_name"])
    came = glob_objects(spark, path)
    rows = spark.read.schema(columns).parquet(path) if came else spark.createDataFrame([], columns)
    # Not over the files that are being read.
    rows.filter(wanted).write.parquet(fewer)
    spark.read.schema(columns).parquet(fewer).write.mode("overwrite").parquet(path)


def trip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips as lines of text, for objects whose bytes can be told from the tables."""
    cents = F.round(F.col("total_amount") * 100).cast("bigint")
    parts = [F.col(c).cast("string") for c in ("VendorID", "PULocationID", "DOLocationID")]
    line = F.concat_ws(",", *parts, cents.cast("string"))
    return trips_source(spark, sf_dir).select("file_name", line.alias("line"))


def deliver_lines(lines: DataFrame, folder: str) -> None:
    """Store lines in order, one text file for each object."""
    ordered = lines.repartition("file_name").sortWithinPartitions("file_name", "line")
    ordered.write.partitionBy("file_name").text(folder)


def deliver_zones(zones: DataFrame, path: str) -> None:
    """Store zones as CSV with a header, blanks kept as they are."""
    keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    zones.write.options(header=True, **keep).csv(path)


def zone_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones as text, each with its key: zones 1 to 4 have an id that is no number, a field
    less, a field more, and a quoted comma."""
    nation = F.col("n_nationkey")
    names = [F.col("n_name"), F.col("n_name"), F.lit("Z")]
    plain = F.concat_ws(",", nation.cast("string"), *names)
    line = (
        F.when(nation == 1, F.concat(F.lit("x"), plain))
        .when(nation == 2, F.concat_ws(",", nation.cast("string"), *names[:2]))
        .when(nation == 3, F.concat(plain, F.lit(",more")))
        .when(nation == 4, F.concat_ws(",", nation.cast("string"), F.lit('"a, b"'), *names[1:]))
        .otherwise(plain)
    )
    return table(spark, sf_dir, "nation").select(nation.alias("key"), line.alias("line"))


def deliver_zone_lines(lines: DataFrame, folder: str) -> None:
    """Store lines in order behind a header, as one file."""
    spark = lines.sparkSession
    header = spark.createDataFrame([(None, ",".join(ZONES.names))], "key int, line string")
    ordered = header.union(lines.select(F.col("key").cast("int"), "line")).repartition(1)
    ordered.sortWithinPartitions(F.asc_nulls_first("key")).select("line").write.text(folder)


def zones_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone lookup in which zones 1 to 3 each lack one attribute."""
    nation = F.col("n_nationkey")
    joined = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    service = F.concat(F.lit("Z"), F.col("n_regionkey").cast("string"))
    return joined.select(
        nation.alias("LocationID"),
        F.when(nation == 1, "  ").otherwise(F.col("r_name")).alias("Borough"),
        _null_where(nation == 2, F.col("n_name")).alias("Zone"),
        F.when(nation == 3, "").otherwise(service).alias("service_zone"),
    )
