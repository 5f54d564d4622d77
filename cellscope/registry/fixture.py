"""Tower records derived from the order tables, with the raw tower schema.

One order becomes one tower; its lines give the number of samples and the last
update.  The numbers below are the fixed values of this derivation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import lookup

EPOCH_SHIFT = 725846400
RADIO_OF_PRIORITY = {
    "1-URGENT": "NR", "2-HIGH": "LTE", "3-MEDIUM": "UMTS", "4-NOT SPECIFIED": "GSM",
}
COUNTRY_OF_REMAINDER = {
    0: "Indonesia", 1: "Malaysia", 2: "Thailand", 3: "Vietnam", 4: "Philippines",
    5: "Singapore", 6: "Myanmar", 7: "Cambodia", 8: "Laos", 9: "Brunei", 10: "East Timor",
}

# Five centres in the min-max space of (LON, LAT, RANGE).
CENTERS = (
    (0.21, 0.17, 0.33),
    (0.83, 0.24, 0.52),
    (0.47, 0.55, 0.61),
    (0.19, 0.79, 0.44),
    (0.76, 0.88, 0.37),
)
# Five Gaussians in the min-max space of (SAM, data_age_days):
# weight, mean, (variance 1, covariance, variance 2).
MIXTURE = (
    (0.30, (0.10, 0.05), (0.020, 0.002, 0.010)),
    (0.25, (0.20, 0.30), (0.030, 0.005, 0.040)),
    (0.20, (0.30, 0.60), (0.025, -0.004, 0.030)),
    (0.15, (0.55, 0.05), (0.050, 0.006, 0.010)),
    (0.10, (0.50, 0.40), (0.040, -0.003, 0.050)),
)

# Names for the numbers of these centres and Gaussians, and headings for a table.
ZONE_LABELS = {0: "south-west", 1: "south-east", 2: "middle", 3: "north-west", 4: "north-east"}
RELIABILITY_LABELS = {
    0: "few samples, new", 1: "some samples, recent", 2: "some samples, old", 3: "many samples, new", 4: "many samples, aged",
}
SHORT_LABELS = {0: "few", 1: "some", 2: "old", 3: "many", 4: "aged"}
HEADINGS = {
    "Country": "country", "Network": "operator", "gmm_cluster": "cluster",
    "gmm_cluster_name": "cluster name", "tower_count": "towers",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def wall_clock_epoch(moment: Column) -> Column:
    """Seconds since 1970 of a timestamp without zone, whatever the session zone is."""
    return (
        F.unix_date(moment.cast("date")).cast("long") * 86400
        + F.hour(moment) * 3600 + F.minute(moment) * 60 + F.second(moment).cast("long")
    )


def towers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw tower table.

    The lines are aggregated before the join on the order key, so the join has
    one row per order on either side; customer and nation are small or not by
    their measured size.
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("o_orderkey"))
        .agg(F.count(F.lit(1)).cast("int").alias("SAM"), F.max("l_shipdate").alias("last_ship"))
    )
    people = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(F.col("c_custkey").alias("o_custkey"), "c_nationkey", "n_name")
    )
    key, buyer, nation = F.col("o_orderkey"), F.col("o_custkey"), F.col("c_nationkey")
    radio = F.coalesce(lookup(F.col("o_orderpriority"), RADIO_OF_PRIORITY), F.lit("CDMA"))
    network = F.concat(F.lit("Operator "), (buyer % 9).cast("string"))
    return (
        table(spark, sf_dir, "orders")
        .join(people, "o_custkey")
        .join(lines, "o_orderkey", "left")
        .select(
            key.cast("long").alias("index"),
            F.when(key % 97 == 0, F.lit("WIFI")).otherwise(radio).alias("radio"),
            (nation + 500).cast("int").alias("MCC"),
            (buyer % 20).cast("int").alias("MNC"),
            (key % 997).cast("int").alias("TAC"),
            (key * 7).cast("long").alias("CID"),
            (buyer % 4).cast("int").alias("unit"),
            (F.lit(90) + (buyer * 37 % 5600) / F.lit(100.0)).cast("float").alias("LON"),
            (F.lit(-12) + (key * 53 % 4100) / F.lit(100.0)).cast("float").alias("LAT"),
            (key * 131 % 9000).cast("int").alias("RANGE"),
            "SAM",
            F.lit(1).alias("changeable"),
            (wall_clock_epoch(F.col("o_orderdate")) + EPOCH_SHIFT).alias("created"),
            (wall_clock_epoch(F.col("last_ship")) + EPOCH_SHIFT).alias("updated"),
            F.lit(0).alias("averageSignal"),
            F.coalesce(
                lookup((nation % 14).cast("int"), COUNTRY_OF_REMAINDER), F.col("n_name")
            ).alias("Country"),
            F.when(buyer % 31 == 0, F.lit("Bad_Net")).otherwise(network).alias("Network"),
            F.lit("Asia").alias("Continent"),
        )
    )
