"""User records, messages and IP ranges derived from the star-schema tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystream.functions.times import ntz_to_instant
from tallystream.operators import messages as msg
from tallystream.schema import ENVELOPE, FIELDS, GEO_FIELDS


# The columns used, declared: no footer is read to infer them.
TABLES = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string",
    "customer": "c_custkey bigint, c_nationkey int",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One user record per event.

    No broadcast hints: customers grow with the data, so Spark goes by their
    size, and in a shuffled join adaptive execution splits the partition of a
    busy user.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    customer = table(spark, sf_dir, "customer")
    homed = (
        table(spark, sf_dir, "events")
        .join(customer, F.col("user_id") == F.col("c_custkey"), "left")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    )
    user, event = F.col("user_id"), F.col("event_id")
    gender = F.when(user % 10 == 9, None).when(user % 2 == 0, "Male").otherwise("Female")
    address = F.concat_ws(".", 10 + user % 100, event % 256, user % 256, event % 7)
    return homed.select(
        "event_id",
        "ts",
        "event_type",
        F.concat(F.lit("user"), user.cast("string"), F.lit("@example.com")).alias("email"),
        gender.alias("gender"),
        F.col("n_name").alias("country"),
        address.alias("ip_address"),
    )


def _as_messages(records: DataFrame, value: Column | None = None) -> DataFrame:
    """Binary key and value and an arrival time, as a topic gives them."""
    made = msg.encode(records, FIELDS, key="event_id")
    return made.select(
        F.col("key").cast("binary").alias("key"),
        (F.col("value") if value is None else value).cast("binary").alias("value"),
        F.col("ts").alias("timestamp"),
    )


def topic_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_messages(user_records(spark, sf_dir))


def flawed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error events are cut off in the middle, signups name the country otherwise."""
    kind = F.col("event_type")
    value = (
        F.when(kind == "error", F.substring_index("value", '"country"', 1))
        .when(kind == "signup", F.replace("value", F.lit('"country"'), F.lit('"nation"')))
        .otherwise(F.col("value"))
    )
    return _as_messages(user_records(spark, sf_dir), value)


def mixed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country by turns as a number, as that number in quotes, true, null, an array and not at all."""
    number = (F.col("event_id") % 7).cast("string")
    turn = (F.col("event_id") % 6).cast("int")
    forms = F.array(
        number, F.concat(F.lit('"'), number, F.lit('"')), F.lit("true"), F.lit("null"), F.concat(F.lit("["), number, F.lit("]"))
    )
    country = F.get(forms, turn)
    rest = F.substring_index("value", '"country"', 1)
    address = F.concat(F.lit('"ip_address"'), F.substring_index("value", '"ip_address"', -1))
    value = F.concat(rest, F.when(turn < 5, F.concat(F.lit('"country":'), country, F.lit(","))).otherwise(""), address)
    records = user_records(spark, sf_dir)
    made = msg.encode(records, FIELDS, key="event_type").withColumn("value", value)
    return made.select("key", "value", F.col("ts").alias("timestamp"))


def decoded_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted messages with their fields, from JSON text."""
    return msg.accepted(msg.decode(msg.to_envelope(topic_messages(spark, sf_dir))))


def dual_stack_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every other address IPv6, in three forms: shortened, in full, and an IPv4 address inside IPv6."""
    event = F.col("event_id")
    records = user_records(spark, sf_dir)
    number = F.regexp_extract("email", "[0-9]+", 0).cast("bigint")
    group = F.hex(number % 40 * 256 + event % 16)
    last = F.hex(event % 65536)
    six = (
        F.when(event % 6 == 1, F.lower(F.concat(F.lit("2001:db8:"), group, F.lit("::"), last)))
        .when(event % 6 == 3, F.concat(F.lit("2001:0DB8:"), F.lpad(group, 4, "0"), F.lit(":0000:0000:0000:0000:"), F.lpad(last, 4, "0")))
        .otherwise(F.concat(F.lit("::ffff:"), F.col("ip_address")))
    )
    address = F.when(event % 2 == 0, F.col("ip_address")).otherwise(six)
    return _as_messages(records.withColumn("ip_address", address))


UNMAPPED_REGION = 4


def _places(spark: SparkSession, sf_dir: str, city: str = "City ") -> DataFrame:
    """``n_nationkey, geo`` of the nations of all regions but one."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    key = F.col("n_nationkey")
    number = key.cast("string")
    place = {
        "hostname": F.concat(F.lit("gw"), number, F.lit(".example.net")),
        "city": F.concat(F.lit(city), number),
        "region": F.col("r_name"),
        "country": F.col("n_name"),
        "loc": F.concat(number, F.lit(".5,-"), number, F.lit(".25")),
        "postal": (10000 + key).cast("string"),
        "timezone": F.concat(F.lit("Zone/"), F.col("r_name")),
    }
    geo = F.struct(*(place[f].alias(f) for f in GEO_FIELDS))
    return (
        nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .where(F.col("r_regionkey") != UNMAPPED_REGION)
        .select(key, geo.alias("geo"))
    )


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A block of four /8 networks per nation; the nations of one region have none."""
    first = (10 + 4 * F.col("n_nationkey")).cast("bigint") * (1 << 24)
    return _places(spark, sf_dir).select(first.alias("lo"), (first + 4 * (1 << 24) - 1).alias("hi"), "geo")


def ip_networks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Networks of both families per nation, and a smaller one with a place of its own in each."""
    key = F.col("n_nationkey")
    two = lambda n: F.lpad(F.hex(n), 2, "0")
    wide = [F.concat((10 + 4 * key + k).cast("string"), F.lit(".0.0.0/8")) for k in range(4)]
    wide.append(F.concat(F.lit("2001:db8:"), two(key), F.lit("00::/40")))
    near = [
        F.concat((10 + 4 * key).cast("string"), F.lit("."), key.cast("string"), F.lit(".0.0/16")),
        F.concat(F.lit("2001:db8:"), two(key), two(key % 16), F.lit("::/48")),
    ]
    large = _places(spark, sf_dir).select(F.explode(F.array(*wide)).alias("network"), "geo")
    return large.unionByName(_places(spark, sf_dir, "Near ").select(F.explode(F.array(*near)).alias("network"), "geo"))


def write_topic_files(messages: DataFrame, path: str) -> None:
    """Messages as files that a file stream reads in place of a topic."""
    envelope = msg.to_envelope(messages).withColumn("timestamp", ntz_to_instant(F.col("timestamp")))
    envelope.select(*ENVELOPE.fieldNames()).write.mode("error").parquet(path)


def closing_message(spark: SparkSession, sf_dir: str, days: int = 2) -> DataFrame:
    """A message some days after the last event, which moves a watermark past all windows."""
    last = table(spark, sf_dir, "events").agg(F.max("ts").alias("ts")).where("ts IS NOT NULL")
    nothing = F.to_json(F.struct(*(F.lit(None).cast("string").alias(f) for f in FIELDS)), {"ignoreNullFields": "false"})
    return last.select(
        F.lit("closing").cast("binary").alias("key"),
        nothing.cast("binary").alias("value"),
        (F.col("ts") + F.make_dt_interval(days=F.lit(days))).alias("timestamp"),
    )
