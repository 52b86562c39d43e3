"""The engine's operators run over the given tables: inputs shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)
EVENT_TYPES = ("signup", "purchase", "view", "click", "error")
BRANDS = (
    ("north tv", "OLD"),
    ("North TV", "NT"),
    ("North TV - Resellers", "NTR"),
    ("Arts Plus West", "APW"),
)
REFERENCE_DATE = "20240130"

# One rule of each row-local kind, one with a column that is not there, one over nothing else.
RULES = {
    "Events": {
        "valid_types": {
            "column": "kind",
            "allowed_values": ["signup", "purchase", "view", "click"],
            "error_type": "invalid_kinds",
        },
        "required_fields": {
            "columns": ["kind", "start_date", "user_login"],
            "error_type": "missing_fields",
        },
        "date_validation": {"columns": ["start_date"], "error_type": "invalid_dates"},
        "duration_validation": {
            "columns": ["ex_pause", "asset_duration"],
            "error_type": "invalid_duration",
        },
        "duration_consistency": {
            "condition": "asset_duration >= ex_pause",
            "error_type": "inconsistent_duration",
        },
        "kind_existence": {"column": "kind", "not_empty": True, "error_type": "missing_kind"},
        "device_presence": {
            "condition": "device_type IS NOT NULL",
            "error_type": "missing_device",
        },
    },
    "UniqueEvents": {
        "valid_types": {
            "column": "kind",
            "allowed_values": ["signup", "purchase", "view", "click"],
            "error_type": "invalid_kinds",
        },
        "uniqueness": {"columns": ["user_id"], "error_type": "duplicate_users"},
    },
}


_SCHEMAS: dict[str, T.StructType] = {}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table. Its schema is read from the file once, as a catalog would keep it."""
    path = f"{sf_dir}/{table}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with brands in several spellings and NULL, empty and invalid values."""
    event_id, user_id = F.col("event_id"), F.col("user_id")
    day = F.col("ts").cast("date").cast("string")

    def every(n: int):
        return event_id % n == 0

    brand = (
        F.when(user_id % 5 == 0, "North TV")
        .when(user_id % 5 == 1, "North TV - Resellers")
        .when(user_id % 5 == 2, "Arts+ West")
        .when(user_id % 5 == 3, "arts  plus  WEST")
        .otherwise("Unmapped Co")
    )
    kind = F.when(every(11), None).when(every(13), "").otherwise(F.col("event_type"))
    ex_pause = F.when(every(17), None).otherwise(F.floor("value").cast("bigint"))
    duration = F.when(every(19), 0).when(every(29), None).otherwise(user_id)
    start = F.when(every(23), "not-a-date").when(every(31), None).otherwise(day)
    user_ref = F.when(every(37), "abc").otherwise(user_id.cast("string"))
    return load(spark, sf_dir, "events").select(
        event_id,
        user_id,
        F.col("event_type").alias("table_name"),
        brand.alias("brand"),
        kind.alias("kind"),
        ex_pause.alias("ex_pause"),
        duration.alias("asset_duration"),
        start.alias("start_date"),
        user_ref.alias("user_ref"),
        F.replace(day, F.lit("-"), F.lit("")).alias("filedate"),
    )


DELIMITERS = {"signup": ",", "purchase": ";", "view": "\t", "click": "|", "error": ":"}


def noted_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event with a text that may hold a delimiter, a line end or quotes."""
    event_id = F.col("event_id")
    mark = F.coalesce(*[F.when(F.col("event_type") == kind, sep) for kind, sep in DELIMITERS.items()])
    note = (
        F.when(event_id % 7 == 0, F.concat(F.lit("a"), mark, F.lit("b")))
        .when(event_id % 11 == 0, F.lit("two\nlines"))
        .when(event_id % 13 == 0, F.lit('a "word" in quotes'))
        .otherwise(F.concat(F.lit("n"), event_id.cast("string")))
    )
    day = F.replace(F.col("ts").cast("date").cast("string"), F.lit("-"), F.lit(""))
    return load(spark, sf_dir, "events").select(
        event_id, "user_id", "event_type", note.alias("note"), day.alias("filedate")
    )


def deliver(df: DataFrame, landing: str, table: str, date: str, **options: object) -> list[str]:
    """The frame as CSV files in a landing folder, one a task, named as deliveries are. A file
    of the same name is replaced."""
    spark = df.sparkSession
    parts = f"{landing}-{table}-parts"
    df.write.mode("overwrite").options(header=True, escape='"', **options).csv(parts)
    paths = spark._jvm.org.apache.hadoop.fs.Path
    files = paths(parts).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(paths(landing))
    names = []
    for status in files.listStatus(paths(parts)):
        if status.getPath().getName().startswith("part-"):
            names.append(f"Brand {len(names)}_{table}_{date}.csv")
            place = paths(f"{landing}/{names[-1]}")
            files.delete(place, False)
            files.rename(status.getPath(), place)
    return names


def deliver_headers(spark: SparkSession, landing: str, names: list[str], header: str) -> None:
    """Files of these names that hold a header and no row."""
    paths = spark._jvm.org.apache.hadoop.fs.Path
    for name in names:
        place = paths(f"{landing}/{name}")
        out = place.getFileSystem(spark._jsc.hadoopConfiguration()).create(place, True)
        out.writeBytes(header + "\n")
        out.close()


def event_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event read as a ledger entry for its type on its day."""
    day = F.replace(F.col("ts").cast("date").cast("string"), F.lit("-"), F.lit(""))
    return load(spark, sf_dir, "events").select(
        day.alias("filedate"),
        F.col("event_type").alias("table_name"),
        F.when(F.col("event_id") % 10 == 0, "failed").otherwise("success").alias("status"),
        F.col("event_id").alias("processed_at"),
    )


def event_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each event read as a delivered file: one 'brand' per user, the event type as table."""
    day = F.replace(F.col("ts").cast("date").cast("string"), F.lit("-"), F.lit(""))
    return load(spark, sf_dir, "events").select(
        F.concat(F.lit("User "), F.col("user_id").cast("string")).alias("brand"),
        day.alias("filedate"),
        F.col("event_type").alias("table_name"),
    )
