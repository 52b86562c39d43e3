"""Fixed values, settings and the readers of the three JSON configuration files."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

# Names and keys that the configured tables of existing users rely on.
EXPECTED_TABLES = (
    "Device",
    "EPG",
    "Playback",
    "User",
    "Smartcard",
    "VODCatalog",
    "VODCatalogExtended",
)
DEDUP_KEYS = {
    "User": ["UserId"],
    "Device": ["UserId", "Serial"],
    "Smartcard": ["SmartcardId"],
    "Playback": ["PlaySessionID"],
    "EPG": ["broadcast_datetime", "station_id"],
    "VODCatalog": ["external_id"],
    "VODCatalogExtended": ["external_id"],
}
TARGET_NAMES = {
    "VODCatalog": "AGG_VOD_CATALOG",
    "VODCatalogExtended": "AGG_VOD_CATALOG_EXTENDED",
}
# '' becomes NULL in these columns whatever the policy for other strings.
EMPTY_AS_NULL_DATES = ("license_start", "license_end", "series_last_episode_date")
# Columns cast to string whatever their declared type.
STRING_COLUMNS = {"VODCatalog": ("series_last_episode_date",)}
DURATION_COLUMNS = ("PlayDurationExPause", "AssetDuration")


@dataclass(frozen=True)
class Settings:
    expected_tables: tuple[str, ...] = EXPECTED_TABLES
    lookback_days: int = 3
    gold_retention_days: int = 30
    raw_retention_days: int = 0
    error_threshold: float = 5.0
    warning_threshold: float = 10.0
    loaded_by: str = "LAYERWISE"
    # encoding of landing files that are not UTF-8; without one they are rejected
    fallback_encoding: str | None = None
    dedup_keys: dict[str, list[str]] = field(default_factory=lambda: dict(DEDUP_KEYS))
    target_names: dict[str, str] = field(default_factory=lambda: dict(TARGET_NAMES))

    def keys_of(self, table: str) -> list[str]:
        return self.dedup_keys.get(table, [])

    def target_of(self, table: str) -> str:
        return self.target_names.get(table, f"AGG_{table.upper()}")


def read_config(spark: SparkSession, path: str) -> dict:
    """One JSON document from any file system Spark can read; a missing file is empty."""
    try:
        rows = spark.read.text(path, wholetext=True).limit(2).collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return {}
        raise
    if len(rows) > 1:
        raise ValueError(f"{path} holds more than one document")
    return json.loads(rows[0].value) if rows else {}


def brands_from(config: dict) -> list[tuple[str, str]]:
    """(file name, brand code) pairs in file order."""
    return [(b.get("file_name", ""), b.get("brand_code", "")) for b in config.get("brands", [])]


def columns_from(config: dict, table: str) -> dict[str, str]:
    """Declared column types of a table, ``{}`` when it is not declared."""
    return config.get(table, {}).get("columns", {})
