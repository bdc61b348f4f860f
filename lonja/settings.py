"""Settings of the command line, taken from environment variables."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .rules import ShopRules
from .sources import Database, Lake

# Names of the variables and their defaults.
DEFAULTS = {
    "LAKE_ROOT": "/data/lake",
    "RAW_ROOT": "/data/raw",
    "DB_HOST": "postgres",
    "DB_PORT": "5432",
    "DB_NAME": "shop",
    "DB_USER": "shop",
    "DB_PASSWORD": "",
    "KAFKA_BOOTSTRAP_SERVERS": "kafka:9092",
    "KAFKA_TOPIC": "eventos-web",
    "KAFKA_STARTING_OFFSETS": "latest",
    "KAFKA_FAIL_ON_DATA_LOSS": "",
    "KAFKA_MAX_OFFSETS_PER_TRIGGER": "",
    "API_BASE_URL": "",
    "STREAM_TRIGGER": "10 seconds",
    "STOCK_UMBRAL": "5",
    "TZ": "Europe/Madrid",
}


@dataclass(frozen=True)
class Settings:
    values: Mapping[str, str]

    @classmethod
    def from_environment(cls) -> Settings:
        return cls({name: os.environ.get(name, default) for name, default in DEFAULTS.items()})

    def __getitem__(self, name: str) -> str:
        return self.values[name]

    @property
    def lake(self) -> Lake:
        return Lake(self["LAKE_ROOT"])

    @property
    def rules(self) -> ShopRules:
        return ShopRules(stock_threshold=int(self["STOCK_UMBRAL"]), naive_zone=self["TZ"])

    @property
    def database(self) -> Database:
        url = f"jdbc:postgresql://{self['DB_HOST']}:{self['DB_PORT']}/{self['DB_NAME']}"
        login = {"user": self["DB_USER"], "password": self["DB_PASSWORD"], "driver": "org.postgresql.Driver"}
        return Database(url, login)

    @property
    def topic(self) -> dict[str, str]:
        options = {
            "subscribe": self["KAFKA_TOPIC"],
            "startingOffsets": self["KAFKA_STARTING_OFFSETS"],
            "failOnDataLoss": self["KAFKA_FAIL_ON_DATA_LOSS"],
            "maxOffsetsPerTrigger": self["KAFKA_MAX_OFFSETS_PER_TRIGGER"],
        }
        return {name: value for name, value in options.items() if value}

    def session(self, name: str) -> SparkSession:
        """A session in the shop's time zone. Master, memory and shuffle settings come from spark-submit."""
        return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", self["TZ"]).getOrCreate()
