"""Deployment settings: where the tables lie and which slice of the system is used."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields

# Station id prefixes that make up the small scope ("jc"); the large scope is the
# rest, and the scope "all" is both.
SMALL_SCOPE_PREFIXES = ("JC", "HB")


@dataclass(frozen=True)
class Settings:
    data_root: str = "/data"
    scope: str = "jc"
    #: Newest months of raw trips that the backfill reads; 0 for all that are there.
    trip_months: int = 3
    timezone: str = "America/New_York"
    kafka_servers: str = "localhost:9092"
    kafka_auth: str = "none"
    trip_topic: str = "trip_events"
    status_topic: str = "station_status"
    weather_topic: str = "weather"
    #: Folder with `status/` and `weather/`, into which polled documents are put; none if empty.
    landing: str = ""
    #: Database in which jobs register their tables.
    database: str = "chronofeat"

    @classmethod
    def from_env(cls, env: dict[str, str] | None = None) -> Settings:
        """Defaults, overridden by `CHRONOFEAT_<FIELD>` where set and not empty."""
        env = os.environ if env is None else env
        given = {f.name: env.get(f"CHRONOFEAT_{f.name.upper()}") for f in fields(cls)}
        chosen = {name: text for name, text in given.items() if text}
        if "trip_months" in chosen:
            chosen["trip_months"] = int(chosen["trip_months"])
        return cls(**chosen)

    @property
    def region(self) -> str:
        return self.scope

    @property
    def scope_is_prefixed(self) -> bool:
        return self.scope == "jc"

    @property
    def scope_prefixes(self) -> tuple[str, ...]:
        """Prefixes that the scope keeps or leaves out; none for the scope of all stations."""
        return () if self.scope == "all" else SMALL_SCOPE_PREFIXES

    def table(self, *parts: str) -> str:
        return "/".join([self.data_root.rstrip("/"), *parts])
