"""Settings from the environment: LOGLOOM_ and the name in capitals."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, fields

PREFIX = "LOGLOOM_"


@dataclass(frozen=True)
class Settings:
    """What the command line takes where an option isn't given."""

    warehouse: str = ""
    window_seconds: int = 60
    train_fraction: float = 0.7
    top_templates: int = 20
    lateness: int = 0
    kafka_servers: str = ""
    kafka_topic: str = "raw-logs"
    kafka_group: str = "windows"
    index: str = ""
    statistics: str = ""
    partitions: int = 6
    idle_timeout: float = 0.0  # 0: none
    max_runtime: float = 0.0

    @classmethod
    def from_env(cls, env: Mapping[str, str] = os.environ) -> Settings:
        """Unset and empty variables leave the default; a value of another type is an error."""
        given = {}
        for f in fields(cls):
            text = env.get(PREFIX + f.name.upper(), "")
            if text:
                try:
                    given[f.name] = type(f.default)(text)
                except ValueError:
                    raise ValueError(f"{PREFIX}{f.name.upper()} can't be {text!r}") from None
        return cls(**given)

    def tables(self) -> str:
        """The folder of the tables, which has no default."""
        if not self.warehouse:
            raise RuntimeError(f"{PREFIX}WAREHOUSE or --warehouse must name the folder of the tables")
        return self.warehouse

    def servers(self) -> str:
        """The Kafka servers, which have no default either."""
        if not self.kafka_servers:
            raise RuntimeError(f"{PREFIX}KAFKA_SERVERS must name the servers")
        return self.kafka_servers
