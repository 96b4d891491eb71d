"""Connector configuration: which database a registry ``connector`` names.

The original looked credentials up per entry as ``'db_' + connector`` and
reused the previous driver for an unknown kind. Here connectors are an
explicit mapping; an unknown connector or kind is an error.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# JDBC driver class per database kind. ``deltalake`` (any table
# in the Spark catalog) needs no driver: it is read through Spark itself.
DRIVERS = {
    "postgresql": "org.postgresql.Driver",
    "redshift": "com.amazon.redshift.jdbc42.Driver",
    "snowflake": "net.snowflake.client.jdbc.SnowflakeDriver",
    "derby": "org.apache.derby.iapi.jdbc.AutoloadedDriver",
    "deltalake": None,
}


@dataclass(frozen=True)
class Connector:
    name: str  # as written before ':' in registry names, lower case
    kind: str  # key of DRIVERS
    url: str | None = None
    user: str | None = None
    password: str | None = None
    identifier_case: str = "lower"  # how detection folds catalog/schema/table
    options: Mapping[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if self.kind not in DRIVERS:
            raise ValueError(f"connector {self.name!r}: unknown kind {self.kind!r}; expected one of {sorted(DRIVERS)}")
        if self.identifier_case not in ("upper", "lower", "exact"):
            raise ValueError(f"connector {self.name!r}: identifier_case must be upper, lower or exact")

    @property
    def is_jdbc(self) -> bool:
        return DRIVERS[self.kind] is not None

    def jdbc_options(self) -> dict[str, str]:
        if not self.is_jdbc:
            raise ValueError(f"connector {self.name!r} ({self.kind}) is not a JDBC source")
        opts = {"url": self.url, "driver": DRIVERS[self.kind]}
        if self.user is not None:
            opts["user"] = self.user
        if self.password is not None:
            opts["password"] = self.password
        opts.update(self.options)
        return {k: v for k, v in opts.items() if v is not None}


def lookup(connectors: Mapping[str, Connector], name: str) -> Connector:
    try:
        return connectors[name.lower()]
    except KeyError:
        raise KeyError(f"no connector configured for {name!r}") from None


def case_rules(connectors: Mapping[str, Connector]) -> dict[str, str]:
    """Per-connector identifier case, for :func:`driftlens.operators.snapshot.snapshot`."""
    return {c.name: c.identifier_case for c in connectors.values()}
