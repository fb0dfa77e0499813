"""Team catalogs: where a team's domain and SLA tier come from.

A literal map or a rule is a pair of column expressions over the ``team``
column, so the dimension needs no join: the lookup is evaluated inside the
projection. A catalog that users keep as data is a table, and a join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipgauge.config import TEAM_CATALOG
from shipgauge.functions.scalar import lookup


class _Expressions:
    """Catalogs whose lookups are column expressions."""

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` (one ``team`` column among others) with ``domain`` and ``sla_tier``."""
        team = F.col("team")
        return df.select(*[c for c in df.columns if c not in ("domain", "sla_tier")],
                         self.domain(team).alias("domain"), self.sla_tier(team).alias("sla_tier"))


@dataclass(frozen=True)
class MappingCatalog(_Expressions):
    """Explicit team -> (domain, sla_tier) entries; unknown teams get NULL."""

    entries: Mapping[str, tuple[str, str]]

    def domain(self, team: Column) -> Column:
        return lookup(team, {t: d for t, (d, _) in self.entries.items()})

    def sla_tier(self, team: Column) -> Column:
        return lookup(team, {t: s for t, (_, s) in self.entries.items()})


@dataclass(frozen=True)
class NumberedCatalog(_Expressions):
    """Teams named ``<prefix><n>``; team n takes entry ``n mod len(cycle)``.

    Used for generated team names, where listing every team is not possible.
    """

    prefix: str
    cycle: Sequence[tuple[str, str]]

    def _number(self, team: Column) -> Column:
        suffix = F.substr(team, F.lit(len(self.prefix) + 1))
        return F.when(team.startswith(self.prefix), suffix.try_cast("bigint"))

    def _pick(self, team: Column, values: Sequence[str]) -> Column:
        arr = F.array(*[F.lit(v) for v in values])
        idx = F.pmod(self._number(team), F.lit(len(values)))
        return F.try_element_at(arr, (idx + 1).cast("int"))

    def domain(self, team: Column) -> Column:
        return self._pick(team, [d for d, _ in self.cycle])

    def sla_tier(self, team: Column) -> Column:
        return self._pick(team, [s for _, s in self.cycle])


BROADCAST_ROWS = 100_000  # a catalog of so many teams is broadcast, some 10 MB


@dataclass(frozen=True)
class TableCatalog:
    """A table (team, domain, sla_tier) that users edit as data.

    A team without an entry, and the NULL team, get NULLs, as with the literal
    map; an entry for the NULL team is ignored. A team listed more than once
    keeps its least domain and, of that, the least tier, so no row is repeated.
    """

    entries: DataFrame
    broadcast_rows: int = BROADCAST_ROWS

    def attach(self, df: DataFrame) -> DataFrame:
        """``df`` with ``domain`` and ``sla_tier``: the table is broadcast if it is counted to be small, else shuffled."""
        named = F.min(F.struct("domain", "sla_tier")).alias("_entry")
        table = (self.entries.where(F.col("team").isNotNull()).groupBy("team").agg(named)
                 .select("team", F.col("_entry.domain").alias("domain"), F.col("_entry.sla_tier").alias("sla_tier")))
        small = self.entries.limit(self.broadcast_rows + 1).count() <= self.broadcast_rows
        kept = [c for c in df.columns if c not in ("domain", "sla_tier")]
        return df.select(*kept).join(F.broadcast(table) if small else table, "team", "left").select(*kept, "domain", "sla_tier")


DEFAULT_CATALOG = MappingCatalog(TEAM_CATALOG)
# Generated teams ``team-<user_id>`` cycle through the default catalog's entries.
NUMBERED_CATALOG = NumberedCatalog("team-", tuple(TEAM_CATALOG.values()))
