"""Feature registry: named features with a type and dependencies, applied to an event table."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.base import as_list
from ..sources.scratch import checkpointed

KINDS = ("float", "cat", "bool")


@dataclass(frozen=True)
class FeatureSpec:
    """One feature of a table: its logical type, the columns it needs, and whether it is wanted."""

    name: str
    type: str = "float"
    deps: tuple[str, ...] = ()
    incl: bool = True

    def __post_init__(self):
        if self.type not in KINDS:
            raise ValueError(f"{self.name}: type is one of {KINDS}")


@dataclass
class FeatureSet:
    """Functions by feature name.

    A function takes (frame, context) and returns a Column, or a DataFrame with more columns. New columns must be
    called like the feature or start with its name and an underscore. `context["base"]` is the table as given; features of the
    day find the first and last day of the table there as well.
    """

    functions: dict[str, Callable] = field(default_factory=dict)
    needs: dict[str, tuple[str, ...]] = field(default_factory=dict)
    lookups: set[str] = field(default_factory=set)
    daily: set[str] = field(default_factory=set)
    ts: str = "time_created"

    def feature(self, name: str, needs=(), lookup: bool = False, daily: bool = False):
        """Register a function; `needs` names features that must come first.

        `lookup` marks a function that only joins small tables to the frame it is given, `daily` one whose result depends on
        the day of `ts` alone: it is given a frame with one row per day.
        """

        def register(f):
            self.functions[name] = f
            self.needs[name] = tuple(as_list(needs))
            for mark, names in ((lookup, self.lookups), (daily, self.daily)):
                if mark:
                    names.add(name)
            return f

        return register

    def order(self, names) -> list[str]:
        """Names sorted so that each comes after those it needs."""
        done: list[str] = []

        def add(name: str, trail=()):
            if name in done:
                return
            if name in trail:
                raise ValueError(f"features need each other: {' -> '.join((*trail, name))}")
            for needed in self.needs.get(name, ()):
                add(needed, (*trail, name))
            done.append(name)

        for name in sorted(names):
            add(name)
        return done

    def apply(self, df: DataFrame, specs: list[FeatureSpec], pk, context: dict | None = None, store: bool = False) -> DataFrame:
        """The key and all wanted features. A feature without a function is copied from the table.

        Features of the day are computed together on the days of the table, which are few, and joined once. Other columns
        and lookups are added one after the other. Every feature that reads its frame more than once is computed by itself,
        from the table (or, if it needs other features, from the table with those), and joined by the key at the end.
        So the table is read once for its days, once for the rows and once for each such feature; with `store` it is written
        first, for a table that is dear to compute.
        """
        base, keys = checkpointed(df) if store else df, as_list(pk)
        context = {"base": base, **(context or {})}
        wanted = [s.name for s in specs if s.incl]
        names = self.order(wanted)
        added, produced = base, {}
        daily = [n for n in names if n in self.daily]
        if daily:
            days, produced = self._of_days(base, daily, context)
            clash = [c for c in days.columns if c in base.columns]
            same = F.to_date(F.col(self.ts)).eqNullSafe(F.col("__of_day"))
            added = base.drop(*clash).join(days, same, "left").drop("__of_day")
        added, others = self._added(added, base, [n for n in names if n not in self.daily], keys, context)
        produced |= others
        keep = [c for name in sorted(wanted) for c in produced[name]]
        return added.select(*keys, *[c for c in dict.fromkeys(keep) if c not in keys])

    def _of_days(self, base: DataFrame, names: list[str], context: dict) -> tuple[DataFrame, dict[str, list[str]]]:
        """(a stored table of the days of `base` with the features, columns by feature)."""
        days = checkpointed(base.select(F.to_date(self.ts).alias("__of_day")).distinct())
        first, last = days.agg(F.min("__of_day"), F.max("__of_day")).first()
        frame = days.withColumn(self.ts, F.col("__of_day").cast(base.schema[self.ts].dataType))
        context = {**context, "base": frame, "first_day": first, "last_day": last}
        alone = [n for n in names if not self.needs[n]]
        added, produced = self._added(frame, frame, alone, ["__of_day"], context)
        if len(alone) < len(names):
            added = checkpointed(added)
            added, others = self._added(added, frame, [n for n in names if n not in alone], ["__of_day"], context)
            produced |= others
        new = list(dict.fromkeys(c for columns in produced.values() for c in columns))
        return checkpointed(added.select("__of_day", *new)), produced

    def _added(self, added: DataFrame, base: DataFrame, names: list[str], keys: list[str], context: dict) -> tuple[DataFrame, dict[str, list[str]]]:
        """(`added` with the features `names`, columns by feature)."""
        produced: dict[str, list[str]] = {}
        later = []
        for name in names:
            f = self.functions.get(name)
            if f is None:
                produced[name] = [name]
                continue
            if name not in self.lookups:
                # what a function returns is only known by calling it; a Column does not depend on the frame
                start = added if self.needs[name] else base
                got = f(start, context)
                if isinstance(got, DataFrame):
                    new = self._columns(name, got, start)
                    later.append(got.select(*keys, *new))
                    produced[name] = new
                    continue
                added = added.withColumn(name, got)
                produced[name] = [name]
            else:
                got = f(added, context)
                produced[name] = self._columns(name, got, added)
                added = got
        for got in later:
            clash = [c for c in got.columns if c in added.columns and c not in keys]
            same = F.lit(True)
            for k in keys:
                same = same & added[k].eqNullSafe(F.col(f"__key_{k}"))
            renamed = got.withColumnsRenamed({k: f"__key_{k}" for k in keys})
            added = added.drop(*clash).join(renamed, same, "left").drop(*[f"__key_{k}" for k in keys])
        return added, produced

    @staticmethod
    def _columns(name: str, got: DataFrame, before: DataFrame) -> list[str]:
        known = set(before.columns)
        return [c for c in got.columns if c == name or (c not in known and c.startswith(name + "_"))]


def load_specs(source: str | list[dict]) -> tuple[list[FeatureSpec], list[str]]:
    """(features, key columns) from a list of dicts, or a JSON or YAML file with `features` and `pk`."""
    pk: list[str] = []
    if isinstance(source, str):
        with open(source) as f:
            if source.endswith(".json"):
                content = json.load(f)
            else:
                import yaml

                content = yaml.safe_load(f)
        entries, pk = content["features"], as_list(content.get("pk"))
    else:
        entries = source
    specs = [
        FeatureSpec(e["name"], e.get("type", "float"), tuple(as_list(e.get("deps"))), bool(e.get("incl", True)))
        for e in entries
    ]
    return specs, pk


def column_types(columns: DataFrame, specs: list[FeatureSpec]) -> DataFrame:
    """(name, type) for a table with a `name` per feature column; columns a feature spreads into take its type."""
    kind = F.lit("float")
    for s in sorted(specs, key=lambda s: len(s.name)):  # the longest that fits is looked at first
        kind = F.when((F.col("name") == s.name) | F.col("name").startswith(s.name + "_"), F.lit(s.type)).otherwise(kind)
    return columns.select("name", kind.alias("type"))


def type_table(spark, specs: list[FeatureSpec], columns: list[str]) -> DataFrame:
    """`column_types` of the columns of a frame."""
    return column_types(spark.createDataFrame([(c,) for c in columns], "name string"), specs)


def categorical(types: DataFrame) -> list[str]:
    return [r["name"] for r in types.where(F.col("type") == "cat").orderBy("name").collect()]
