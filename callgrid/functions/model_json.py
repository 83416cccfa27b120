"""Model registry JSON and lists of (feature, importance)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .base import Col, col

# Keys and types of a registry entry. Mixed lists are read as text and split afterwards.
REGISTRY_FIELDS = {
    "LABEL": "string",
    "MODEL SPEC": "string",
    "MODEL METRICS": "array<array<string>>",
    "MODEL FEATS & IMPS": "array<array<string>>",
    "MODEL TIME": "string",
    "BUCKET NAME": "string",
    "BUCKET CODES": "array<string>",
    "HASH": "string",
    "WEIGHTS": "array<double>",
}
# The order of the numbers stored for each cut.
METRIC_NAMES = ("p", "r", "auc", "wsc")


def parse_model_json(c: Col, fields: dict[str, str] | None = None) -> Column:
    """A registry entry as a struct with lower-case names, blanks as `_` and `&` dropped."""
    fields = fields or REGISTRY_FIELDS
    parsed = F.from_json(col(c), ", ".join(f"`{name}` {kind}" for name, kind in fields.items()))
    return F.struct(*[parsed[n].alias(n.lower().replace(" ", "_").replace("&_", "")) for n in fields])


def feature_importances(pairs: Col) -> Column:
    """`[["f", "0.3"], ...]` to `array<struct<feature, importance>>`."""
    return F.transform(
        col(pairs),
        lambda p: F.struct(p[0].alias("feature"), p[1].cast("double").alias("importance")),
    )


def importance_map(pairs: Col) -> Column:
    return F.map_from_entries(feature_importances(pairs))


def metric_at(metrics: Col, position: int, name: str) -> Column:
    """One number out of `[[k, [precision, recall, auc, score]], ...]`, by position of k and metric name."""
    numbers = F.from_json(col(metrics)[position][1], "array<double>")
    return numbers[METRIC_NAMES.index(name)]


def sort_by_abs(pairs: Col) -> Column:
    """Features by absolute importance, largest first; equal ones by name."""

    def compare(a: Column, b: Column) -> Column:
        x, y = F.abs(a["importance"]), F.abs(b["importance"])
        by_name = F.when(a["feature"] < b["feature"], -1).when(a["feature"] > b["feature"], 1).otherwise(0)
        return F.when(x > y, -1).when(x < y, 1).otherwise(by_name)

    return F.array_sort(col(pairs), compare)


def top_share(arr: Col, pct: float = 10) -> Column:
    """The first pct percent of an array, rounded down."""
    a = col(arr)
    return F.slice(a, 1, F.floor(F.size(a) * pct / 100).cast("int"))
