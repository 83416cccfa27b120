"""Dispatch dictionary: which codes should get a transport unit, learnt from earlier years."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import urgency
from ..operators import aggregates as agg
from ..operators.filters import changed_rows
from ..operators.joins import transfer_by_key
from ..operators.scoring import DICTIONARY_WEIGHTS, suggest

CODES = ("dispatch_code", "code_type", "code_level", "code_rest")


def code_years(incidents: DataFrame, years: tuple[int, int], codes=CODES, year: str = "time_year") -> DataFrame:
    """Per code, over a range of years: transported share, incidents, required (0 or 1), urgency."""
    rows = incidents.where(F.col(year).between(*years))
    return agg.code_summary(rows, codes).withColumn("urgency", urgency("code_type"))


def dispatch_dictionary(
    incidents: DataFrame, train_years=(2013, 2014), test_years=(2015, 2015), weights: dict | None = None, codes=CODES
) -> DataFrame:
    """Test-year codes that also occur in the train years, with the train years' suggestion."""
    train = suggest(code_years(incidents, train_years, codes), "frac_trans", "urgency", weights or DICTIONARY_WEIGHTS)
    test = code_years(incidents, test_years, codes)
    joined = transfer_by_key(train, test, codes[0], "mt_suggested")
    return joined.withColumn("mt_required", F.col("mt_required") > 0).orderBy(F.desc("n_incidents"))


def effects(dictionary: DataFrame) -> dict[str, DataFrame]:
    """Old and new confusion shares, the change in cases, the increase in runs, and the codes that change."""
    old, new, frac, n = "mt_required", "mt_suggested", "frac_trans", "n_incidents"
    return {
        "confusion_old": agg.weighted_confusion(dictionary, old, frac, n),
        "confusion_new": agg.weighted_confusion(dictionary, new, frac, n),
        "confusion_change": agg.confusion_delta(dictionary, old, new, frac, n),
        "increase": agg.increase_ratio(dictionary, old, new, frac, n),
        "required_by_urgency": agg.ratio_of_sums(dictionary, "urgency", F.col(old).cast("int"), n),
        "changes": changed_rows(dictionary, new, old),
    }
