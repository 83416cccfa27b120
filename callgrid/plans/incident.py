"""One row per incident, from dispatch, unit, report, patient-care and area tables.

Every satellite is reduced to one row per event first, so it is partitioned by event and the joins that follow need
no further shuffle of it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.calendar import date_parts
from ..functions.geometry import lcc_to_lonlat
from ..functions.text import split_code, strip_leading_zero
from ..operators import filters, joins
from ..operators.aggregates import concat_text, first_per_key, max_per_key
from ..operators.spatial import first_of_layers
from ..sources.scratch import checkpointed

# Column names of the input tables.
EVENT = "i_eventnumber"
INCIDENT_COLUMNS = {
    "i_ttimecreate": "time_created",
    "i_ttimeclosed": "time_closed",
    "i_kcallsource": "call_source",
    "i_callerphonetype": "call_type",
}
REPORT_COLUMNS = {
    "poc_operatorname": "operator_name",
    "ico_comment": "dispatch_comment",
    "iti_typeid": "dispatch_code",
    "iti_typetext": "dispatch_text",
}
PATIENT_COLUMNS = {"GENDERCODE": "pt_gender", "AGE": "pt_age", "RACECODE": "pt_race", "POSTCODE": "pt_postcode"}
# Text in the dispatch comment and the agency it names.
AGENCY_NEEDLES = [("CP/", "CP"), ("CF/", "CF")]


def distinct_events(incidents: DataFrame, dispositions: DataFrame, start: str, places=("x", "y")) -> DataFrame:
    """Events from `start` on, with the transport flag of their disposition."""
    flagged = filters.flag_by_code_text(dispositions, "idi_dispositioncode", "idi_dispositiontext", "trns_to_hosp")
    flagged = flagged.select(F.col("idi_disposition_pk").alias("__disposition"), "trns_to_hosp")
    place = [c for c in places if c in incidents.columns]
    recent = filters.since(incidents, "i_ttimecreate", start).select(
        F.col(EVENT).alias("incident"),
        *[F.col(c).alias(name) for c, name in INCIDENT_COLUMNS.items()],
        *place,
        "i_kdisposition1",
    )
    joined = recent.join(flagged, F.col("i_kdisposition1") == F.col("__disposition"), "left")
    return filters.default_false(joined, "trns_to_hosp").drop("i_kdisposition1", "__disposition").distinct()


def with_lonlat(incidents: DataFrame, x: str = "i_mapx", y: str = "i_mapy") -> DataFrame:
    """Plane coordinates to longitude x and latitude y."""
    at = lcc_to_lonlat(F.col(x).cast("double"), F.col(y).cast("double"))
    return incidents.withColumn("__at", at).withColumn("x", F.col("__at.x")).withColumn("y", F.col("__at.y")).drop("__at")


def reports_per_event(reports: DataFrame) -> DataFrame:
    """The first report of each event (by code, text, comment, operator), with its code split up."""
    named = reports.select(F.col(EVENT).alias("incident"), *[F.col(c).alias(n) for c, n in REPORT_COLUMNS.items()])
    first = first_per_key(named, "incident", ["dispatch_code", "dispatch_text", "dispatch_comment", "operator_name"])
    first = first.withColumn("dispatch_code", strip_leading_zero("dispatch_code"))
    split = first.withColumn("__code", split_code("dispatch_code")).select("*", "__code.*").drop("__code")
    return filters.categorize_text(split, "dispatch_comment", AGENCY_NEEDLES, "NA", "operator_agency")


def patient_care(events: DataFrame, care: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(comments, patient details), one row per event each, from t_incident, t_case, t_comment and t_patient.

    The way from events to cases is the same for both: it is taken once, and written with the few columns of the patients.
    """
    link = care["t_incident"].select(F.col("INCIDENTN").alias("incident"), F.col("KEY_INCIDENT").alias("__inc"))
    cases = care["t_case"].select(F.col("KEY_INCIDENT").alias("__inc"), "KEY_CASE", F.col("KEY_PATIENT").alias("__patient"))
    names = list(PATIENT_COLUMNS.values())
    patients = care["t_patient"].select(F.col("KEY_PATIENT").alias("__patient"), *[F.col(c).alias(n) for c, n in PATIENT_COLUMNS.items()])
    patients = max_per_key(patients, "__patient", names).withColumn("__known", F.lit(True))
    of_events = link.join(events.select("incident"), "incident", "left_semi").join(cases, "__inc").join(patients, "__patient", "left")
    of_events = checkpointed(of_events.select("incident", "KEY_CASE", "__known", *names))
    comments = of_events.select("incident", "KEY_CASE").join(care["t_comment"].select("KEY_CASE", "COMMENTTEXT"), "KEY_CASE")
    return (
        concat_text(comments, "incident", "COMMENTTEXT", ["COMMENTTEXT"]),
        max_per_key(of_events.where("__known"), "incident", names),
    )


def incident_table(
    incidents: DataFrame,
    dispositions: DataFrame,
    units: DataFrame,
    reports: DataFrame,
    dictionary: DataFrame,
    care: dict[str, DataFrame] | None = None,
    stations: DataFrame | None = None,
    block_groups: DataFrame | None = None,
    start: str = "2011-01-01",
    cell: float | None = None,
) -> DataFrame:
    """The incident table. `stations` is (station_name, ring), `block_groups` (geoid, ring), in the units of x and y.

    Where areas of a layer overlap, an incident has the one that is first by name. `cell` is the cell size of the two spatial
    joins; without it, each area has cells of its own size.
    """
    events = distinct_events(incidents, dispositions, start)
    recent = filters.since(incidents, "i_ttimecreate", start).withColumnRenamed(EVENT, "incident")
    layers = {n: layer.select(n, "ring") for n, layer in (("geoid", block_groups), ("station_name", stations)) if layer is not None}
    if layers:
        # an event has one place, so this join needs no other partitioning than those by event that follow
        places = first_of_layers(recent, list(layers.values()), "x", "y", "ring", "incident", cell)
        places = places.withColumnsRenamed({"incident": "__event", "x": "__x", "y": "__y"})
        same = (F.col("incident") == F.col("__event")) & (F.col("x") == F.col("__x")) & (F.col("y") == F.col("__y"))
        events = events.join(places, same, "left").drop("__event", "__x", "__y")
    events = events.withColumns({n: F.lit(None).cast("string") for n in ("geoid", "station_name") if n not in layers})
    sent = (
        filters.filter_like_any(units, "pun_unitid")
        .select(F.col(EVENT).alias("incident"))
        .distinct()
        .withColumn("m_sent", F.lit(True))
    )
    report = filters.exclude_codes(reports_per_event(reports), "dispatch_code")
    codes = dictionary.select(
        F.col("code").alias("__code"),
        F.col("incident_type").alias("dispatch_type"),
        F.coalesce(F.col("compliment").contains("MT"), F.lit(False)).alias("m_required"),
    )
    out = events.join(report, "incident").join(sent, "incident", "left")
    out = out.join(codes, F.col("dispatch_code") == F.col("__code"), "left").drop("__code")
    if care:
        for satellite in patient_care(recent, care):
            out = out.join(satellite, "incident", "left")
    else:
        out = out.withColumns({c: F.lit(None).cast("string") for c in ("comments", *PATIENT_COLUMNS.values())})
    out = filters.default_false(out, ["m_sent", "m_required"])
    return out.select(
        "incident",
        "time_created",
        "time_closed",
        *date_parts("time_created"),
        "call_source",
        "call_type",
        "operator_name",
        "dispatch_comment",
        "dispatch_code",
        "dispatch_text",
        "dispatch_type",
        "code_type",
        "code_level",
        "code_rest",
        *[c for c in ("x", "y") if c in out.columns],
        "geoid",
        "station_name",
        "comments",
        "trns_to_hosp",
        *PATIENT_COLUMNS.values(),
        "operator_agency",
        "m_sent",
        "m_required",
    )
