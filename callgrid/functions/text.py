"""Text and code expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from .base import Col, as_list, col

# Dispatch code numbers and their short labels.
CODE_LABELS = {
    0: "CASE", 1: "ABDOMINAL", 2: "ALLERGIES", 3: "ANIMAL", 4: "ASSAULT", 5: "BACK", 6: "BREATHING", 7: "BURNS",
    8: "CO", 9: "CARDIAC", 10: "CHEST", 11: "CHOCKING", 12: "CONVULSIONS", 13: "DIABETIC", 14: "DROWNING",
    15: "ELECTROCUTION", 16: "EYE", 17: "FALLS", 18: "HEADACHE", 19: "HEART", 20: "HEAT", 21: "HEMORRHAGE",
    22: "INACCESSIBLE", 23: "OVERDOSE", 24: "PREGNANCY", 25: "PSYCHIATRIC", 26: "SICK", 27: "PENETRATION",
    28: "STROKE", 29: "TRAFFIC", 30: "TRAUMATIC", 31: "UNCONSCIOUS", 32: "UNKNOWN", 33: "TRANSFER",
}

# The longer label set used by the base probability tables.
CODE_LABELS_LONG = {
    1: "ABDOMINAL PAIN", 2: "ALLERGIES", 3: "ANIMAL BITES", 4: "ASSAULT", 5: "BACK PAIN", 6: "BREATHING", 7: "BURNS",
    8: "CARBON MONOXIDE", 9: "CARIAC/RESP ARREST", 10: "CHEST PAIN", 11: "CHOKING", 12: "CONVULSIONS/SEIZURES",
    13: "DIABETIC PROBS", 14: "DROWNING", 15: "ELECTROCUTION", 16: "EYE PROBS", 17: "FALLS", 18: "HEADACHE",
    19: "HEART PROBLEMS", 20: "HEAT/COLD EXPOSURE", 21: "HEMORRHAGE/LACERATIONS", 22: "ENTRAPMENT",
    23: "OVERDOSE/POISONING", 24: "PREGNANCY", 25: "PHYCHIATRIC/SUICIDE ATTEMPT", 26: "SICK PERSON",
    27: "STAB/GUNSHOT WOUND", 28: "STROKE", 29: "TRAFIC/TRANPORTATION INC", 30: "TRAUMATIC INJURIES",
    31: "UNCONSCIOUS/FAINTING", 32: "UNKNOWN",
}

# Text codes that stand for a numeric code.
CODE_SYNONYMS = {"SUICF": "25", "DROWNF": "14", "ACCIF": "29"}

# Urgency bucket of each dispatch code; any other code is "other".
URGENCY_BUCKETS = {
    "high": "9 19 28 10 27 14 STRUCT SHOOTF SWAT BOMB FHELPF 30 22".split(),
    "medium": (
        "12 31 13 6 8 23 15 7 24 25 TRAP TRAPF COLAPS WATERR SIG500 CUTF PDOAF HERONF HEROIF COSICK DROWNF"
    ).split(),
    "low": (
        "11 2 21 3 18 16 1 20 17 26 4 29 PERDWF GAS2 AIRF CHEMF POSTAF MUTUAL ACCIF ASSLTF OUTDR FUMES SALV SUICF "
        "WIRES VEH LOCK WALKIN CALARM STUCK INVEST HYDR BLDGF ROBBIF TASER GAS1 DOMNF FRO OUTLET FTRACC PHELPF TRK "
        "RIVERF RAPEF CHEMI BIOHZF INACTF HIRISK DOMINF MENTIF BOATF EMS FALARM 32 5"
    ).split(),
}

# Estimator names and default arguments shortened in reports.
MODEL_NAME_REPLACEMENTS = [
    ("RandomForestClassifier", "RF"),
    ("LogisticRegression", "LR"),
    ("KNeighborsClassifier", "KNN"),
    ("ExtraTreesClassifier", "ET"),
    ("bootstrap=False, ", ""),
    ("class_weight=None, ", ""),
]


def _literal_map(mapping: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])


def lookup(c: Col, mapping: dict) -> Column:
    """Value of `c` in a small fixed mapping, NULL when absent."""
    return F.try_element_at(_literal_map(mapping), col(c))


def split_code(c: Col) -> Column:
    """`6D1` -> (code_type '6', code_level 'D', code_rest '1').

    The type is written without leading zeros. A code that does not start with digits and capitals
    is its own type and has no level or rest.
    """
    code = col(c)
    pattern = r"^(\d+)([A-Z]+)(.*)"
    matched = code.rlike(pattern)
    digits = F.regexp_replace(F.regexp_extract(code, pattern, 1), r"^0+(?=\d)", "")
    return F.struct(
        F.when(matched, digits).otherwise(code).alias("code_type"),
        F.when(matched, F.regexp_extract(code, pattern, 2)).alias("code_level"),
        F.when(matched, F.regexp_extract(code, pattern, 3)).alias("code_rest"),
    )


def strip_leading_zero(c: Col) -> Column:
    return F.regexp_replace(col(c), "^0", "")


def like_any(c: Col, patterns) -> Column:
    """True where any LIKE pattern matches."""
    return reduce(lambda a, b: a | b, [col(c).like(p) for p in as_list(patterns)])


def geoid(c: Col) -> Column:
    """Area key without its 7-character prefix."""
    return F.substring(col(c), 8, 2**31 - 1)


def strip_digits(c: Col) -> Column:
    """Digits removed at both ends only."""
    return F.regexp_replace(col(c), r"^\d+|\d+$", "")


def fix_letter_o(c: Col) -> Column:
    return F.replace(col(c), F.lit("O"), F.lit("0"))


def format_key(c: Col, prefix: str = "FCF", width: int = 12) -> Column:
    return F.concat(F.lit(prefix), F.lpad(col(c).cast("string"), width, "0"))


def is_nln(c: Col) -> Column:
    """Starts with a one or two digit number, a letter, and a number (or a letter O typed for zero)."""
    return F.coalesce(col(c).rlike(r"^\d{1,2}[A-Z](\d{1,2}|O)"), F.lit(False))


def code_number(c: Col) -> Column:
    return F.regexp_replace(col(c), r"[A-Z]+[0-9]+.*", "")


def severity(c: Col) -> Column:
    """First non-digit of a numbered code, `NONE` for other codes."""
    return F.when(code_number(c).rlike(r"^\d+$"), F.substring(F.regexp_replace(col(c), r"[0-9]+", ""), 1, 1)).otherwise(
        F.lit("NONE")
    )


def unit_to_m(c: Col) -> Column:
    """Three-character `A..`/`R..` units are renamed to `M..`."""
    unit = col(c)
    return F.when(unit.rlike("^[AR]..$"), F.concat(F.lit("M"), F.substring(unit, 2, 2))).otherwise(unit)


def code_synonym(c: Col) -> Column:
    return F.coalesce(lookup(c, CODE_SYNONYMS), col(c))


def code_label(c: Col, long: bool = False) -> Column:
    """Label of a numeric code held as text, or the text itself when it has none."""
    labels = CODE_LABELS_LONG if long else CODE_LABELS
    return F.coalesce(lookup(c, {str(k): v for k, v in labels.items()}), col(c))


def urgency(c: Col, buckets: dict[str, list[str]] | None = None, default: str = "other") -> Column:
    by_code = {code: name for name, codes in (buckets or URGENCY_BUCKETS).items() for code in codes}
    return F.coalesce(lookup(c, by_code), F.lit(default))


def key_date(c: Col) -> Column:
    """Date of an event key holding `yymmdd` from its fourth character."""
    return F.to_date(F.concat(F.lit("20"), F.substring(col(c), 4, 6)), "yyyyMMdd")


def spec_hash(cols, sep: str = "") -> Column:
    return F.md5(F.concat_ws(sep, *[col(c).cast("string") for c in as_list(cols)]))


def shorten_names(c: Col, mapping=None) -> Column:
    out = col(c)
    for old, new in mapping or MODEL_NAME_REPLACEMENTS:
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def family(name: Col, needles, default: str = "other") -> Column:
    """First needle contained in the name, in the order given."""
    out = F.lit(default)
    for needle in reversed(as_list(needles)):
        out = F.when(col(name).contains(needle), F.lit(needle)).otherwise(out)
    return out
