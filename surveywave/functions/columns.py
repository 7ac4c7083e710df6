"""Column helpers.  All are built-in Spark expressions (codegen, no UDF)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Colour score domain and its labels.
VALID_RAW_SCORES = [0, 1, 2, 3, 9]          # 9 = not applicable
SCORED_VALUES = [0, 1, 2, 3]
SCORE_LABELS = {0: "Skipped", 1: "Red", 2: "Yellow", 3: "Green"}
LABEL_ORDER = {"Green": "1 - Green", "Yellow": "2 - Yellow", "Red": "3 - Red",
               "Skipped": "4 - Skipped"}
LABEL_ORDER_ELSE = "5 - Unknown"
CORE_DIMENSIONS = [
    "housingandinfrastructure.name", "healthandenvironment.name", "educationandculture.name",
    "incomeandemployment.name", "interiorityandmotivation.name",
    "organizationandparticipation.name",
]
MALE_CODES = ["M", "MASCULINO", "LALAKI", "GASON", "Male"]
FEMALE_CODES = ["F", "FEMENINO", "BABAE", "FI", "Female"]

COORD_PATTERN = r"^-?[0-9]+\.?[0-9]*\z"   # \z: no trailing newline accepted


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def norm_key(c) -> Column:
    """Join key normalisation: lower(trim(x)) (trim removes spaces only)."""
    return F.lower(F.trim(col_(c)))


def epoch_ts(c, unit: str = "s") -> Column:
    """Epoch number → timestamp.  ``ms`` divides as integers (truncating toward
    zero, like bigint / 1000), so the result has whole seconds."""
    c = col_(c)
    if unit == "s":
        return F.timestamp_seconds(c)
    if unit == "ms":
        whole = ((c - c % 1000) / 1000).cast("long")
        return F.timestamp_seconds(whole)
    raise ValueError(f"unknown epoch unit {unit!r}")


def geo_coord(c, bound: int) -> Column:
    """Keep a coordinate string only if it is a plain decimal inside ±bound,
    rounded to 2 decimals; else NULL.  try_cast: a bad string never raises."""
    c = col_(c)
    num = c.try_cast("decimal(38,18)")
    ok = c.rlike(COORD_PATTERN) & num.between(-bound, bound)
    return F.when(ok, F.round(num, 2).cast("decimal(5,2)"))


def score_or_null(c) -> Column:
    c = col_(c)
    return F.when(c.isin(SCORED_VALUES), c)


def score_label(c, null_label: str) -> Column:
    """0..3 → Skipped/Red/Yellow/Green; anything else → ``null_label``."""
    c = col_(c)
    out = None
    for k, v in SCORE_LABELS.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(null_label)


def baseline_label(c="baseline_score") -> Column:
    return score_label(c, "N/A")


def previous_label(c="previous_score") -> Column:
    return score_label(c, "N/A")


def current_label(c="current_score") -> Column:
    return score_label(c, "Unknown")


def label_ordered(c) -> Column:
    """Sortable label: Green → '1 - Green' … Skipped → '4 - Skipped', else '5 - Unknown'."""
    c = col_(c)
    out = None
    for k, v in LABEL_ORDER.items():
        out = F.when(c == k, v) if out is None else out.when(c == k, v)
    return out.otherwise(LABEL_ORDER_ELSE)


def snapshot_type(c="snapshot_number") -> Column:
    """1 Baseline, 2 '1st Follow-up', 3 '2nd…', 4 '3rd…', else '<n-1>th Follow-up'."""
    c = col_(c)
    return (F.when(c == 1, "Baseline").when(c == 2, "1st Follow-up")
            .when(c == 3, "2nd Follow-up").when(c == 4, "3rd Follow-up")
            .otherwise(F.concat((c - 1).cast("string"), F.lit("th Follow-up"))))


def survey_type(c="snapshot_number") -> Column:
    c = col_(c)
    return F.when(c == 1, "Baseline").otherwise("Follow-up")


def date_key(c) -> Column:
    """YYYYMMDD integer of a timestamp/date (session zone UTC)."""
    return F.date_format(col_(c), "yyyyMMdd").cast("int")


def days_between(later, earlier) -> Column:
    return F.datediff(F.to_date(col_(later)), F.to_date(col_(earlier)))


def ratio(num, den) -> Column:
    """num × 1.0 / nullif(den, 0) as double; NULL on a zero denominator."""
    num, den = col_(num), col_(den)
    return F.when(den != 0, num.cast("double") / den.cast("double"))


def cond_sum(cond: Column, weight="family_count") -> Column:
    """sum(case when cond then weight else 0 end) as long."""
    return F.sum(F.when(cond, col_(weight)).otherwise(F.lit(0))).cast("long")


def surrogate_key(*cols) -> Column:
    """md5 over '-'-joined string values, NULL spelled '_null_'."""
    parts = [F.coalesce(col_(c).cast("string"), F.lit("_null_")) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def mask_anonymous(name, anonymous) -> Column:
    return F.when(col_(anonymous), F.lit("ANON_DATA")).otherwise(col_(name))
