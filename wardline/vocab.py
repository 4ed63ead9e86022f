"""Vocabularies: which parameters exist, how duplicates merge, which values are implausible.

A :class:`Vocabulary` is plain data.  Operators read it to build Spark
expressions, so the same code serves the intensive-care layout and any other
long ``(entity, parameter, time, value)`` table, such as the driver's
``events`` table (see :data:`EVENTS`).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# ---------------------------------------------------------------------------
# Fixed values of the intensive-care record layout.  They must equal the
# values the reference uses, so they are listed plainly and in natural order.
# ---------------------------------------------------------------------------

ICU_STATIC_VARS = ["Age", "Gender", "Height", "ICUType", "Weight"]

ICU_SERIES_VARS = [
    "Albumin", "ALP", "ALT", "AST", "Bilirubin", "BUN", "Cholesterol",
    "Creatinine", "DiasABP", "FiO2", "GCS", "Glucose", "HCO3", "HCT",
    "HR", "K", "Lactate", "Mg", "MAP", "MechVent", "Na", "NIDiasABP",
    "NIMAP", "NISysABP", "PaCO2", "PaO2", "pH", "Platelets", "RespRate",
    "SaO2", "SysABP", "Temp", "TroponinI", "TroponinT", "Urine", "WBC",
    "Weight_VAR",
]

ICU_DESCRIPTIONS = {
    "Albumin": "Serum Albumin (g/dL)",
    "ALP": "Alkaline phosphatase (IU/L)",
    "ALT": "Alanine transaminase (IU/L)",
    "AST": "Aspartate transaminase (IU/L)",
    "Bilirubin": "Bilirubin (mg/dL)",
    "BUN": "Blood urea nitrogen (mg/dL)",
    "Cholesterol": "Cholesterol (mg/dL)",
    "Creatinine": "Serum creatinine (mg/dL)",
    "DiasABP": "Invasive diastolic arterial blood pressure (mmHg)",
    "FiO2": "Fractional inspired O2 (0-1)",
    "GCS": "Glasgow Coma Score (3-15)",
    "Glucose": "Serum glucose (mg/dL)",
    "HCO3": "Serum bicarbonate (mmol/L)",
    "HCT": "Hematocrit (%)",
    "HR": "Heart rate (bpm)",
    "K": "Serum potassium (mEq/L)",
    "Lactate": "Lactate (mmol/L)",
    "Mg": "Serum magnesium (mmol/L)",
    "MAP": "Invasive mean arterial blood pressure (mmHg)",
    "MechVent": "Mechanical ventilation respiration (0:false or 1:true)",
    "Na": "Serum sodium (mEq/L)",
    "NIDiasABP": "Non-invasive diastolic arterial blood pressure (mmHg)",
    "NIMAP": "Non-invasive mean arterial blood pressure (mmHg)",
    "NISysABP": "Non-invasive systolic arterial blood pressure (mmHg)",
    "PaCO2": "partial pressure of arterial CO2 (mmHg)",
    "PaO2": "Partial pressure of arterial O2 (mmHg)",
    "pH": "Arterial pH (0-14)",
    "Platelets": "Platelets (cells/nL)",
    "RespRate": "Respiration rate (bpm)",
    "SaO2": "O2 saturation in hemoglobin (%)",
    "SysABP": "Invasive systolic arterial blood pressure (mmHg)",
    "Temp": "Temperature (°C)",
    "TroponinI": "Troponin-I (μg/L)",
    "TroponinT": "Troponin-T (μg/L)",
    "Urine": "Urine output (mL)",
    "WBC": "White blood cell count (cells/nL)",
    "Weight_VAR": "Weight (kg)",
}

# Grid plausibility (applied after the hourly mean): value -> null when the
# predicate holds.  Gender below zero or missing becomes 1.
ICU_GRID_RULES = [
    ("Height", "below", 100), ("Height", "above", 250),
    ("Weight", "below", 20),
    ("HR", "below", 10),
    ("DiasABP", "at_most", 0), ("MAP", "at_most", 0), ("NIDiasABP", "at_most", 0),
    ("NIMAP", "at_most", 0), ("NISysABP", "at_most", 0), ("SysABP", "at_most", 0),
    ("RespRate", "at_most", 0), ("PaO2", "at_most", 0),
    ("Weight_VAR", "below", 20),
    ("pH", "below", 6), ("pH", "above", 8),
    ("Temp", "below", 12), ("Temp", "above", 45),
]
# Long-table plausibility (applied to events before the tuple layout):
# same bounds, no Weight_VAR (it does not exist in the long table).
ICU_TUPLE_RULES = [r for r in ICU_GRID_RULES if r[0] != "Weight_VAR"]

ICU_PAD_INDEX = 0
ICU_TIME_SCALE_MINUTES = 49 * 60       # 2940: time is scaled by a fixed range
ICU_N_BINS = 49                         # hours 0..48
ICU_MAX_SEQ_LEN = 578                   # truncation used by the tuple loader


@dataclass(frozen=True)
class Vocabulary:
    """Names and rules of one long-table layout."""

    static_vars: list[str]
    series_vars: list[str]
    # duplicate merge: these parameters sum, these take the max of two,
    # these average three or more; every other parameter averages two and
    # raises (strict) on three or more.
    sum_params: tuple[str, ...] = ()
    max_params: tuple[str, ...] = ()
    mean_many_params: tuple[str, ...] = ()
    # static copied as a time series under a second name (wide grid only)
    static_copies: dict[str, str] = field(default_factory=dict)
    # static whose missing/negative value is replaced by a default
    default_fill: dict[str, float] = field(default_factory=dict)
    grid_rules: list[tuple[str, str, float]] = field(default_factory=list)
    tuple_rules: list[tuple[str, str, float]] = field(default_factory=list)
    # parameters nulled in the tuple layout (identifiers, categories)
    tuple_null_params: tuple[str, ...] = ()
    id_param: str | None = None
    hourly_sum_params: tuple[str, ...] = ()
    descriptions: dict[str, str] = field(default_factory=dict)
    model_drop_vars: tuple[str, ...] = ()

    @property
    def grid_vars(self) -> list[str]:
        return list(self.static_vars) + list(self.series_vars)

    @property
    def model_static_vars(self) -> list[str]:
        return [v for v in self.static_vars if v not in self.model_drop_vars]

    @property
    def raw_params(self) -> list[str]:
        """Parameters found in the long table (copies are derived later)."""
        copies = set(self.static_copies.values())
        return list(self.static_vars) + [v for v in self.series_vars if v not in copies]


ICU = Vocabulary(
    static_vars=ICU_STATIC_VARS,
    series_vars=ICU_SERIES_VARS,
    sum_params=("Urine",),
    max_params=("Temp",),
    mean_many_params=("HCT",),
    static_copies={"Weight": "Weight_VAR"},
    default_fill={"Gender": 1.0},
    grid_rules=ICU_GRID_RULES,
    tuple_rules=ICU_TUPLE_RULES,
    tuple_null_params=("RecordID", "ICUType"),
    id_param="RecordID",
    hourly_sum_params=("Urine",),
    descriptions=ICU_DESCRIPTIONS,
    model_drop_vars=("ICUType",),
)

# ---------------------------------------------------------------------------
# The driver's ``events`` table read as a long record table:
# entity = user_id, parameter = event_type, time = ts, value = value.
# ``signup`` plays a static (its first value per user), ``purchase`` plays the
# summed parameter, ``error`` the max-of-two parameter, ``view`` the
# averaged-many parameter.  Bounds are chosen so that each rule fires.
# ---------------------------------------------------------------------------
EVENTS = Vocabulary(
    static_vars=["signup"],
    series_vars=["click", "error", "purchase", "view", "signup_VAR"],
    sum_params=("purchase",),
    max_params=("error",),
    mean_many_params=("view",),
    static_copies={"signup": "signup_VAR"},
    default_fill={},
    grid_rules=[
        ("signup", "below", 1),
        ("click", "below", 1),
        ("error", "below", 1), ("error", "above", 300),
        ("view", "at_most", 0.5),
        ("signup_VAR", "below", 1),
    ],
    tuple_rules=[
        ("signup", "below", 1),
        ("click", "below", 1),
        ("error", "below", 1), ("error", "above", 300),
        ("view", "at_most", 0.5),
    ],
    tuple_null_params=(),
    id_param=None,
    hourly_sum_params=("purchase",),
    descriptions={
        "click": "Clicks (count)",
        "error": "Errors (count)",
        "purchase": "Purchase amount (USD)",
        "view": "Page views (count)",
        "signup": "Signup score",
        "signup_VAR": "Signup score",
    },
)

# Origin of elapsed time for the events table and its daily grid.
EVENTS_ORIGIN = "2024-01-01 00:00:00"
EVENTS_BIN_MINUTES = 1440
EVENTS_N_BINS = 31
