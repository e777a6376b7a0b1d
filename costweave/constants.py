"""Fixed values of the costing domain.

Everything in this module is a lookup value or a text that appears in results
and therefore has to be the same in every run.
"""

from decimal import Decimal

# --- Fixed values: statuses and codes -------------------------------------
READY, REVIEW, EXCLUDED = "READY", "REVIEW", "EXCLUDED"
VALID = "VALID"
ASSIGNED, ALLOCATED = "ASSIGNED", "ALLOCATED"
DIRECT, INDIRECT, OVERHEAD, EXCLUDE = "Direct", "Indirect", "Overhead", "Exclude"
UNMAPPED_POOL, UNMAPPED_CATEGORY, REVIEW_TREATMENT, REVIEW_DRIVER = (
    "UNMAPPED",
    "Unmapped",
    "Review",
    "review",
)
OVERHEAD_POOL, OVERHEAD_DRIVER = "OVERHEAD", "pre_overhead_cost"
COUNT_DRIVER = "encounter_count"

# --- Fixed values: resource measure -> pool it drives ----------------------
MEASURE_POOLS = {
    "bed_days": "WARD_NURSING",
    "theatre_minutes": "THEATRE",
    "imaging_weighted_units": "IMAGING",
    "pathology_weighted_units": "PATHOLOGY",
    "pharmacy_units": "PHARMACY",
    "medical_service_units": "MEDICAL",
    "allied_health_units": "ALLIED_HEALTH",
}
# Pool driven by one unit per encounter -> care type (None = every one)
COUNT_POOLS = {
    "EMERGENCY_CARE": "Emergency",
    "OUTPATIENT_CARE": "Outpatient",
    "PATIENT_ADMIN": None,
}

# --- Fixed values: notes written to result rows ----------------------------
NOTE_NO_CENTRE = "Cost centre is not mapped to an active governed reference row."
NOTE_NO_ACCOUNT = "Natural account is not mapped to an active governed account mapping."
NOTE_CONTESTED_CENTRE = "Several active versions of the cost centre hold in this month."
NOTE_CONTESTED_RULE = "Several active allocation rules hold for this pool and category in this month."
NOTE_EXCLUDED = "Account mapping marks this cost as excluded from patient costing."
NOTE_ZERO_UNITS = "Zero driver units for this encounter and cost pool."
NOTE_NO_PRE_OVERHEAD = (
    "No direct or indirect patient-care cost before overhead allocation."
)
NOTE_SMALL_COHORT = (
    "Cohort has fewer than {n} encounters; high-cost comparison not considered stable."
)
NOTE_HIGH_COST = (
    "High-cost flag: total patient cost is at or above the cohort 95th percentile. "
    "Cohort count="
)
NOTE_ZERO_DRIVER = "Cost pool has GL amount but no valid eligible driver units."
NOTE_FAILED_DIRECT = "Direct cost could not be assigned to a valid staged encounter."
NOTE_UNFUNDED = (
    "Activity group is unclassified or unsupported for synthetic ABF comparison."
)
NOTE_FUNDED = (
    "Synthetic ABF estimate using base weight, demonstration adjustments and "
    "long-stay outlier logic."
)
NOTE_POOL_DIFFERENCE = (
    "Cost pool does not reconcile at detailed level; review direct assignment, "
    "allocation or unallocated treatment."
)
NOTE_NO_POOL = "Unallocated cost without a matched cost pool."
NOTE_TOTAL = "Total reconciliation summarised from COST_POOL reconciliation rows."

# --- Fixed values: funding --------------------------------------------------
BASE_PRICE = Decimal("10750.000000")
ADJUSTMENT_FACTORS = {
    "INDIGENOUS": Decimal("1.040000"),
    "REMOTE": Decimal("1.060000"),
    "PAEDIATRIC": Decimal("1.050000"),
    "SAME_DAY": Decimal("0.920000"),
}
ADJUSTMENT_NOTES = {
    "INDIGENOUS": "Synthetic Indigenous adjustment",
    "REMOTE": "Synthetic remote adjustment",
    "PAEDIATRIC": "Synthetic paediatric adjustment",
    "SAME_DAY": "Synthetic same-day adjustment",
}
NOTE_BASE_WEIGHT_ONLY = "Base synthetic weight only"
NOTE_UNSUPPORTED_GROUP = "Activity group is unclassified or unsupported"

# --- Fixed values: thresholds -----------------------------------------------
TOLERANCE = Decimal("1.00")
HIGH_COST_PERCENTILE, MIN_COHORT = 0.95, 20
MATERIAL_AMOUNT, MATERIAL_SHARE = Decimal("100000"), Decimal("0.10")
# level -> (dollar threshold, share of monthly ledger), lowest first
UNALLOCATED_LEVELS = [
    ("Medium", Decimal("1000"), Decimal("0.0001")),
    ("High", Decimal("10000"), Decimal("0.0010")),
    ("Critical", Decimal("100000"), Decimal("0.0100")),
]
# measure -> (upper limit per encounter-month, severity above it)
PLAUSIBLE_RANGES = {
    "bed_days": (31, "HIGH"),
    "theatre_minutes": (1440, "HIGH"),
    "imaging_weighted_units": (100, "MEDIUM"),
    "pathology_weighted_units": (500, "MEDIUM"),
    "pharmacy_units": (10000, "MEDIUM"),
    "allied_health_units": (200, "MEDIUM"),
}

# --- Fixed values: validation rule catalogue ---------------------------------
RULE_COLUMNS = [
    "validation_rule_id",
    "source_entity",
    "rule_category",
    "rule_name",
    "rule_description",
    "severity",
    "blocking_flag",
    "active_flag",
]
RULES = [
    (
        "RU_NOT_PROMOTED",
        "resource_usage",
        "TYPE_OR_VALUE",
        "Resource usage row did not promote to staging",
        "Landing resource usage row was not inserted into stg.resource_usage, usually "
        "due to invalid numeric driver values or unknown encounter.",
        "HIGH",
        "Y",
        "Y",
    ),
    (
        "DC_NOT_PROMOTED",
        "direct_cost_detail",
        "REFERENCE",
        "Direct cost row did not promote to staging",
        "Landing direct cost row was not inserted into stg.direct_cost_detail, usually "
        "due to an unknown encounter or invalid amount/quantity.",
        "HIGH",
        "Y",
        "Y",
    ),
    (
        "GL_UNKNOWN_COST_CENTRE",
        "general_ledger_transaction",
        "MAPPING",
        "GL transaction has unknown cost centre",
        "Typed GL transaction has a cost centre that is not active in ref.cost_centre "
        "for the reporting month.",
        "MEDIUM",
        "N",
        "Y",
    ),
    (
        "GL_UNMAPPED_ACCOUNT",
        "general_ledger_transaction",
        "MAPPING",
        "GL transaction has unmapped natural account",
        "Typed GL transaction has a natural account that is not active in "
        "ref.account_mapping.",
        "MEDIUM",
        "N",
        "Y",
    ),
    (
        "ZERO_DRIVER_POOL",
        "costing",
        "ALLOCATION",
        "Cost pool has no eligible driver units",
        "Cost pool cannot be allocated because total eligible driver units are zero.",
        "HIGH",
        "N",
        "Y",
    ),
]
# rule -> (result message, issue field, owner, recommended action)
RULE_TEXTS = {
    "RU_NOT_PROMOTED": (
        "Landing resource usage rows not promoted to typed staging.",
        "resource_usage_driver_values",
        "Health information / costing analyst",
        "Review invalid resource-use driver value or encounter linkage before allocation.",
    ),
    "DC_NOT_PROMOTED": (
        "Landing direct cost rows not promoted to typed staging.",
        "encounter_id",
        "Costing analyst / finance",
        "Review direct cost encounter linkage. If encounter cannot be resolved, retain "
        "as unallocated cost.",
    ),
    "GL_UNKNOWN_COST_CENTRE": (
        "Typed GL transactions with cost centres not active in governed reference data.",
        "cost_centre_id",
        "Finance / costing analyst",
        "Review cost-centre mapping. Until resolved, retain amount as unallocated/review.",
    ),
    "GL_UNMAPPED_ACCOUNT": (
        "Typed GL transactions with natural accounts not active in governed account "
        "mapping.",
        "natural_account",
        "Finance / costing analyst",
        "Review account mapping. Until resolved, retain amount as unallocated/review.",
    ),
    "ZERO_DRIVER_POOL": (
        "Cost pools with GL amount but no valid eligible driver units.",
        "allocation_driver",
        "Costing analyst",
        "Retain this pool as unallocated/review unless an eligible driver population is "
        "approved.",
    ),
}
