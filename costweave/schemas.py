"""Declared schemas: landing entities, reference tables and their keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 6)
# sums of any number of rows; a pool's or month's amount is divided, so it leaves digits to the quotient
TOTAL = T.DecimalType(38, 6)
POOL_AMOUNT = T.DecimalType(25, 6)
WEIGHT = T.DecimalType(12, 6)
# rate = money / units keeps 19 decimals; it is rounded only when shown
RATE = T.DecimalType(38, 19)

RUN = "load_run_id"
LINEAGE = [RUN, "source_file_name", "source_row_number"]


@dataclass(frozen=True)
class Field:
    """One landing column: a text of at most ``width`` or a typed value."""

    name: str
    kind: T.DataType
    width: int | None = None


@dataclass(frozen=True)
class Entity:
    """A raw extract and the rules its rows meet before they are staged."""

    name: str
    key: str
    fields: tuple[Field, ...]
    non_negative: tuple[str, ...] = ()
    ordered: tuple[str, str] | None = None
    conforms: tuple[str, ...] = ()
    needs_encounter: bool = False

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def landing_schema(self) -> T.StructType:
        return T.StructType([T.StructField(c, T.StringType()) for c in self.columns])

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.kind) for f in self.fields])


def _text(width: int, *names: str) -> list[Field]:
    return [Field(n, T.StringType(), width) for n in names]


def _typed(kind: T.DataType, *names: str) -> list[Field]:
    return [Field(n, kind) for n in names]


MEASURES = (
    "bed_days",
    "theatre_minutes",
    "imaging_weighted_units",
    "pathology_weighted_units",
    "pharmacy_units",
    "medical_service_units",
    "allied_health_units",
)

ENCOUNTER = Entity(
    "patient_encounter",
    "encounter_id",
    (
        *_text(20, "encounter_id", "patient_id"),
        *_text(100, "facility", "service_line"),
        *_text(30, "care_type"),
        *_typed(T.DateType(), "admission_date", "discharge_date", "episode_month"),
        *_text(30, "activity_group_code"),
        *_typed(T.ShortType(), "length_of_stay"),
        *_text(30, "separation_status"),
        *_typed(T.ShortType(), "age_years"),
        *_text(1, "indigenous_status"),
        *_text(50, "remoteness_area"),
        *_text(1, "high_complexity_flag", "hospital_acquired_complication_flag"),
    ),
    ordered=("admission_date", "discharge_date"),
    conforms=("service_line", "care_type", "activity_group_code"),
)
RESOURCE = Entity(
    "resource_usage",
    "resource_usage_id",
    (
        *_text(20, "resource_usage_id", "encounter_id"),
        *_typed(T.DateType(), "service_month"),
        *_typed(T.IntegerType(), *MEASURES),
    ),
    non_negative=MEASURES,
    needs_encounter=True,
)
DIRECT_COST = Entity(
    "direct_cost_detail",
    "direct_cost_id",
    (
        *_text(20, "direct_cost_id", "encounter_id"),
        *_typed(T.DateType(), "service_month"),
        *_text(30, "cost_centre_id"),
        *_text(20, "natural_account"),
        *_text(100, "direct_cost_type"),
        *_typed(T.IntegerType(), "quantity"),
        *_typed(MONEY, "amount"),
    ),
    non_negative=("quantity",),
    needs_encounter=True,
)
LEDGER = Entity(
    "general_ledger_transaction",
    "gl_transaction_id",
    (
        *_text(20, "gl_transaction_id"),
        *_typed(T.DateType(), "reporting_month"),
        *_text(100, "entity", "facility"),
        *_text(30, "cost_centre_id"),
        *_text(20, "natural_account"),
        *_text(200, "account_description"),
        *_typed(MONEY, "signed_amount"),
        *_text(30, "adjustment_type"),
        *_text(200, "source_reference"),
    ),
)
ENTITIES = {e.name: e for e in (ENCOUNTER, RESOURCE, DIRECT_COST, LEDGER)}


@dataclass(frozen=True)
class Reference:
    """A governed reference table: key and typed columns."""

    name: str
    keys: tuple[str, ...]
    ddl: str
    blank_to_null: tuple[str, ...] = ()


REFERENCES = {
    r.name: r
    for r in (
        Reference("service_line", ("service_line",), "service_line string, description string"),
        Reference("care_type", ("care_type",), "care_type string, description string"),
        Reference(
            "activity_group",
            ("activity_group_code",),
            "activity_group_code string, activity_group_name string, "
            "default_service_line string, default_care_type string, "
            "official_classification_flag string",
            ("default_service_line", "default_care_type"),
        ),
        Reference(
            "cost_centre",
            ("cost_centre_id", "effective_from"),
            "cost_centre_id string, cost_centre_name string, service_line string, "
            "cost_pool_code string, active_flag string, effective_from date, "
            "effective_to date",
        ),
        Reference(
            "account_mapping",
            ("natural_account",),
            "natural_account string, account_description string, cost_category string, "
            "costing_treatment string, default_driver string, active_flag string",
        ),
        Reference(
            "allocation_rule",
            ("allocation_rule_id", "effective_from"),
            "allocation_rule_id string, cost_pool_code string, cost_category string, "
            "allocation_driver string, eligible_scope string, business_rationale string, "
            "effective_from date, effective_to date, active_flag string",
        ),
        Reference(
            "reporting_period",
            ("reporting_month",),
            "reporting_month date, period_start date, period_end date, "
            "financial_year string, period_number short",
        ),
        Reference(
            "abf_activity_group",
            ("activity_group_code",),
            "activity_group_code string, activity_group_name string, "
            "service_stream string, synthetic_base_weight decimal(12,6), "
            "high_length_of_stay_trim_days short, "
            "synthetic_outlier_nwau_per_day decimal(12,6), "
            "official_price_weight_flag string",
        ),
        Reference(
            "abf_adjustment_rule",
            ("adjustment_code",),
            "adjustment_code string, description string, factor string, "
            "application string, official_adjustment_flag string",
        ),
    )
}
