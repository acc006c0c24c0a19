"""Total intravenous anesthesia: the case cohort and its supporting domains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from chartloom.functions.text import NUMBER, canonical_id, to_number
from chartloom.operators.cohorts import cohort, matching, with_codes
from chartloom.operators.keys import join_any_key, unpivot_keys
from chartloom.operators.lookups import lookup
from chartloom.operators.pivots import conditional_totals
from chartloom.operators.reports import stored_report
from chartloom.operators.windows import within_window
from chartloom.sources.catalog import Catalog

from .preop import CONTRACTS as PREOP_CONTRACTS
from .stages import Stages

STAGES = Stages()
SHARED = {"tiva_anesthesia_encounters", "analytics.tiva_cohort"}

# Descriptive columns of a medication administration and of a patient, in output order.
MEDICATION_TEXT = (
    "medication_order_id order_date medication_id medication_name instance_number administration_datetime"
    " administration_action administered_dose dose_unit route pharmaceutical_class pharmaceutical_subclass"
    " ingredient_rxcui ingredient_rxcui_name specific_rxcui specific_rxcui_type generic_product_identifier"
    " order_class ordering_mode order_status frequency ordered_dose ordered_dose_unit quantity"
    " part_of_mixture_flag mixture_ingredient_type parent_medication_id parent_medication_name"
    " authorizing_provider_type"
).split()
DEMOGRAPHICS = (
    "sex gender_identity birth_year vital_status marital_status employment_status race ethnicity"
    " preferred_language interpreter_needed_flag state zip3 pediatric_gestational_age veteran_status"
    " advance_directive_flag transplant_patient_flag area_deprivation_index rural_urban_commuting_area_code"
).split()
BODY = (
    "height weight bmi diastolic_blood_pressure systolic_blood_pressure pulse temperature respiratory_rate"
    " stop_bang_score"
).split()


def _typed(names: list[str]) -> str:
    special = {"birth_year": "int", "order_date": "date", "administration_datetime": "timestamp_ntz"}
    return ", ".join(f"{n} {special.get(n, 'string')}" for n in names)


CONTRACTS = {
    "analytics.surgical_candidate_cohort": (
        "patient_id string, admission_encounter_id string, surgery_encounter_id string, case_id string,"
        " log_id string, scheduled_start_time timestamp_ntz, anesthesia_types string"
    ),
    "clinical.surgical_encounter_map": (
        "surgery_encounter_id string, primary_anesthesia_encounter_id string, secondary_anesthesia_encounter_id string"
    ),
    "clinical.encounters": "encounter_id string, inpatient_data_id string",
    "clinical.flowsheet_records": "inpatient_data_id string, flowsheet_document_id string, patient_id string",
    "clinical.flowsheet_measurements": (
        "flowsheet_document_id string, measure_id string, measure_value string, recorded_datetime timestamp_ntz"
    ),
    "clinical.medication_administration": "encounter_id string, " + _typed(MEDICATION_TEXT),
    "clinical.airway_device_documentation": (
        "encounter_id string, measure_id string, placement_datetime timestamp_ntz, removal_datetime timestamp_ntz,"
        " device_description string, device_properties string"
    ),
    "clinical.patient_demographics": "patient_id string, " + _typed(DEMOGRAPHICS),
    "clinical.problem_list": PREOP_CONTRACTS["clinical.problem_list"],
    "clinical.patient_vitals": (
        "patient_id string, encounter_id string, measurement_date timestamp_ntz, "
        + ", ".join(f"{c} decimal(12,3)" for c in BODY)
    ),
    "reference.flowsheet_measures": "measure_id string, measure_name string",
}

# Measure and formulation codes, encounter roles.
VOLATILE_MEASURES = [f"VOLATILE_AGENT_CONCENTRATION_{i}" for i in range(1, 7)]
AIRWAY_MEASURES = ["ENDOTRACHEAL_TUBE", "SUPRAGLOTTIC_AIRWAY", "ORAL_AIRWAY", "NASAL_AIRWAY"]
VITAL_MEASURES = [
    "HEART_RATE",
    "RESPIRATORY_RATE",
    "OXYGEN_SATURATION",
    "SYSTOLIC_BLOOD_PRESSURE",
    "DIASTOLIC_BLOOD_PRESSURE",
    "MEAN_ARTERIAL_PRESSURE",
    "TEMPERATURE",
]
BODY_MEASURES = [
    "BODY_MASS_INDEX",
    "ADMISSION_WEIGHT",
    "CURRENT_WEIGHT",
    "DOSING_WEIGHT",
    "IDEAL_BODY_WEIGHT",
    "HEIGHT",
    "ESTIMATED_HEIGHT",
    "ESTIMATED_WEIGHT",
]
FORMULATIONS = {
    "PROPOFOL_500MG_50ML": "propofol_500mg_50ml",
    "PROPOFOL_200MG_20ML": "propofol_200mg_20ml",
    "PROPOFOL_INFUSION_BOLUS": "propofol_infusion_bolus",
    "PROPOFOL_1000MG_100ML": "propofol_1000mg_100ml",
    "PROPOFOL_10MG_ML": "propofol_10mg_ml",
}
ENCOUNTER_ROLES = {
    "Admission encounter": "admission_encounter_id",
    "Surgical encounter": "surgery_encounter_id",
    "Primary anesthesia encounter": "primary_anesthesia_encounter_id",
    "Secondary anesthesia encounter": "secondary_anesthesia_encounter_id",
}
AGENT = "%PROPOFOL%"
BEFORE_START = "48 HOURS"
CASE = ["patient_id", "admission_encounter_id", "surgery_encounter_id", "log_id", "scheduled_start_time"]


def _positive_agent_doses(cat: Catalog) -> DataFrame:
    given = matching(cat["clinical.medication_administration"], "medication_name", include=[AGENT])
    return given.withColumn("administered_dose", to_number(F.col("administered_dose"))).where(
        F.col("administered_dose") > 0
    )


@STAGES("tiva_anesthesia_encounters")
def tiva_anesthesia_encounters(cat: Catalog) -> DataFrame:
    """Candidate cases with each anesthesia encounter they map to."""
    linked = cat["analytics.surgical_candidate_cohort"].join(
        cat["clinical.surgical_encounter_map"], "surgery_encounter_id"
    )
    return join_any_key(
        linked,
        ["primary_anesthesia_encounter_id", "secondary_anesthesia_encounter_id"],
        cat["clinical.encounters"].select("encounter_id", "inpatient_data_id"),
        "encounter_id",
    ).select(
        "patient_id",
        "admission_encounter_id",
        "surgery_encounter_id",
        "case_id",
        "log_id",
        "scheduled_start_time",
        "anesthesia_types",
        "primary_anesthesia_encounter_id",
        "secondary_anesthesia_encounter_id",
        "inpatient_data_id",
    )


@STAGES("analytics.tiva_cohort")
def tiva_cohort(cat: Catalog) -> DataFrame:
    """Cases given propofol and no volatile agent, one row per matched anesthesia encounter.

    Both evidence sets shrink to distinct keys before they meet the cases.
    """
    cases = cat["tiva_anesthesia_encounters"]
    agent_documents = (
        cat["clinical.flowsheet_measurements"]
        .where(F.col("measure_id").isin(VOLATILE_MEASURES) & (to_number(F.col("measure_value")) > 0))
        .select("flowsheet_document_id")
        .distinct()
    )
    agent_stays = (
        cohort(cat["clinical.flowsheet_records"], "flowsheet_document_id", include=[agent_documents])
        .select("inpatient_data_id")
        .distinct()
    )
    volatile_logs = cohort(cases, "inpatient_data_id", include=[agent_stays]).select("log_id").distinct()

    dosed = _positive_agent_doses(cat).select(F.col("encounter_id").alias("primary_anesthesia_encounter_id"))
    propofol_logs = (
        cohort(cases, "primary_anesthesia_encounter_id", include=[dosed.distinct()]).select("log_id").distinct()
    )
    return cohort(cases, "log_id", include=[propofol_logs], exclude=[volatile_logs]).distinct()


@STAGES("analytics.tiva_final_cohort")
def tiva_final_cohort(cat: Catalog) -> DataFrame:
    """The cohort's rows are already distinct, so this is the cohort under its published name."""
    return cat["analytics.tiva_cohort"]


@STAGES("analytics.tiva_airway_devices")
def tiva_airway_devices(cat: Catalog) -> DataFrame:
    devices = with_codes(cat["clinical.airway_device_documentation"], "measure_id", AIRWAY_MEASURES)
    cases = cat["analytics.tiva_final_cohort"].select(
        *CASE, "case_id", F.col("primary_anesthesia_encounter_id").alias("encounter_id")
    )
    return cases.distinct().join(devices, "encounter_id").drop("encounter_id").distinct()


@STAGES("analytics.tiva_demographics")
def tiva_demographics(cat: Catalog) -> DataFrame:
    cases = cat["analytics.tiva_cohort"].select(*CASE).distinct()
    return cases.join(cat["clinical.patient_demographics"], "patient_id").select(*CASE, *DEMOGRAPHICS).distinct()


@STAGES("analytics.tiva_problem_list")
def tiva_problem_list(cat: Catalog) -> DataFrame:
    """Problems recorded on the admission encounter; the case supplies the patient."""
    problems = cat["clinical.problem_list"].drop("patient_id")
    cases = cat["analytics.tiva_cohort"].select(*CASE).distinct()
    on = F.col("admission_encounter_id") == F.col("problem_list_encounter_id")
    return cases.join(problems, on).distinct()


@STAGES("analytics.tiva_medication_administrations")
def tiva_medication_administrations(cat: Catalog) -> DataFrame:
    """Administrations on any encounter of a case, labeled with the encounter's role.

    A role of a case mostly has one encounter. Equal rows of it then share that encounter, so they
    are found where the join put them; only roles with several encounters are shuffled by row.
    """
    encounters = unpivot_keys(
        cat["analytics.tiva_cohort"].repartition(*CASE),
        {label: canonical_id(F.col(column)) for label, column in ENCOUNTER_ROLES.items()},
        key="_encounter",
        label="medication_encounter_type",
        keep=CASE,
    )
    role = Window.partitionBy(*CASE, "medication_encounter_type")
    encounters = encounters.withColumn("_alone", F.min("_encounter").over(role) == F.max("_encounter").over(role))
    given = cat["clinical.medication_administration"].select(
        canonical_id(F.col("encounter_id")).alias("_encounter"), *MEDICATION_TEXT
    )
    alone = encounters.where("_alone").drop("_alone").join(given, "_encounter").distinct().drop("_encounter")
    several = encounters.where("NOT _alone").drop("_alone").join(given, "_encounter").drop("_encounter").distinct()
    return alone.union(several)


@STAGES("analytics.tiva_vital_signs")
def tiva_vital_signs(cat: Catalog) -> DataFrame:
    """Selected vitals of a stay; the source encounter is named by its first matching role."""
    measured = with_codes(cat["clinical.flowsheet_measurements"], "measure_id", VITAL_MEASURES)
    role = None
    for label, column in ENCOUNTER_ROLES.items():
        hit = F.col("encounter_id") == F.col(column)
        role = F.when(hit, label) if role is None else role.when(hit, label)
    stays = (
        cat["analytics.tiva_cohort"]
        .join(cat["clinical.flowsheet_records"].drop("patient_id"), "inpatient_data_id")
        .join(cat["clinical.encounters"].select("encounter_id", "inpatient_data_id"), "inpatient_data_id")
        .select(*CASE, role.alias("source_encounter_type"), "flowsheet_document_id")
    )
    found = stays.join(measured, "flowsheet_document_id").drop("flowsheet_document_id")
    return lookup(found, cat["reference.flowsheet_measures"], "measure_id", ["measure_name"])


def _agent_doses_of_cases(cat: Catalog, cases: DataFrame) -> DataFrame:
    doses = _positive_agent_doses(cat).withColumnRenamed("encounter_id", "primary_anesthesia_encounter_id")
    return cases.select(*CASE, "primary_anesthesia_encounter_id").join(doses, "primary_anesthesia_encounter_id")


@STAGES("analytics.tiva_propofol_administrations")
def tiva_propofol_administrations(cat: Catalog) -> DataFrame:
    return _agent_doses_of_cases(cat, cat["analytics.tiva_cohort"]).select(
        *CASE,
        "primary_anesthesia_encounter_id",
        "medication_name",
        "medication_id",
        "administration_datetime",
        "administration_action",
        "administered_dose",
        "dose_unit",
        "route",
    )


@STAGES("analytics.tiva_propofol_dose_summary")
def tiva_propofol_dose_summary(cat: Catalog) -> DataFrame:
    """Dose totals per case and formulation.

    A case matched by two anesthesia encounters has two cohort rows and its
    totals count twice, as published; option ``dedupe`` counts each dose once.

    Doses are summed per encounter and formulation before the join, which adds
    nothing but one small row per pair to the shuffle.
    """
    cases = cat["analytics.tiva_cohort"].select(*CASE, "primary_anesthesia_encounter_id")
    if cat.option("dedupe", False):
        cases = cases.distinct()
    key = "primary_anesthesia_encounter_id"
    per_encounter = conditional_totals(
        _positive_agent_doses(cat).withColumnRenamed("encounter_id", key),
        [key],
        "medication_id",
        F.col("administered_dose"),
        "dose_unit",
        FORMULATIONS,
    )
    copies = cases.groupBy(*CASE, key).agg(F.count(F.lit(1)).alias("_copies"))
    joined = copies.join(per_encounter, key)
    totals = []
    for stem in FORMULATIONS.values():
        once = F.col(f"{stem}_total_dose").cast("decimal(27,9)")
        amount = (once * F.col("_copies").cast("decimal(10,0)")).cast(NUMBER)
        totals += [amount.alias(f"{stem}_total_dose"), F.col(f"{stem}_dose_unit")]
    return joined.select(*CASE, key, *totals)


@STAGES("analytics.tiva_body_measurements")
def tiva_body_measurements(cat: Catalog) -> DataFrame:
    vitals = cat["clinical.patient_vitals"].withColumnRenamed("encounter_id", "measurement_encounter_id")
    cases = cat["analytics.tiva_cohort"].select(*CASE).distinct()
    found = within_window(
        cases, vitals, "patient_id", "scheduled_start_time", "measurement_date", before=BEFORE_START
    )
    return found.distinct()


@STAGES("analytics.tiva_missing_body_measurements")
def tiva_missing_body_measurements(cat: Catalog) -> DataFrame:
    """Flowsheet measures for patients with no recorded BMI, or with a record whose BMI is null.

    Sorted output is for readers: sort by patient, measure name and time on read.
    """
    bmi = cat["analytics.tiva_body_measurements"].groupBy("patient_id").agg(
        F.max(F.col("bmi").isNull()).alias("_has_null_bmi")
    )
    cases = cat["analytics.tiva_cohort"].select(*CASE).distinct()
    lacking = cases.join(bmi.where(~F.col("_has_null_bmi")), "patient_id", "left_anti")
    measured = (
        with_codes(cat["clinical.flowsheet_measurements"], "measure_id", BODY_MEASURES)
        .join(cat["clinical.flowsheet_records"].drop("inpatient_data_id"), "flowsheet_document_id")
        .drop("flowsheet_document_id")
    )
    found = within_window(
        lacking, measured, "patient_id", "scheduled_start_time", "recorded_datetime", before=BEFORE_START
    )
    return lookup(found, cat["reference.flowsheet_measures"], "measure_id", ["measure_name"]).distinct()


# Report labels.
REPORTED = {
    "TIVA cohort": "analytics.tiva_cohort",
    "Airway-device documentation": "analytics.tiva_airway_devices",
    "Patient demographics": "analytics.tiva_demographics",
    "Problem-list diagnoses": "analytics.tiva_problem_list",
    "Medication administrations": "analytics.tiva_medication_administrations",
    "Vital signs": "analytics.tiva_vital_signs",
    "Propofol administrations": "analytics.tiva_propofol_administrations",
    "Propofol dose summaries": "analytics.tiva_propofol_dose_summary",
    "Body measurements": "analytics.tiva_body_measurements",
    "Supplemental body measurements": "analytics.tiva_missing_body_measurements",
}
PUBLISHED = SHARED | set(REPORTED.values())


def volume_report(cat: Catalog) -> DataFrame:
    """Volumes of the published datasets; the catalog must store them (``PUBLISHED``)."""
    return stored_report(cat, REPORTED, distinct="log_id")
