"""Hospital B: young-adult oncology patients found through oncology departments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from chartloom.functions.arrays import distinct_text
from chartloom.functions.dates import age_in_years, parse_dates, registry_date, whole_days
from chartloom.functions.text import blank_to_null, mapped
from chartloom.operators.cohorts import matching
from chartloom.operators.lookups import lookup, lookup_chain, normalize_codes, practice_location, prefer
from chartloom.operators.picks import down, first_per, spread_top, up
from chartloom.operators.privacy import limited_dataset
from chartloom.sources.catalog import Catalog

from .stages import Stages

STAGES = Stages()
SIDES = ["support", "treatment", "registry_dx", "visit_dx", "visits", "plans", "studies"]
SHARED = {
    "analytics_b.cancer_encounters",
    "analytics_b.cancer_patient_demographic",
    "analytics_b.cancer_combine_wo_dx_name",
    "analytics_b.fh_cancer_reporting",
    *(f"store_b.{side}" for side in SIDES),
}
BUCKETS = {stage: "pat_id" for stage in ("analytics_b.cancer_patient_demographic", *(f"store_b.{side}" for side in SIDES))}

# Input contracts.
CONTRACTS = {
    "source_b.grouper_compiled_rec_list": (
        "base_grouper_id string, grouper_records_varchar_id string, grouper_records_numeric_id string,"
        " compiled_context string, line int"
    ),
    "reference_b.clarity_dep": "department_id string, department_name string",
    "source_b.pat_enc": (
        "pat_id string, pat_enc_csn_id string, department_id string, appt_prc_id string, visit_prov_id string,"
        " appt_status_c int, contact_date date"
    ),
    "source_b.dm_cancer_patient": "pat_id string",
    "source_b.patient": (
        "pat_id string, patient_display_name string, birth_date date, sex_c string, city string, zip string,"
        " ethnic_group_c string, cur_pcp_prov_id string, adv_directive_yn string"
    ),
    "identity_b.patient_crosswalk": "pat_id string, site_b_patient_key string, patient_num string",
    "mortality_b.patient_death": "pat_id string, death_date date",
    "reference_b.clarity_ser": "prov_id string, prov_name string, prov_type string",
    "reference_b.zc_sex": "rcpt_mem_sex_c string, name string",
    "reference_b.zc_ethnic_group": "ethnic_group_c string, name string",
    "source_b.patient_race": "pat_id string, patient_race_c string, line int",
    "reference_b.zc_patient_race": "patient_race_c string, name string",
    "source_b.pat_acct_cvg": "pat_id string, payor_id string, line int, account_type_c string, account_active_yn string",
    "reference_b.clarity_epm": "payor_id string, payor_name string, financial_class string",
    "reference_b.clarity_fc": "financial_class string, financial_class_name string",
    "reference_b.d_prov_primary_hierarchy": "prov_id string, loc_name string",
    "reference_b.clarity_ser_addr": "prov_id string, line int, ext_practice_name string",
    "source_b.pat_enc_dx": "pat_enc_csn_id string, dx_id string, line int",
    "reference_b.clarity_edg": (
        "dx_id string, dx_name string, record_type_c string, current_icd10_list string, current_icd9_list string"
    ),
    "reference_b.clarity_prc": "prc_id string, prc_name string",
    "reference_b.edg_current_icd10": "dx_id string, code string",
    "reference_b.edg_current_icd9": "dx_id string, code string",
    "registry_b.fh_hb_naaccr_id": (
        "site_b_patient_key string, date_of_diagnosis_n390 string, primary_site_n400 string,"
        " secondary_diagnosis1_n3780 string, secondary_diagnosis2_n3782 string"
    ),
    "source_b.dm_cancer_problem": "pat_id string, problem_list_id string",
    "source_b.v_cancer_staging": (
        "problem_list_id string, most_recent_contact_yn string, sign_datetime timestamp_ntz, sign_user_id string"
    ),
    "reference_b.clarity_emp": "user_id string, name string",
    "source_b.enroll_info": "pat_id string, research_study_id string, enroll_end_dt date",
    "source_b.rsh_research_info": "research_id string, research_study_name string, study_type_c string",
    "source_b.v_onc_treatment_plan_orders": (
        "pat_id string, treatment_plan_id string, plan_name string, order_id string, plan_record_type_c string,"
        " order_category_name string, plan_created_datetime timestamp_ntz"
    ),
    "source_b.order_med": (
        "order_med_id string, pat_id string, medication_id string, med_route_c string, order_status_c string,"
        " ordering_date date"
    ),
    "source_b.mar_admin_info": "order_med_id string, mar_action_c string, taken_time timestamp_ntz",
    "reference_b.clarity_medication": "medication_id string, name string",
    "reference_b.grouper_med_recs": "exp_meds_list_id string, grouper_id string",
    "reference_b.zc_admin_route": "med_route_c string, name string",
    "source_b.order_proc": "order_proc_id string, pat_id string, pat_enc_csn_id string, proc_id string, ordering_date date",
    "source_b.order_results": "order_proc_id string, component_id string, ord_value string",
    "source_b.ord_spec_quest": "order_id string, ord_quest_id string, ord_quest_resp string, ord_quest_cmt string",
    "reference_b.cl_qquest": "quest_id string, quest_name string",
    "source_b.referral": (
        "referral_id string, pat_id string, prov_spec_c string, sched_status_c string, refd_to_dept_id string,"
        " entry_date date"
    ),
    "source_b.referral_px": "referral_id string, px_id string",
    "reference_b.clarity_eap": "proc_id string, proc_name string",
    "source_b.smrtdta_elem_data": "element_id string, pat_link_id string, hlv_id string, cur_value_datetime timestamp_ntz",
    "source_b.smrtdta_elem_value": "hlv_id string, smrtdta_elem_value string",
    "source_b.note_smarttext_ids": "note_id string, smarttexts_id string",
    "notes_b.hno_info": "note_id string, pat_id string, date_of_servic_dttm timestamp_ntz, update_date date",
    "notes_b.hno_note_text_comb": "note_id string, contact_date_real string, note_text_ts timestamp_ntz, note_text_comb string",
    "analytics_b.missing_icd": "icd_code string, description string",
}

# Code lists.
DEPARTMENT_GROUPERS = ["B0001", "B0002"]
EXCLUDED_DEPARTMENTS = ["B0003", "B0004"]
EXTRA_DEPARTMENTS = "B0005 B0006 B0007 B0008 B0009 B0010 B0011 B0012 B0013 B0014".split()
DIAGNOSIS_GROUPER = "B0015"
VISIT_STATUS = [2, 6]
VISIT_TYPES = [
    "CC GERIATRIC NEW", "CC HOSPITAL FOLLOW UP NEW", "CC LONG ESTABLISHED", "CC MS CA EST",
    "CC MS CA LONG ESTABLISHED", "CC MS CA NEW", "CC NEW", "EST STEM CELL", "ESTABLISHED",
    "HOSPITAL FOLLOW UP NEW", "LONG ESTABLISHED", "NEW", "POST OP", "TRANSPLANT EST PATIENT", "WEEKLY REVIEW",
    "WOUND ESTABLISHED", "BENIGN HEMATOLOGY ESTABLISHED", "BENIGN HEMATOLOGY LONG", "BENIGN HEMATOLOGY NEW",
    "CC GERIATRIC LONG ESTABLISHED", "HOSPITAL FOLLOW UP ESTABLISHED", "MYCHART URO ESTABLISHED PT",
    "MYCHART VIRTUAL VISIT", "TRANSPLANT NEW PATIENT", "VIRTUAL CHECK-IN (TELEPHONE)", "VIRTUAL VISIT",
]
CURRENT_DIAGNOSIS = "2"
UNUSABLE_LOCATIONS = ["*Unspecified Location", ""]
ORAL_GROUPER, ORAL_ROUTE, CANCELED = "B0017", "15", "4"
TREATMENT_PLAN, CHEMOTHERAPY, GIVEN = "1", "Chemotherapy", ["1", "6"]
RADIATION_START, RADIATION_END = "B0018", "B0019"
SOCIAL_WORK_QUESTION = "B0020"
PSYCHOLOGY_PROCEDURES = ["B0021"]
REPRODUCTIVE_SPECIALTY, GENETICS_SPECIALTY = "B0022", "B0023"
NUTRITION_PROCEDURES = ["B0024", "B0025"]
CHILD_LIFE_PROVIDER = "Child Life Specialist"
FERTILITY_ELEMENTS = ["EPIC#32168", "EPIC#31000234874", "EPIC#31000234867", "EPIC#31000204148"]
FERTILITY_TEMPLATES = ["B0026", "B0027", "B0028"]
FERTILITY_WANTED = "%Referral for assistance with fertility concerns desired by patient:%yes%"
FERTILITY_REFUSED = ["%deferred%", "%declined%", "%not clinically indicated%"]
PALLIATIVE_PROCEDURE = "B0029"
PALLIATIVE_QUESTIONS = ["B0030", "B0031", "B0032", "B0033", "B0034"]
STUDY_TYPES = {"B0035": "Interventional", "B0036": "Observational", "B0037": "Expanded Access"}


def _people(cat: Catalog, *columns: str) -> DataFrame:
    return cat["analytics_b.cancer_patient_demographic"].select("pat_id", *columns)


@STAGES("analytics_b.cancer_departments")
def cancer_departments(cat: Catalog) -> DataFrame:
    member = F.col("grouper_records_varchar_id")
    grouped = (
        cat["source_b.grouper_compiled_rec_list"]
        .where(F.col("base_grouper_id").isin(DEPARTMENT_GROUPERS) & ~member.isin(EXCLUDED_DEPARTMENTS))
        .select(member.alias("department_id"))
    )
    extra = cat["reference_b.clarity_dep"].where(F.col("department_id").isin(EXTRA_DEPARTMENTS))
    return grouped.union(extra.select("department_id")).distinct()


@STAGES("analytics_b.cancer_encounters")
def cancer_encounters(cat: Catalog) -> DataFrame:
    return cat["source_b.pat_enc"].join(cat["analytics_b.cancer_departments"], "department_id", "left_semi").distinct()


@STAGES("analytics_b.cancer_patient_demographic")
def cancer_patient_demographic(cat: Catalog) -> DataFrame:
    """Attributes of every patient seen in a cancer department and known to the cancer registry."""
    seen = cat["analytics_b.cancer_encounters"].select("pat_id").distinct()
    race = lookup(
        cat["source_b.patient_race"].where("line = 1"), cat["reference_b.zc_patient_race"], "patient_race_c",
        {"name": "primary_race"},
    )
    people = (
        cat["source_b.patient"]
        .join(seen, "pat_id", "left_semi")
        .join(cat["source_b.dm_cancer_patient"], "pat_id")
        .join(cat["identity_b.patient_crosswalk"].select("pat_id", "site_b_patient_key"), "pat_id")
        .join(race.select("pat_id", "primary_race"), "pat_id")
        .join(cat["mortality_b.patient_death"], "pat_id", "left")
        .join(
            cat["reference_b.zc_sex"].select(F.col("rcpt_mem_sex_c").alias("sex_c"), F.col("name").alias("sex")), "sex_c"
        )
    )
    people = lookup(people, cat["reference_b.zc_ethnic_group"], "ethnic_group_c", {"name": "ethnicity"})
    people = lookup(people, cat["reference_b.clarity_ser"], {"cur_pcp_prov_id": "prov_id"}, {"prov_name": "pcp"})
    people = people.select(
        "patient_display_name", "site_b_patient_key", "pat_id", "birth_date", "sex", "city", "zip", "primary_race",
        "ethnicity", "pcp", "cur_pcp_prov_id", "adv_directive_yn", "death_date",
    )

    coverage = cat["source_b.pat_acct_cvg"].where("account_type_c = '1' AND account_active_yn = 'Y'")
    coverage = first_per(coverage, ["pat_id"], [up("line"), up("payor_id")])
    coverage = lookup(coverage, cat["reference_b.clarity_epm"], "payor_id", ["payor_name", "financial_class"])
    coverage = lookup(coverage, cat["reference_b.clarity_fc"], "financial_class", ["financial_class_name"])
    people = people.join(coverage.select("pat_id", "payor_name", "financial_class_name"), "pat_id", "left")

    inside = cat["reference_b.d_prov_primary_hierarchy"].where(~F.col("loc_name").isin(UNUSABLE_LOCATIONS))
    outside = first_per(cat["reference_b.clarity_ser_addr"], ["prov_id"], [down("line"), up("ext_practice_name")])
    outside = outside.select("prov_id", "ext_practice_name")
    return practice_location(people, "cur_pcp_prov_id", inside, outside, blank_is_missing=True).distinct()


@STAGES("analytics_b.cancer_dx")
def cancer_dx(cat: Catalog) -> DataFrame:
    """First qualifying visit diagnosis of a patient, with up to two more of the same day.

    Positions run over the whole patient, so only the day of the first one can
    hold it; a first diagnosis without a code removes the patient.
    """
    listed = (
        cat["source_b.grouper_compiled_rec_list"]
        .where((F.col("base_grouper_id") == DIAGNOSIS_GROUPER) & (F.col("compiled_context") == "EDG"))
        .select(F.col("grouper_records_numeric_id").alias("dx_id"))
        .join(cat["reference_b.clarity_edg"].select("dx_id"), "dx_id")
    )
    visit_types = cat["reference_b.clarity_prc"].where(F.col("prc_name").isin(VISIT_TYPES))
    visits = (
        cat["analytics_b.cancer_encounters"]
        .where(F.col("appt_status_c").isin(VISIT_STATUS))
        .join(visit_types.select(F.col("prc_id").alias("appt_prc_id")), "appt_prc_id")
        .select("pat_id", "contact_date", "pat_enc_csn_id")
    )
    coded = visits.join(cat["source_b.pat_enc_dx"], "pat_enc_csn_id").join(listed, "dx_id")
    coded = lookup(coded, cat["reference_b.edg_current_icd10"], "dx_id", {"code": "_ten"})
    coded = lookup(coded, cat["reference_b.edg_current_icd9"], "dx_id", {"code": "_nine"})
    coded = coded.withColumn("code", F.coalesce("_ten", "_nine"))
    order = [up("contact_date"), up("line"), up("dx_id"), up("code"), up("pat_enc_csn_id")]
    top = first_per(coded, ["pat_id"], order, n=3, rank="row_rank")
    days = spread_top(top, ["pat_id", "contact_date"], "row_rank", {"code": "icd10_dx{n}"}, 3)
    return (
        days.where("icd10_dx1 IS NOT NULL")
        .groupBy("pat_id", "icd10_dx1", "icd10_dx2", "icd10_dx3")
        .agg(F.min("contact_date").alias("earliest_diagnosis_date"))
        .select("pat_id", "earliest_diagnosis_date", "icd10_dx1", "icd10_dx2", "icd10_dx3")
    )


def _registry(cat: Catalog, dedupe: bool) -> DataFrame:
    """Registry diagnoses with a readable date and dotted codes, ICD-10 before ICD-9.

    Six-digit dates are completed by option ``registry_day``.
    """
    current = cat["reference_b.clarity_edg"].where(F.col("record_type_c") == CURRENT_DIAGNOSIS).select("dx_id", "dx_name")

    def codes(table: str) -> DataFrame:
        return cat[table].join(current, "dx_id").select("code", "dx_name")

    rows = _people(cat, "site_b_patient_key").join(
        cat["registry_b.fh_hb_naaccr_id"].where("primary_site_n400 IS NOT NULL"), "site_b_patient_key"
    )
    day = registry_date(F.col("date_of_diagnosis_n390"), cat.option("registry_day", "01"))
    rows = rows.withColumn("formatted_date_of_diagnosis_n390", F.date_format(day, "yyyy-MM-dd"))
    return normalize_codes(
        rows,
        {
            "primary_site_n400": "primary_dx_code_10",
            "secondary_diagnosis1_n3780": "secondary1_dx_code_10",
            "secondary_diagnosis2_n3782": "secondary2_dx_code_10",
        },
        codes("reference_b.edg_current_icd10"),
        codes("reference_b.edg_current_icd9"),
        dedupe=dedupe,
    )


@STAGES("analytics_b.cancer_naaccr_dx_date")
def cancer_naaccr_dx_date(cat: Catalog) -> DataFrame:
    """A registry row repeats for every pair of code-table entries it matches, unless option ``dedupe``."""
    return _registry(cat, cat.option("dedupe", False))


@STAGES.ranked("analytics_b.cancer_prime_onc", "sign_datetime", ["primary_oncologist"], newest_first=True)
def cancer_prime_onc(cat: Catalog) -> DataFrame:
    staged = cat["source_b.v_cancer_staging"].where("most_recent_contact_yn = 'Y'")
    signers = cat["reference_b.clarity_emp"].select(F.col("user_id").alias("sign_user_id"), F.col("name").alias("primary_oncologist"))
    return (
        _people(cat)
        .join(cat["source_b.dm_cancer_problem"], "pat_id")
        .join(staged, "problem_list_id")
        .join(signers, "sign_user_id")
        .select("pat_id", "sign_datetime", "primary_oncologist")
    )


@STAGES("analytics_b.cancer_research_reporting")
def cancer_research_reporting(cat: Catalog) -> DataFrame:
    studies = cat["source_b.rsh_research_info"].withColumnRenamed("research_id", "research_study_id")
    return (
        _people(cat)
        .join(cat["source_b.enroll_info"], "pat_id")
        .join(studies, "research_study_id")
        .select("pat_id", "research_study_name", "study_type_c", "enroll_end_dt")
    )


@STAGES("analytics_b.cancer_treatment_plan_summary")
def cancer_treatment_plan_summary(cat: Catalog) -> DataFrame:
    """Distinct plans of a patient; the orders of a plan are folded before plans are counted."""
    orders = cat["source_b.v_onc_treatment_plan_orders"].where(F.col("plan_record_type_c") == TREATMENT_PLAN)
    shown = F.coalesce(blank_to_null(F.col("plan_name")), F.col("treatment_plan_id"))
    plans = (
        orders.join(_people(cat).distinct(), "pat_id", "left_semi")
        .groupBy("pat_id", "treatment_plan_id", shown.alias("_shown"))
        .agg(F.min("plan_created_datetime").alias("_created"))
    )
    return plans.groupBy("pat_id").agg(
        F.countDistinct("treatment_plan_id").alias("treatment_plan_count"),
        distinct_text(F.col("_shown"), "; ").alias("treatment_plan_names"),
        F.min("_created").cast("date").alias("first_treatment_plan_order_date"),
    )


@STAGES("analytics_b.cancer_oral_chemo_startdate")
def cancer_oral_chemo_startdate(cat: Catalog) -> DataFrame:
    therapies = (
        cat["reference_b.grouper_med_recs"]
        .where(F.col("grouper_id") == ORAL_GROUPER)
        .select(F.col("exp_meds_list_id").alias("medication_id"))
        .distinct()
    )
    names = cat["reference_b.clarity_medication"].withColumnRenamed("name", "medication_name")
    orders = (
        cat["source_b.order_med"]
        .where((F.col("order_status_c") != CANCELED) & (F.col("med_route_c") == ORAL_ROUTE))
        .join(therapies, "medication_id", "left_semi")
        .join(names, "medication_id")
        .join(_people(cat).distinct(), "pat_id", "left_semi")
    )
    orders = lookup(orders, cat["reference_b.zc_admin_route"], "med_route_c", {"name": "route"})
    first = first_per(orders, ["pat_id"], [up("ordering_date"), up("medication_name"), up("order_med_id")], rank="row")
    return first.select("pat_id", "ordering_date", "medication_name", "route", "row")


@STAGES("analytics_b.cancer_iv_chemo_startdate")
def cancer_iv_chemo_startdate(cat: Catalog) -> DataFrame:
    planned = (
        cat["source_b.v_onc_treatment_plan_orders"]
        .where((F.col("plan_record_type_c") == TREATMENT_PLAN) & (F.col("order_category_name") == CHEMOTHERAPY))
        .select("pat_id", F.col("order_id").alias("order_med_id"))
        .join(_people(cat).distinct(), "pat_id", "left_semi")
    )
    action = F.col("mar_action_c")
    given = cat["source_b.mar_admin_info"].where(action.isin(GIVEN) | action.isNull())
    doses = planned.join(given, "order_med_id").join(
        cat["source_b.order_med"].select("order_med_id", "medication_id"), "order_med_id"
    )
    doses = lookup(doses, cat["reference_b.clarity_medication"], "medication_id", {"name": "medication_name"})
    first = first_per(doses, ["pat_id"], [up("taken_time"), up("medication_name")], rank="row")
    return first.select("pat_id", F.col("taken_time").alias("start_date"), "medication_name", F.lit("IV").alias("route"), "row")


def _chemo_starts(cat: Catalog) -> DataFrame:
    oral = cat["analytics_b.cancer_oral_chemo_startdate"].withColumn("ordering_date", F.col("ordering_date").cast("timestamp_ntz"))
    return cat["analytics_b.cancer_iv_chemo_startdate"].union(oral).drop("row")


CHEMO_ORDER = ["start_date", "medication_name", "route"]


@STAGES("analytics_b.cancer_chemo_combine_startdate")
def cancer_chemo_combine_startdate(cat: Catalog) -> DataFrame:
    """At most one intravenous and one oral start per patient, stacked by position."""
    return first_per(_chemo_starts(cat), ["pat_id"], [up(c) for c in CHEMO_ORDER], n=2, rank="row")


def _radiation(cat: Catalog, component: str) -> DataFrame:
    results = cat["source_b.order_results"].where(F.col("component_id") == component)
    return (
        results.join(cat["source_b.order_proc"].select("order_proc_id", "pat_id"), "order_proc_id")
        .join(_people(cat).distinct(), "pat_id", "left_semi")
        .select("pat_id", parse_dates(F.col("ord_value")).alias("converted_date"), "ord_value")
        .distinct()
    )


@STAGES.ranked("analytics_b.cancer_rad_startdate", "converted_date", ["ord_value"], rank="row")
def cancer_rad_startdate(cat: Catalog) -> DataFrame:
    return _radiation(cat, RADIATION_START)


@STAGES.ranked("analytics_b.cancer_rad_enddate", "converted_date", ["ord_value"], newest_first=True, rank="row")
def cancer_rad_enddate(cat: Catalog) -> DataFrame:
    return _radiation(cat, RADIATION_END)


@STAGES.ranked("analytics_b.cancer_sw_referral_startdate", "ordering_date", ["sw_referral_response", "sw_referral_comment"])
def cancer_sw_referral_startdate(cat: Catalog) -> DataFrame:
    asked = cat["source_b.ord_spec_quest"].where(F.col("ord_quest_id") == SOCIAL_WORK_QUESTION)
    asked = asked.join(cat["reference_b.cl_qquest"].select(F.col("quest_id").alias("ord_quest_id")), "ord_quest_id")
    orders = cat["source_b.order_proc"].select(F.col("order_proc_id").alias("order_id"), "pat_id", "ordering_date")
    return (
        asked.join(orders, "order_id")
        .join(_people(cat).distinct(), "pat_id", "left_semi")
        .groupBy(
            "pat_id",
            "ordering_date",
            F.col("ord_quest_resp").alias("sw_referral_response"),
            F.col("ord_quest_cmt").alias("sw_referral_comment"),
        )
        .agg(F.max(F.when(F.col("ord_quest_id") == SOCIAL_WORK_QUESTION, "Y").otherwise("N")).alias("social_work_referral"))
    )


def _procedure_referrals(cat: Catalog, procedures: list[str]) -> DataFrame:
    wanted = cat["source_b.referral_px"].where(F.col("px_id").isin(procedures))
    names = cat["reference_b.clarity_eap"].withColumnRenamed("proc_id", "px_id")
    return (
        _people(cat, "site_b_patient_key")
        .join(cat["source_b.referral"], "pat_id")
        .join(wanted, "referral_id")
        .join(names, "px_id")
        .select("pat_id", "site_b_patient_key", "referral_id", "entry_date", "proc_name", "sched_status_c")
    )


def _specialty_referrals(cat: Catalog, specialty: str) -> DataFrame:
    referred = _people(cat, "site_b_patient_key").join(
        cat["source_b.referral"].where(F.col("prov_spec_c") == specialty), "pat_id"
    )
    referred = lookup(
        referred, cat["reference_b.clarity_dep"], {"refd_to_dept_id": "department_id"}, {"department_name": "department_name"}
    )
    columns = ["pat_id", "site_b_patient_key", "referral_id", "entry_date", "prov_spec_c", "sched_status_c", "department_name"]
    return referred.select(*columns).dropDuplicates(columns)


@STAGES.ranked("analytics_b.cancer_psych_referral_startdate", "entry_date", ["referral_id", "proc_name"])
def cancer_psych_referral_startdate(cat: Catalog) -> DataFrame:
    return _procedure_referrals(cat, PSYCHOLOGY_PROCEDURES)


@STAGES.ranked("analytics_b.cancer_reprod_referral_startdate", "entry_date", ["referral_id", "department_name"])
def cancer_reprod_referral_startdate(cat: Catalog) -> DataFrame:
    return _specialty_referrals(cat, REPRODUCTIVE_SPECIALTY)


@STAGES.ranked("analytics_b.cancer_genetics_referral_startdate", "entry_date", ["referral_id", "department_name"])
def cancer_genetics_referral_startdate(cat: Catalog) -> DataFrame:
    return _specialty_referrals(cat, GENETICS_SPECIALTY)


@STAGES.ranked("analytics_b.cancer_nutrition_referral_startdate", "entry_date", ["referral_id", "proc_name"])
def cancer_nutrition_referral_startdate(cat: Catalog) -> DataFrame:
    return _procedure_referrals(cat, NUTRITION_PROCEDURES)


@STAGES.ranked("analytics_b.cancer_childlife_startdate", "child_life_contact_date", ["site_b_patient_key"])
def cancer_childlife_startdate(cat: Catalog) -> DataFrame:
    specialists = (
        cat["reference_b.clarity_ser"]
        .where(F.col("prov_type") == CHILD_LIFE_PROVIDER)
        .select(F.col("prov_id").alias("visit_prov_id"))
    )
    return (
        cat["source_b.pat_enc"]
        .join(specialists, "visit_prov_id")
        .join(_people(cat, "site_b_patient_key"), "pat_id")
        .select("pat_id", "site_b_patient_key", F.col("contact_date").alias("child_life_contact_date"))
    )


@STAGES("analytics_b.cancer_fertility_sde")
def cancer_fertility_sde(cat: Catalog) -> DataFrame:
    stored = cat["source_b.smrtdta_elem_data"].where(F.col("element_id").isin(FERTILITY_ELEMENTS))
    return (
        stored.join(_people(cat).withColumnRenamed("pat_id", "pat_link_id"), "pat_link_id")
        .join(cat["source_b.smrtdta_elem_value"], "hlv_id")
        .select("element_id", "cur_value_datetime", "pat_link_id", "smrtdta_elem_value")
    )


@STAGES("analytics_b.cancer_fertility_stxt_note")
def cancer_fertility_stxt_note(cat: Catalog) -> DataFrame:
    """Notes written from the given templates; texts are joined last."""
    templated = cat["source_b.note_smarttext_ids"].where(F.col("smarttexts_id").isin(FERTILITY_TEMPLATES))
    return (
        templated.join(cat["notes_b.hno_info"], "note_id")
        .join(_people(cat), "pat_id")
        .join(cat["notes_b.hno_note_text_comb"], "note_id")
        .select(
            "smarttexts_id", "pat_id", "date_of_servic_dttm", "update_date", "contact_date_real", "note_text_ts",
            "note_text_comb",
        )
    )


@STAGES.ranked("analytics_b.cancer_fertility_combine", "fertility_referral_date")
def cancer_fertility_combine(cat: Catalog) -> DataFrame:
    noted = matching(cat["analytics_b.cancer_fertility_stxt_note"], "note_text_comb", include=[FERTILITY_WANTED])
    accepted = matching(cat["analytics_b.cancer_fertility_sde"], "smrtdta_elem_value", exclude=FERTILITY_REFUSED)
    both = noted.select("pat_id", F.col("date_of_servic_dttm").alias("fertility_referral_date")).union(
        accepted.select("pat_link_id", "cur_value_datetime")
    )
    return _people(cat).join(both, "pat_id")


@STAGES.ranked("analytics_b.cancer_palliative_care", "ordering_date")
def cancer_palliative_care(cat: Catalog) -> DataFrame:
    orders = (
        _people(cat)
        .join(cat["source_b.order_proc"].where(F.col("proc_id") == PALLIATIVE_PROCEDURE), "pat_id")
        .select("pat_id", "ordering_date", F.col("order_proc_id").alias("order_id"))
    )
    answered = cat["source_b.ord_spec_quest"].where(
        F.col("ord_quest_id").isin(PALLIATIVE_QUESTIONS) & F.col("ord_quest_resp").isNotNull()
    )
    answered = lookup(answered, cat["reference_b.cl_qquest"], {"ord_quest_id": "quest_id"}, ["quest_name"])
    return orders.join(answered, "order_id").select("pat_id", "ordering_date")


# Supportive-care stages and the name their first date takes in the patient model.
SUPPORT = {
    "analytics_b.cancer_nutrition_referral_startdate": "nutrition_referral_date",
    "analytics_b.cancer_childlife_startdate": "child_life_referral_date",
    "analytics_b.cancer_reprod_referral_startdate": "reproductive_med_referral_date",
    "analytics_b.cancer_sw_referral_startdate": "social_work_referral_date",
    "analytics_b.cancer_genetics_referral_startdate": "genetics_referral_date",
    "analytics_b.cancer_psych_referral_startdate": "psychology_referral_date",
    "analytics_b.cancer_fertility_combine": "fertility_referral_date",
    "analytics_b.cancer_palliative_care": "palliative_care_referral_date",
}
PATIENT = (
    "pat_id patient_display_name number_of_visits site_b_patient_key birth_date sex primary_race ethnicity city zip"
    " death_date pcp pcp_location pcp_location_type financial_class_name diagnosis_date patient_age_at_diagnosis"
    " dx_1_code dx_2_code dx_3_code primary_oncologist"
).split()
PLANS = "treatment_plan_count treatment_plan_names first_treatment_plan_order_date".split()
TREATMENT = ["chemo_start_date", "chemo_route_type", "radiation_start_date", *SUPPORT.values()]


# The patient store: one row per patient and domain (a row per study for studies), kept in buckets of the patient.


@STAGES("store_b.visits")
def visits(cat: Catalog) -> DataFrame:
    seen = cat["analytics_b.cancer_encounters"].where("pat_id IS NOT NULL")
    return seen.groupBy("pat_id").agg(F.countDistinct("pat_enc_csn_id").alias("number_of_visits"))


@STAGES("store_b.registry_dx")
def registry_dx(cat: Catalog) -> DataFrame:
    """First registry diagnosis; the pick takes the smallest codes, which the folded code tables hold already."""
    stage, codes = "analytics_b.cancer_naaccr_dx_date", ["primary_dx_code_10", "secondary1_dx_code_10", "secondary2_dx_code_10"]
    dated = "formatted_date_of_diagnosis_n390"
    rows = cat[stage] if cat.is_stored(stage) else _registry(cat, dedupe=True)
    return first_per(rows.select("pat_id", dated, *codes), ["pat_id"], [up(c) for c in (dated, *codes)])


@STAGES("store_b.visit_dx")
def visit_dx(cat: Catalog) -> DataFrame:
    return first_per(cat["analytics_b.cancer_dx"], ["pat_id"], [up("earliest_diagnosis_date"), up("icd10_dx1")])


@STAGES("store_b.treatment")
def treatment(cat: Catalog) -> DataFrame:
    """First oncologist, chemotherapy and radiation of a patient."""
    oncologist = STAGES.first(cat, "analytics_b.cancer_prime_onc").select(
        "pat_id", "primary_oncologist", F.lit(True).alias("_has_oncologist")
    )
    chemo = first_per(_chemo_starts(cat), ["pat_id"], [up(c) for c in CHEMO_ORDER]).select(
        "pat_id", F.col("start_date").alias("chemo_start_date"), F.col("route").alias("chemo_route_type")
    )
    radiation = STAGES.first(cat, "analytics_b.cancer_rad_startdate").select(
        "pat_id", F.col("ord_value").alias("radiation_start_date")
    )
    return oncologist.join(chemo, "pat_id", "full").join(radiation, "pat_id", "full")


@STAGES("store_b.support")
def support(cat: Catalog) -> DataFrame:
    """First dates of all supportive-care stages, from one reading of each source.

    A stage's first row holds its smallest date, so every source gives a row of dates per record,
    null where the record belongs to no stage, and one aggregate takes the smallest.
    """
    patients = _people(cat).distinct()
    named = cat["reference_b.clarity_eap"].select(F.col("proc_id").alias("px_id")).distinct()
    ordered = cat["source_b.referral_px"].where(F.col("px_id").isin(PSYCHOLOGY_PROCEDURES + NUTRITION_PROCEDURES))
    referrals = cat["source_b.referral"].join(patients, "pat_id", "left_semi")
    referrals = referrals.join(ordered.join(named, "px_id", "left_semi").select("referral_id", "px_id"), "referral_id", "left")
    referred = {
        "psychology_referral_date": F.col("px_id").isin(PSYCHOLOGY_PROCEDURES),
        "nutrition_referral_date": F.col("px_id").isin(NUTRITION_PROCEDURES),
        "reproductive_med_referral_date": F.col("prov_spec_c") == REPRODUCTIVE_SPECIALTY,
        "genetics_referral_date": F.col("prov_spec_c") == GENETICS_SPECIALTY,
    }

    question, answered = F.col("ord_quest_id"), F.col("ord_quest_resp").isNotNull()
    social = question == SOCIAL_WORK_QUESTION
    palliative = question.isin(PALLIATIVE_QUESTIONS) & answered
    known = cat["reference_b.cl_qquest"].select(F.col("quest_id").alias("ord_quest_id"), F.lit(True).alias("_known")).distinct()
    asked = cat["source_b.ord_spec_quest"].where(social | palliative).withColumnRenamed("order_id", "order_proc_id")
    asked = asked.select("order_proc_id", "ord_quest_id", "ord_quest_resp").distinct().join(known, "ord_quest_id", "left")
    orders = cat["source_b.order_proc"].join(patients, "pat_id", "left_semi").join(asked, "order_proc_id")
    procedures = {
        "social_work_referral_date": social & F.col("_known"),
        "palliative_care_referral_date": palliative & (F.col("proc_id") == PALLIATIVE_PROCEDURE),
    }

    def dated(rows: DataFrame, day: str, when: dict) -> DataFrame:
        moment = F.col(day).cast("timestamp_ntz")
        nothing = F.lit(None).cast("timestamp_ntz")
        return rows.select("pat_id", *[(F.when(when[n], moment) if n in when else nothing).alias(n) for n in SUPPORT.values()])

    def published(name: str, rows) -> DataFrame:
        return cat[name] if cat.is_stored(name) else rows(cat)

    always = F.lit(True)
    rows = [
        dated(referrals, "entry_date", referred),
        dated(orders, "ordering_date", procedures),
        dated(published("analytics_b.cancer_childlife_startdate", cancer_childlife_startdate), "child_life_contact_date", {"child_life_referral_date": always}),
        dated(published("analytics_b.cancer_fertility_combine", cancer_fertility_combine), "fertility_referral_date", {"fertility_referral_date": always}),
    ]
    return reduce(DataFrame.union, rows).groupBy("pat_id").agg(*[F.min(n).alias(n) for n in SUPPORT.values()])


@STAGES("store_b.plans")
def plans(cat: Catalog) -> DataFrame:
    return cat["analytics_b.cancer_treatment_plan_summary"].where("pat_id IS NOT NULL")


@STAGES("store_b.studies")
def studies(cat: Catalog) -> DataFrame:
    kind = mapped(F.col("study_type_c"), STUDY_TYPES).alias("study_type")
    return cat["analytics_b.cancer_research_reporting"].select("pat_id", kind, "research_study_name").distinct()


@STAGES("analytics_b.cancer_combine_wo_dx_name")
def cancer_combine_wo_dx_name(cat: Catalog) -> DataFrame:
    """Patient by study: everything known about a patient, each domain cut to its first row.

    All sides are kept in buckets of the patient, so the joins need no shuffle. The registry
    diagnosis replaces the visit diagnosis as a whole when it has both a date and a code. The
    child-life date is reached through the oncologist, so patients without one lack it; option
    ``child_life_needs_oncologist=False`` uses the patient instead.
    """
    dated = F.col("formatted_date_of_diagnosis_n390")
    people = "analytics_b.cancer_patient_demographic"
    cat.keep(BUCKETS)
    full = cat[people].join(cat["store_b.visits"], "pat_id")
    for side in ("registry_dx", "visit_dx", "treatment", "support"):
        full = full.join(cat[f"store_b.{side}"], "pat_id", "left")
    for name in SUPPORT.values():
        kept = F.col(name) if name == "fertility_referral_date" else F.col(name).cast("date")
        if name == "child_life_referral_date" and cat.option("child_life_needs_oncologist", True):
            kept = F.when(F.col("_has_oncologist"), kept)
        full = full.withColumn(name, kept)
    full = full.join(cat["store_b.plans"], "pat_id", "left").join(cat["store_b.studies"], "pat_id", "left")

    chosen = prefer(
        dated.isNotNull() & F.col("primary_dx_code_10").isNotNull(),
        {
            "day": dated,
            "one": F.col("primary_dx_code_10"),
            "two": F.col("secondary1_dx_code_10"),
            "three": F.col("secondary2_dx_code_10"),
        },
        {
            "day": F.col("earliest_diagnosis_date").cast("string"),
            "one": F.col("icd10_dx1"),
            "two": F.col("icd10_dx2"),
            "three": F.col("icd10_dx3"),
        },
        "_dx",
    )
    full = full.withColumn("_dx", chosen).withColumns(
        {
            "diagnosis_date": F.col("_dx.day"),
            "patient_age_at_diagnosis": age_in_years(whole_days(F.col("birth_date"), F.col("_dx.day").cast("date"))),
            "dx_1_code": F.col("_dx.one"),
            "dx_2_code": F.col("_dx.two"),
            "dx_3_code": F.col("_dx.three"),
        }
    )
    return full.select(*PATIENT, "study_type", "research_study_name", *PLANS, *TREATMENT).distinct()


@STAGES("analytics_b.fh_cancer_reporting")
def fh_cancer_reporting(cat: Catalog) -> DataFrame:
    """Reporting model: named diagnoses and study counts for the chosen ages and dates.

    Options ``min_age``, ``max_age`` and ``since`` set the population. A code
    with several names yields several rows unless option ``dedupe``.
    """
    age = F.col("patient_age_at_diagnosis")
    people = cat["analytics_b.cancer_combine_wo_dx_name"].where(
        (age >= cat.option("min_age", 15))
        & (age < cat.option("max_age", 50))
        & (F.col("diagnosis_date").cast("date") >= F.lit(cat.option("since", "2015-01-01")).cast("date"))
    )
    # A patient's few distinct studies are gathered from the study rows, then counted inside the row.
    name, kind = F.col("research_study_name"), mapped(F.col("study_type_c"), STUDY_TYPES)
    one = F.struct(name.alias("name"), F.coalesce(kind, F.lit("Other")).alias("kind"))
    gathered = cat["analytics_b.cancer_research_reporting"].where(name.isNotNull()).groupBy("pat_id").agg(F.collect_set(one).alias("_studies"))
    people = people.select(*PATIENT, *TREATMENT).distinct().join(gathered, "pat_id", "left")
    people = people.withColumn("_studies", F.coalesce("_studies", F.array().cast(gathered.schema["_studies"].dataType)))

    def count(kind: str | None = None):
        rows = F.col("_studies") if kind is None else F.filter("_studies", lambda s: s["kind"] == kind)
        return F.size(F.array_distinct(F.transform(rows, lambda s: s["name"]))).cast("long")

    def joined(field: str):
        values = F.array_sort(F.array_distinct(F.transform("_studies", lambda s: s[field])))
        return F.when(F.size("_studies") > 0, F.array_join(values, " | "))

    people = people.withColumns(
        {
            "research_study_total_count": count(),
            "interventional_study_count": count("Interventional"),
            "expanded_access_study_count": count("Expanded Access"),
            "observational_study_count": count("Observational"),
            "other_study_count": count("Other"),
            "research_study_name": joined("name"),
            "study_type": joined("kind"),
        }
    ).drop("_studies")
    terms = cat["reference_b.clarity_edg"].where(F.col("record_type_c") == CURRENT_DIAGNOSIS)
    names = {f"dx_{i}_code": f"dx_{i}_name" for i in (1, 2, 3)}
    named = lookup_chain(
        people,
        names,
        [
            terms.select(F.col("current_icd10_list").alias("code"), F.col("dx_name").alias("name")),
            terms.select("current_icd9_list", "dx_name"),
            cat["analytics_b.missing_icd"],
        ],
        dedupe=cat.option("dedupe", False),
    )
    studies = [c for c in people.columns if c.endswith("_study_count") or c == "research_study_total_count"]
    return named.select(*PATIENT, *names.values(), *studies, "research_study_name", "study_type", *TREATMENT)


# Columns released under the surrogate number.
RELEASED = (
    "number_of_visits birth_date sex primary_race ethnicity city zip death_date pcp pcp_location financial_class_name"
    " diagnosis_date dx_1_code dx_1_name dx_2_code dx_2_name dx_3_code dx_3_name primary_oncologist study_type"
).split() + TREATMENT


@STAGES("analytics_b.fh_lds_cancer_reporting")
def fh_lds_cancer_reporting(cat: Catalog) -> DataFrame:
    return limited_dataset(
        cat["analytics_b.fh_cancer_reporting"], cat["identity_b.patient_crosswalk"], "pat_id", "patient_num", RELEASED
    )
