"""Datasets on small clinical tables with hand-computed results, and storage."""

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from chartloom.operators.reports import qa_report
from chartloom.plans import broker, preop, site_a, site_b, tiva
from chartloom.sources.catalog import Catalog, table_sources
from chartloom.sources.sinks import ParquetSink, TableSink, ViewSink, shared_workspace

from plan_text import plan_of


def catalog(spark, module, tables, store=None, **options):
    """Catalog whose missing inputs are empty tables of the declared shape; ``store`` is a folder for published datasets."""

    def source(name):
        if name in tables:
            data, columns = tables[name]
            return spark.createDataFrame(data, columns)
        if name in module.CONTRACTS:
            return spark.createDataFrame([], module.CONTRACTS[name])
        return None

    if store is None:
        return Catalog(spark, source, module.STAGES, module.CONTRACTS, options)
    return Catalog(spark, source, module.STAGES, module.CONTRACTS, options, shared=module.PUBLISHED, workspace=ParquetSink(spark, str(store)))


START = datetime(2020, 5, 1, 8)
TIVA_TABLES = {
    "analytics.surgical_candidate_cohort": (
        [(f"p{i}", str(10 * i), str(10 * i + 1), f"c{i}", f"l{i}", START, "GA") for i in range(1, 6)],
        "patient_id string, admission_encounter_id string, surgery_encounter_id string, case_id string, log_id string,"
        " scheduled_start_time timestamp_ntz, anesthesia_types string",
    ),
    # ids arrive as numbers here and as text elsewhere
    "clinical.surgical_encounter_map": (
        [(11, 12, 12), (21, 22, 23), (31, 32, None), (41, 42, None), (51, 52, None)],
        "surgery_encounter_id int, primary_anesthesia_encounter_id int, secondary_anesthesia_encounter_id int",
    ),
    "clinical.encounters": (
        [("12", "i1"), ("22", "i2"), ("23", "j2"), ("32", "i3"), ("42", "i4"), ("52", "i5")],
        "encounter_id string, inpatient_data_id string",
    ),
    "clinical.flowsheet_records": ([("i3", "f3", "p3"), ("i1", "f1", "p1")], "inpatient_data_id string, flowsheet_document_id string, patient_id string"),
    "clinical.flowsheet_measurements": (
        [
            ("f3", "VOLATILE_AGENT_CONCENTRATION_2", "1.5", START),
            ("f1", "VOLATILE_AGENT_CONCENTRATION_1", "0", START),
            ("f1", "VOLATILE_AGENT_CONCENTRATION_1", "", START),
            ("f1", "HEART_RATE", "80", START),
            ("f1", "BODY_MASS_INDEX", "31", datetime(2020, 4, 29, 8)),
            ("f1", "BODY_MASS_INDEX", "30", datetime(2020, 4, 29, 7)),
        ],
        "flowsheet_document_id string, measure_id string, measure_value string, recorded_datetime timestamp_ntz",
    ),
    "clinical.patient_vitals": (
        [("p1", "11", START, None), ("p2", "21", START, Decimal(25)), ("p2", "21", datetime(2020, 4, 28), Decimal(99))],
        "patient_id string, encounter_id string, measurement_date timestamp_ntz, bmi decimal(12,3)",
    ),
}


def _medication(rows):
    fixed = {"medication_order_id": None}
    columns = ["encounter_id", *tiva.MEDICATION_TEXT]
    out = []
    for encounter, code, name, dose, unit in rows:
        known = {"encounter_id": encounter, "medication_id": code, "medication_name": name, "administered_dose": dose, "dose_unit": unit}
        out.append(tuple({**dict.fromkeys(columns), **fixed, **known}[c] for c in columns))
    return out, tiva.CONTRACTS["clinical.medication_administration"]


@pytest.fixture(scope="module")
def tiva_tables():
    doses = [
        ("12", "PROPOFOL_10MG_ML", "propofol inj", "10.5", "mg"),
        ("12", "PROPOFOL_10MG_ML", "Propofol inj", "", "mL"),
        ("22", "PROPOFOL_500MG_50ML", "PROPOFOL", "4", "mL"),
        ("22", "OTHER", "PROPOFOL", "1", "mL"),
        ("32", "PROPOFOL_10MG_ML", "propofol", "5", "mg"),
        ("42", "PROPOFOL_10MG_ML", "propofol", "0", "mg"),
        ("52", "PROPOFOL_10MG_ML", "propofol", "unknown", "mg"),
        ("012", "KETAMINE", "Ketamine", "3", "mg"),
    ]
    vitals = TIVA_TABLES["clinical.patient_vitals"]
    columns = ["patient_id", "encounter_id", "measurement_date", *tiva.BODY]
    full = [tuple({**dict.fromkeys(columns), "patient_id": a, "encounter_id": b, "measurement_date": c, "bmi": d}[x] for x in columns) for a, b, c, d in vitals[0]]
    return {
        **TIVA_TABLES,
        "clinical.medication_administration": _medication(doses),
        "clinical.patient_vitals": (full, tiva.CONTRACTS["clinical.patient_vitals"]),
    }


def test_tiva_cohort(spark, tiva_tables):
    """Equal encounters match once, a second encounter adds a row; gas, zero and unreadable doses exclude."""
    cat = catalog(spark, tiva, tiva_tables)
    got = sorted((r.log_id, r.inpatient_data_id) for r in cat["analytics.tiva_cohort"].collect())
    assert got == [("l1", "i1"), ("l2", "i2"), ("l2", "j2")]


def test_tiva_totals_double_unless_deduped(spark, tiva_tables):
    name = "propofol_500mg_50ml_total_dose"
    written = {r.log_id: r for r in catalog(spark, tiva, tiva_tables)["analytics.tiva_propofol_dose_summary"].collect()}
    once = {r.log_id: r for r in catalog(spark, tiva, tiva_tables, dedupe=True)["analytics.tiva_propofol_dose_summary"].collect()}
    assert written["l2"][name] == Decimal(8) and once["l2"][name] == Decimal(4)
    assert written["l1"]["propofol_10mg_ml_total_dose"] == Decimal("10.5") and written["l1"]["propofol_10mg_ml_dose_unit"] == "mg"
    assert written["l1"][name] == 0 and written["l1"]["propofol_500mg_50ml_dose_unit"] is None


def test_tiva_roles_with_several_encounters_keep_distinct_rows(spark, tiva_tables):
    """Equal rows of a role are one, also from several encounters; a role with one encounter needs no shuffle by row."""
    case = ("p", "10", "11", "c", "l", START, "GA")
    shape = tiva.CONTRACTS["analytics.surgical_candidate_cohort"] + (
        ", primary_anesthesia_encounter_id string, secondary_anesthesia_encounter_id string, inpatient_data_id string"
    )
    tables = {
        "analytics.tiva_cohort": ([case + ("12", "13", "I"), case + ("14", "13", "J")], shape),
        "clinical.medication_administration": _medication([("12", "A", "a", "1", "mg"), ("14", "A", "a", "1", "mg"), ("13", "B", "b", "1", "mg"), ("013", "B", "b", "1", "mg"), ("14", "C", "c", "1", "mg")]),
    }
    out = catalog(spark, tiva, tables)["analytics.tiva_medication_administrations"]
    got = sorted((r.medication_encounter_type.split()[0], r.medication_id) for r in out.collect())
    assert got == [("Primary", "A"), ("Primary", "C"), ("Secondary", "B")]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(out.select("*"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    by_row = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and any(c in line for c in tiva.MEDICATION_TEXT)]
    assert len(by_row) < plan.count("SortMergeJoin")


def test_tiva_medications_by_role(spark, tiva_tables):
    got = catalog(spark, tiva, tiva_tables)["analytics.tiva_medication_administrations"].collect()
    ketamine = [r.medication_encounter_type for r in got if r.medication_id == "KETAMINE"]
    assert sorted(ketamine) == ["Primary anesthesia encounter", "Secondary anesthesia encounter"]


def test_tiva_missing_body_measurements(spark, tiva_tables):
    """A null BMI still counts as missing; only the last 48 hours qualify, ends included."""
    got = catalog(spark, tiva, tiva_tables)["analytics.tiva_missing_body_measurements"].collect()
    assert [(r.patient_id, r.measure_value) for r in got] == [("p1", "31")]


def test_tiva_report_counts(spark, tiva_tables, tmp_path):
    """Rows as counted while they were written; cases from one aggregate over stored columns, sources are not read."""
    cat = catalog(spark, tiva, tiva_tables, store=tmp_path)
    lines = tiva.volume_report(cat)
    assert "LocalTableScan" not in plan_of(lines).split("Aggregate")[-1] and plan_of(lines).count("Scan parquet") == 10
    report = {r.dataset: (r.record_count, r.distinct_case_count) for r in lines.collect()}
    assert report["TIVA cohort"] == (3, 2) and len(report) == 10
    plain = qa_report({label: cat[name] for label, name in tiva.REPORTED.items()}, distinct="log_id")
    assert {tuple(r) for r in plain.collect()} == {(d, *c) for d, c in report.items()}


def test_preop_visit_repeats_per_specialty_row(spark, tmp_path):
    visits = preop.CONTRACTS["clinical.encounters"]
    names = [c.strip().split()[0] for c in visits.replace("(9,3)", "").split(",")]
    known = {"patient_id": "p", "encounter_id": "e", "department_name": "PREOPERATIVE CLINIC", "visit_type_name": "NEW", "visit_date": date(2020, 1, 1), "visit_provider_id": "d"}
    rows = [tuple({**dict.fromkeys(names), **known, **change}[c] for c in names) for change in ({}, {"visit_type_name": None}, {"department_name": "WARD"})]
    tables = {
        "clinical.encounters": (rows, visits),
        "analytics.study_cohort": ([("p",)], "patient_id string"),
        "reference.provider_specialties": ([("d", "ANESTHESIOLOGY"), ("d", "ANESTHESIOLOGY"), ("d", "X")], "provider_id string, specialty_code string"),
    }
    cat = catalog(spark, preop, tables, store=tmp_path)
    assert cat["analytics.preop_encounters"].count() == 2
    report = preop.volume_report(cat)
    assert "Scan parquet" not in plan_of(report) and dict(map(tuple, report.collect()))["Preoperative encounters"] == 2


def test_case_model_fans_out_unless_deduped(spark):
    case = {"patient_id": "p", "surgical_case_id": "k", "surgical_log_id": "l", "surgical_encounter_id": "s", "anesthesia_encounter_id": "n", "status_code": None}
    names = [c.strip().split()[0] for c in broker.CONTRACTS["source_ehr.surgical_cases"].split(",")]
    voided = {**case, "surgical_case_id": "k2", "status_code": "VOIDED"}
    tables = {
        "source_ehr.surgical_cases": ([tuple({**dict.fromkeys(names), **c}[n] for n in names) for c in (case, voided)], broker.CONTRACTS["source_ehr.surgical_cases"]),
        "research_build.patient_crosswalk": ([("p", "R", "M")], "patient_id string, research_patient_number string, medical_record_number string"),
        "research_build.encounter_crosswalk": ([("s", "m", "se")], broker.CONTRACTS["research_build.encounter_crosswalk"]),
        "source_ehr.anesthesia_events": ([("e1", "INDUCTION", START), ("e2", "INDUCTION", START)], broker.CONTRACTS["source_ehr.anesthesia_events"]),
        "source_ehr.anesthesia_event_patients": ([("e1", "p", "n"), ("e2", "q", "n")], broker.CONTRACTS["source_ehr.anesthesia_event_patients"]),
        "source_ehr.surgical_case_staff": ([("l", "1", "d1", 2), ("l", "1", "gone", 1), ("l", None, "d1", 3)], broker.CONTRACTS["source_ehr.surgical_case_staff"]),
        "reference.surgical_staff_roles": ([("1", "Primary")], "role_code string, role_name string"),
        "reference.providers": ([("d1", "Dr One")], "provider_id string, provider_name string"),
    }
    name = "research_access.identified_surgical_cases"
    got = catalog(spark, broker, tables)[name].collect()
    assert len(got) == 2 and {r.surgical_case_id for r in got} == {"k"}
    assert got[0].primary_surgeons == [None, "Dr One"] and got[0].primary_surgeons_display == "Dr One"
    assert got[0].all_surgeon_roles == ["Primary", "Primary", None] and got[0].surgical_fellows is None
    assert catalog(spark, broker, tables, dedupe=True)[name].count() == 1
    hidden = catalog(spark, broker, tables)["research_access.deidentified_surgical_cases"]
    assert not {"patient_identifier", "primary_surgeons", "procedure_display_names"} & set(hidden.columns)


CASE_NAMES = [c.strip().split()[0] for c in broker.CONTRACTS["source_ehr.surgical_cases"].split(",")]


def _cases_of_logs(**more):
    """Three cases: of a log, of the same log, and of none."""
    ids = [("k1", "l"), ("k2", "l"), ("k3", None)]
    rows = [{"patient_id": "p", "surgical_encounter_id": "s", "surgical_case_id": k, "surgical_log_id": log, "anesthesia_encounter_id": "n"} for k, log in ids]
    contract = broker.CONTRACTS
    return {
        "source_ehr.surgical_cases": ([tuple({**dict.fromkeys(CASE_NAMES), **r}[n] for n in CASE_NAMES) for r in rows], contract["source_ehr.surgical_cases"]),
        "research_build.patient_crosswalk": ([("p", "R", "M")], "patient_id string, research_patient_number string, medical_record_number string"),
        "research_build.encounter_crosswalk": ([("s", "m", "se")], contract["research_build.encounter_crosswalk"]),
        "source_ehr.anesthesia_events": ([("e", "INDUCTION", START)], contract["source_ehr.anesthesia_events"]),
        "source_ehr.anesthesia_event_patients": ([("e", "p", "n")], contract["source_ehr.anesthesia_event_patients"]),
        "source_ehr.anesthesia_case_staff": ([("k3", "1", "d1", 1), (None, "1", "d1", 1)], contract["source_ehr.anesthesia_case_staff"]),
        "source_ehr.surgical_case_staff": ([("l", "1", "d1", 2), (None, "1", "d1", 2)], contract["source_ehr.surgical_case_staff"]),
        "source_ehr.surgical_log_procedures": ([("l", "x", "X", None, 1), (None, "x", "X", None, 1)], contract["source_ehr.surgical_log_procedures"]),
        "reference.surgical_procedures": ([("x", "Excision")], contract["reference.surgical_procedures"]),
        "reference.anesthesia_staff_roles": ([("1", "CRNA")], contract["reference.anesthesia_staff_roles"]),
        "reference.providers": ([("d1", "Dee")], "provider_id string, provider_name string"),
        **more,
    }


def test_cases_without_a_log_keep_their_staff_and_have_no_procedures(spark):
    got = {r.surgical_case_id: r for r in catalog(spark, broker, _cases_of_logs())[broker.CASES].collect()}
    assert {k: r.procedure_names for k, r in got.items()} == {"k1": ["Excision"], "k2": ["Excision"], "k3": None}
    assert {k: r.all_surgeons for k, r in got.items()} == {"k1": ["Dee"], "k2": ["Dee"], "k3": None}
    assert {k: r.crnas for k, r in got.items()} == {"k1": None, "k2": None, "k3": ["Dee"]}
    assert {r.induction_datetime for r in got.values()} == {START}


def test_published_rollups_are_read_by_the_case_model(spark):
    staff = catalog(spark, broker, _cases_of_logs())
    names = ("temp_procedure_rollup", "temp_surgeon_rollup", "temp_anesthesia_staff_rollup")
    rows = {n: ([r.asDict() for r in staff[n].collect()], staff[n].schema) for n in names}
    for part, column in zip(rows.values(), ("procedure_names", "all_surgeons", "crnas")):
        for r in part[0]:
            r[column] = ["other"]
    got = {r.surgical_case_id: r for r in catalog(spark, broker, _cases_of_logs(**rows))[broker.CASES].collect()}
    assert {k: r.procedure_names for k, r in got.items()} == {"k1": ["other"], "k2": ["other"], "k3": None}
    assert {k: (r.all_surgeons, r.crnas) for k, r in got.items()} == {"k1": (["other"], None), "k2": (["other"], None), "k3": (None, ["other"])}


def test_the_case_model_shuffles_no_side_of_a_log_when_it_is_read(spark):
    """Its sides were stored one after the other, each with its own shuffles, which are gone by then."""
    for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
        spark.conf.set(setting, "-1")
    try:
        plan = plan_of(catalog(spark, broker, _cases_of_logs())[broker.CASES])
    finally:
        for setting in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"):
            spark.conf.unset(setting)
    assert "Exchange" not in plan and plan.count("SortMergeJoin") == 3


def test_hidden_cases_and_their_numbers_need_no_staff_rollups(spark, monkeypatch):
    """Ids come from the known cases; a model that is stored is still read instead."""
    names = [c.strip().split()[0] for c in broker.CONTRACTS["source_ehr.surgical_cases"].split(",")]
    case = {"patient_id": "p", "surgical_case_id": "k", "surgical_log_id": "l", "surgical_encounter_id": "s"}
    tables = {
        "source_ehr.surgical_cases": ([tuple({**dict.fromkeys(names), **case}[n] for n in names)] * 2, broker.CONTRACTS["source_ehr.surgical_cases"]),
        "research_build.patient_crosswalk": ([("p", "R", "M")], "patient_id string, research_patient_number string, medical_record_number string"),
        "research_build.encounter_crosswalk": ([("s", "m", "se")], broker.CONTRACTS["research_build.encounter_crosswalk"]),
        "research_build.deidentified_crosswalk": ([("R", "D", 3)], broker.CONTRACTS["research_build.deidentified_crosswalk"]),
    }
    numbers, hidden = broker.SURROGATES, "research_access.deidentified_surgical_cases"
    before = catalog(spark, broker, tables)[broker.CASES]
    monkeypatch.setitem(broker.STAGES, broker.CASES, None)  # it must not be built
    monkeypatch.setitem(broker.STAGES, "temp_surgeon_rollup", None)
    cat = catalog(spark, broker, tables)
    assert {(r.kind, r.id, r.number) for r in cat[numbers].collect()} == {(k, v, 1) for k, v in zip(broker.TOKENS, ("k", "l", "se"))}
    assert [(r.deidentified_number, r.case_token) for r in cat[hidden].collect()] == [("D", 1)]
    published = {**tables, broker.CASES: ([r.asDict() | {"surgical_case_id": "other"} for r in before.collect()], before.schema)}
    assert {r.id for r in catalog(spark, broker, published)[numbers].collect()} == {"other", "l", "se"}


def test_hidden_cases_and_their_numbers_read_the_known_cases_once(spark, monkeypatch):
    from chartloom.sources import catalog as catalogs

    kept, store = [], catalogs.stored
    monkeypatch.setattr(catalogs, "stored", lambda df: kept.append(df) or store(df))
    cat = catalog(spark, broker, _cases_of_logs(**{"research_build.deidentified_crosswalk": ([("R", "D", 3)], broker.CONTRACTS["research_build.deidentified_crosswalk"])}))
    hidden = cat["research_access.deidentified_surgical_cases"].collect()
    assert len(hidden) == 3 and {r.induction_datetime for r in hidden} == {START + timedelta(days=3)}
    assert len(kept) == 1 and not {"medical_record_number", "location_id"} & set(kept[0].columns)


def test_referral_cancel_rule_and_sentinel(spark):
    """An order without status is dropped; a sentinel hides the other source's date."""
    tables = {
        "source_a.dm_cancer_patient": ([("p", "20")], "pat_id string, age string"),
        "source_a.patient": ([("p", "P", "S", date(2000, 1, 1), "1", "C", "1-2", None, None, "A0003", "Y", None)], site_a.CONTRACTS["source_a.patient"]),
        "reference_a.zc_sex": ([("1", "F")], "rcpt_mem_sex_c string, name string"),
        "dx": (
            [("p", date(2018, 1, 1), date(2019, 1, 8), Decimal("18.5"))],
            "pat_id string, diagnosis_date date, max_diagnosis_date date, patient_age_at_diagnosis decimal(18,6)",
        ),
        "source_a.order_proc": (
            [
                ("p", "A0036", None, None, date(2019, 2, 1)),
                ("p", "A0036", "4", None, date(2019, 2, 2)),
                ("p", "A0037", "4", "14", date(2019, 2, 3)),
                ("p", "A0048", "2", None, date(2019, 1, 1)),
                ("p", "A0049", "2", None, date(2018, 12, 31)),
            ],
            site_a.CONTRACTS["source_a.order_proc"],
        ),
        "op_visits": ([("p", 1, None, None, None, None)], site_a.CONTRACTS["op_visits"]),
        "identity_a.patient_crosswalk": ([("p", "S")], "pat_id string, site_a_patient_key string"),
        "source_a.x_dm_cancer_patient": ([("p", date(1840, 12, 31), None, None)], site_a.CONTRACTS["source_a.x_dm_cancer_patient"]),
        "research": ([("p", "B", None), ("p", "A", None)], "pat_id string, research_study_name string, study_type string"),
    }
    cat = catalog(spark, site_a, tables, as_of="2023-01-01")
    row = cat["referrals"].first()
    assert row.first_palliative_care_referral_dt == date(2019, 2, 3) and row.first_palliative_care_referral_type == "OP Referral"
    assert row.first_nutrition_referral_dt == date(2019, 1, 1)
    final = cat["analytics_a.cw_cancer_reporting"].collect()
    assert len(final) == 1
    assert final[0].patient_age_at_diagnosis == 19 and final[0].intro_aya_dt is None and final[0].zip == "1"
    assert final[0].enrolled_clinical_trials_count == 0 and final[0].enrolled_clinical_trials_other == "A;B"
    assert final[0].pcp is None and final[0].pcp_location_type == "Unknown"


def test_site_b_child_life_needs_an_oncologist(spark):
    tables = {
        "analytics_b.cancer_encounters": ([("p", "e1"), ("p", "e2")], "pat_id string, pat_enc_csn_id string"),
        "analytics_b.cancer_patient_demographic": (
            [("p", "P", "K", date(1990, 1, 1))], "pat_id string, patient_display_name string, site_b_patient_key string, birth_date date"
        ),
        "analytics_b.cancer_childlife_startdate": ([("p", date(2020, 1, 1), 1)], "pat_id string, child_life_contact_date date, rank int"),
        "analytics_b.cancer_dx": ([("p", date(2016, 1, 1), "C1", None, None)], "pat_id string, earliest_diagnosis_date date, icd10_dx1 string, icd10_dx2 string, icd10_dx3 string"),
        "analytics_b.cancer_research_reporting": (
            [("p", "S1", "B0035"), ("p", "S1", "B0036"), ("p", "S2", None)], "pat_id string, research_study_name string, study_type_c string"
        ),
    }
    wide = "sex primary_race ethnicity city zip death_date pcp pcp_location pcp_location_type financial_class_name".split()
    data, shape = tables["analytics_b.cancer_patient_demographic"]
    tables["analytics_b.cancer_patient_demographic"] = ([r + (None,) * len(wide) for r in data], shape + "".join(f", {c} string" for c in wide))
    name = "analytics_b.cancer_combine_wo_dx_name"
    written = catalog(spark, site_b, tables)[name].collect()
    assert len(written) == 3 and written[0].child_life_referral_date is None and written[0].number_of_visits == 2
    free = catalog(spark, site_b, tables, child_life_needs_oncologist=False)[name].first()
    assert free.child_life_referral_date == date(2020, 1, 1)
    report = catalog(spark, site_b, tables)["analytics_b.fh_cancer_reporting"].collect()
    assert len(report) == 1 and report[0].research_study_total_count == 2 and report[0].other_study_count == 1
    assert report[0].interventional_study_count == 1 and report[0].study_type == "Interventional | Observational | Other"


def test_publishing_and_refresh(spark, tiva_tables, tmp_path):
    cat = catalog(spark, tiva, tiva_tables)
    sink = ParquetSink(spark, str(tmp_path))
    names = ["tiva_anesthesia_encounters", "analytics.tiva_cohort", "analytics.tiva_final_cohort"]
    assert cat["analytics.tiva_problem_list"].count() == 0
    assert cat.refresh(sink, names)["analytics.tiva_cohort"].count() == 3
    assert cat.refresh(sink, names)["analytics.tiva_final_cohort"].count() == 3
    assert cat.is_stored("analytics.tiva_cohort") and not cat.is_stored("analytics.tiva_problem_list")
    assert cat["analytics.tiva_problem_list"].count() == 0
    assert "parquet" in cat["analytics.tiva_cohort"]._jdf.queryExecution().executedPlan().toString().lower()
    ViewSink().publish("temp.cohort", cat["analytics.tiva_cohort"])
    assert spark.table("temp_cohort").count() == 3


def test_workspace_uses_the_folder_of_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", "")
    first, second = shared_workspace(spark).root, shared_workspace(spark).root
    assert first.startswith(named) and first != second


def test_drugs_of_a_class_without_a_name_count_by_their_mixture(spark):
    tables = {
        "pop": ([("p",), ("q",)], "pat_id string"),
        "reference_a.clarity_medication": ([("m1", "c1"), ("m2", "c2"), ("m3", "gone")], "medication_id string, pharm_class_c string"),
        "reference_a.zc_pharm_class": ([("c1", None), ("c2", "ANTINEOPLASTIC AGENTS")], "pharm_class_c string, name string"),
        "source_a.order_med": ([("o1", "p", "m1", date(2020, 1, 2)), ("o2", "q", "m3", date(2020, 1, 3))], "order_med_id string, pat_id string, medication_id string, ordering_date date"),
        "source_a.order_medmixinfo": ([("o1", "m2"), ("o2", "m2")], "order_med_id string, medication_id string"),
        "source_a.mar_admin_info": ([("o1", "1"), ("o2", "1")], "order_med_id string, mar_action_c string"),
    }
    got = catalog(spark, site_a, tables)["chemo"].collect()
    assert [tuple(r) for r in got] == [("p", date(2020, 1, 2))]


def test_shared_stages_are_stored_once(spark, tiva_tables, tmp_path):
    cat = catalog(spark, tiva, tiva_tables)
    shared = Catalog(spark, cat._source, tiva.STAGES, tiva.CONTRACTS, shared=tiva.SHARED, workspace=ParquetSink(spark, str(tmp_path)))
    assert shared["analytics.tiva_demographics"].count() == 0
    assert {p.name for p in tmp_path.iterdir()} == tiva.SHARED


def test_contracts_and_tables(spark, tmp_path):
    cat = Catalog(spark, {"t": lambda: spark.createDataFrame([(1,)], "other int")}, contracts={"t": "id string"})
    with pytest.raises(ValueError):
        cat["t"]
    with pytest.raises(KeyError):
        Catalog(spark, {})["nothing"]
    assert table_sources(spark)("no_such_table") is None
    assert TableSink(spark).database == "default"


def test_diagnosis_ranks_span_the_patient_and_groups_the_day(spark):
    """Codes two and three fill only from the first day; a first diagnosis without a code drops the patient."""
    day, later = date(2020, 1, 1), date(2020, 2, 1)
    visits = [("p", "e1", day), ("p", "e2", later), ("q", "f1", day), ("q", "f2", later), ("r", "g1", day)]
    tables = {
        "analytics_b.cancer_encounters": ([(p, e, "d", "v", "s", site_b.VISIT_STATUS[0], at) for p, e, at in visits], site_b.CONTRACTS["source_b.pat_enc"]),
        "source_b.grouper_compiled_rec_list": (
            [(site_b.DIAGNOSIS_GROUPER, None, x, "EDG", 1) for x in ("x1", "x2", "x3", "none")], site_b.CONTRACTS["source_b.grouper_compiled_rec_list"]
        ),
        "reference_b.clarity_edg": ([(x, x, "2", None, None) for x in ("x1", "x2", "x3", "none")], site_b.CONTRACTS["reference_b.clarity_edg"]),
        "reference_b.clarity_prc": ([("v", [*site_b.VISIT_TYPES][0])], "prc_id string, prc_name string"),
        "source_b.pat_enc_dx": (
            [("e1", "x1", 1), ("e2", "x2", 1), ("f1", "none", 1), ("f2", "x1", 1), ("g1", "x1", 1), ("g1", "x3", 2)], "pat_enc_csn_id string, dx_id string, line int"
        ),
        "reference_b.edg_current_icd10": ([("x1", "C1"), ("x2", "C2"), ("x3", "C3")], "dx_id string, code string"),
    }
    got = sorted(tuple(r) for r in catalog(spark, site_b, tables)["analytics_b.cancer_dx"].collect())
    assert got == [("p", day, "C1", None, None), ("r", day, "C1", "C3", None)]


def test_a_patient_on_both_registries_keeps_two_rows(spark):
    tables = {
        "source_a.dm_cancer_patient": ([("p", "20"), ("q", "31")], "pat_id string, age string"),
        "deceased_pat_reg": ([("p",), ("p",)], "pat_id string"),
        "source_a.patient": ([(p, "P", "S", date(2000, 1, 1), "1", "C", "1-2", None, None, "A0003", "Y", None) for p in "pq"], site_a.CONTRACTS["source_a.patient"]),
        "reference_a.zc_sex": ([("1", "F")], "rcpt_mem_sex_c string, name string"),
    }
    got = sorted((r.pat_id, r.age) for r in catalog(spark, site_a, tables, as_of="2022-06-01")["pop"].collect())
    assert got == [("p", "20"), ("p", "22"), ("q", "31")]


def test_radiation_without_a_readable_date_keeps_its_text(spark):
    """Unreadable dates rank last, but rank one of a patient who has no other."""
    tables = {
        "source_b.order_results": (
            [("o1", site_b.RADIATION_START, "soon"), ("o2", site_b.RADIATION_START, "later"), ("o2", site_b.RADIATION_START, "1/2/2020")],
            "order_proc_id string, component_id string, ord_value string",
        ),
        "source_b.order_proc": ([("o1", "p", "e", "x", None), ("o2", "q", "e", "x", None)], site_b.CONTRACTS["source_b.order_proc"]),
        "analytics_b.cancer_patient_demographic": ([("p", "P"), ("q", "Q")], "pat_id string, site_b_patient_key string"),
    }
    got = sorted((r.pat_id, r.row, r.ord_value) for r in catalog(spark, site_b, tables)["analytics_b.cancer_rad_startdate"].collect())
    assert got == [("p", 1, "soon"), ("q", 1, "1/2/2020"), ("q", 2, "later")]
