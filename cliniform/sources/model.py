"""Target model: tables, columns in order, types, widths, keys, references.

A column is written ``name[:type][!]``; ``!`` marks a required column. The type is a text
width (``:18``) or a number (``:n15.8``). Without one it follows from the name:
``*_date`` and ``*period_start/end`` are dates, ``*_time`` is HH:MM text, all else is text of 256.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Field:
    name: str
    type: T.DataType
    width: int | None
    required: bool


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...]
    has_site: bool = True

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def schema(self) -> T.StructType:
        site = [T.StructField("site", T.StringType())] if self.has_site else []
        return T.StructType([
            T.StructField(f.name, f.type, not f.required,
                          {"width": f.width} if f.width else {}) for f in self.fields] + site)

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.fields if f.required]

    @property
    def widths(self) -> dict[str, int]:
        return {f.name: f.width for f in self.fields if f.width}

    @property
    def numbers(self) -> dict[str, tuple[int, int]]:
        return {f.name: (f.type.precision, f.type.scale) for f in self.fields
                if isinstance(f.type, T.DecimalType)}


def _field(spec: str) -> Field:
    required = spec.endswith("!")
    name, _, kind = spec.rstrip("!").partition(":")
    if kind.startswith("n"):
        p, s = kind[1:].split(".")
        return Field(name, T.DecimalType(int(p), int(s)), None, required)
    if kind:
        return Field(name, T.StringType(), int(kind), required)
    if name.endswith(("_date", "period_start", "period_end")):
        return Field(name, T.DateType(), None, required)
    if name.endswith("_time"):
        return Field(name, T.StringType(), 5, required)
    return Field(name, T.StringType(), 256, required)


# Column names, types and keys of the target model.
_SPECS: dict[str, tuple[str, str]] = {
    "condition": ("conditionid", """
        condition:18! condition_source:2! condition_status:2 condition_type:2! conditionid! encounterid
        onset_date patid! raw_condition raw_condition_source raw_condition_status raw_condition_type
        report_date resolve_date"""),
    "death": ("patid death_source", """
        death_date death_date_impute:2 death_match_confidence:2 death_source:2! patid!"""),
    "death_cause": ("patid death_cause death_cause_code death_cause_type death_cause_source", """
        death_cause:8! death_cause_code:2! death_cause_confidence:2 death_cause_source:2!
        death_cause_type:2! patid!"""),
    "demographic": ("patid", """
        biobank_flag:1 birth_date birth_time gender_identity:2 hispanic:2 pat_pref_language_spoken:3
        patid! race:2 raw_gender_identity raw_hispanic raw_pat_pref_language_spoken raw_race raw_sex
        raw_sexual_orientation sex:2 sexual_orientation:2"""),
    "diagnosis": ("diagnosisid", """
        admit_date diagnosisid! dx:18! dx_date dx_origin:2 dx_poa:2 dx_source:2! dx_type:2! enc_type:2
        encounterid patid! pdx:2 providerid raw_dx raw_dx_poa raw_dx_source raw_dx_type raw_pdx"""),
    "dispensing": ("dispensingid", """
        dispense_amt:n15.8 dispense_date! dispense_dose_disp:n15.8 dispense_dose_disp_unit
        dispense_route dispense_source:2 dispense_sup:n15.8 dispensingid! ndc:11! patid! prescribingid
        raw_dispense_dose_disp raw_dispense_dose_disp_unit raw_dispense_route raw_ndc"""),
    "encounter": ("encounterid", """
        admit_date! admit_time admitting_source:2 discharge_date discharge_disposition:2
        discharge_status:2 discharge_time drg:3 drg_type:2 enc_type:2! encounterid!
        facility_location:5 facility_type facilityid patid! payer_type_primary:5
        payer_type_secondary:5 providerid raw_admitting_source raw_discharge_disposition
        raw_discharge_status raw_drg_type raw_enc_type raw_facility_type raw_payer_id_primary
        raw_payer_id_secondary raw_payer_name_primary raw_payer_name_secondary
        raw_payer_type_primary raw_payer_type_secondary raw_siteid"""),
    "enrollment": ("patid enr_start_date enr_basis", """
        chart:1 enr_basis:1! enr_end_date enr_start_date! patid!"""),
    "immunization": ("immunizationid", """
        encounterid immunizationid! patid! proceduresid raw_vx_body_site raw_vx_code raw_vx_code_type
        raw_vx_dose raw_vx_dose_unit raw_vx_manufacturer raw_vx_name raw_vx_route raw_vx_status
        raw_vx_status_reason vx_admin_date vx_body_site vx_code:11! vx_code_type:2! vx_dose:n20.5
        vx_dose_unit vx_exp_date vx_lot_num vx_manufacturer vx_providerid vx_record_date vx_route
        vx_source:2 vx_status:2! vx_status_reason:2"""),
    "lab_history": ("labhistoryid", """
        age_max_wks:n20.5 age_min_wks:n20.5 lab_facilityid lab_loinc:10! labhistoryid!
        norm_modifier_high:2 norm_modifier_low:2 norm_range_high:10 norm_range_low:10 period_end
        period_start race:2 raw_lab_name raw_range raw_unit result_unit sex:2"""),
    "lab_result_cm": ("lab_result_cm_id", """
        abn_ind:2 encounterid lab_loinc:10 lab_loinc_source:2 lab_order_date lab_px:11 lab_px_type:2
        lab_result_cm_id! lab_result_source:2 norm_modifier_high:2 norm_modifier_low:2
        norm_range_high:10 norm_range_low:10 patid! priority:2 raw_facility_code raw_lab_code
        raw_lab_name raw_order_dept raw_panel raw_result raw_unit result_date! result_loc:2
        result_modifier:2 result_num:n15.8 result_qual result_snomed:18 result_time result_unit
        specimen_date specimen_source specimen_time"""),
    "lds_address_history": ("addressid", """
        address_city address_county address_period_end address_period_start address_preferred:2!
        address_state:2 address_type:2! address_use:2! address_zip5:5 address_zip9:9 addressid! patid!"""),
    "med_admin": ("medadminid", """
        encounterid medadmin_code:11 medadmin_dose_admin:n20.5 medadmin_dose_admin_unit
        medadmin_providerid medadmin_route medadmin_source:2 medadmin_start_date! medadmin_start_time
        medadmin_stop_date medadmin_stop_time medadmin_type:2 medadminid! patid! prescribingid
        raw_medadmin_code raw_medadmin_dose_admin raw_medadmin_dose_admin_unit raw_medadmin_med_name
        raw_medadmin_route"""),
    "obs_clin": ("obsclinid", """
        encounterid obsclin_abn_ind:2 obsclin_code:18 obsclin_providerid obsclin_result_modifier:2
        obsclin_result_num:n15.8 obsclin_result_qual obsclin_result_snomed:18 obsclin_result_text
        obsclin_result_unit obsclin_source:2 obsclin_start_date! obsclin_start_time obsclin_stop_date
        obsclin_stop_time obsclin_type:2 obsclinid! patid! raw_obsclin_code raw_obsclin_modifier
        raw_obsclin_name raw_obsclin_result raw_obsclin_type raw_obsclin_unit"""),
    "obs_gen": ("obsgenid", """
        encounterid obsgen_abn_ind:2 obsgen_code:50 obsgen_id_modified obsgen_providerid
        obsgen_result_modifier:2 obsgen_result_num:n15.8 obsgen_result_qual obsgen_result_text
        obsgen_result_unit obsgen_source:2 obsgen_start_date! obsgen_start_time obsgen_stop_date
        obsgen_stop_time obsgen_table_modified:3 obsgen_type:30 obsgenid! patid! raw_obsgen_code
        raw_obsgen_name raw_obsgen_result raw_obsgen_type raw_obsgen_unit"""),
    "trial": ("patid trialid participantid", """
        participantid! patid! trial_end_date trial_enroll_date trial_invite_code:20 trial_siteid
        trial_withdraw_date trialid:20!"""),
    "prescribing": ("prescribingid", """
        encounterid patid! prescribingid! raw_rx_dose_ordered raw_rx_dose_ordered_unit raw_rx_frequency
        raw_rx_med_name raw_rx_ndc raw_rx_quantity raw_rx_refills raw_rx_route raw_rxnorm_cui rx_basis:2
        rx_days_supply:n15.8 rx_dispense_as_written:2 rx_dose_form rx_dose_ordered:n15.8
        rx_dose_ordered_unit rx_end_date rx_frequency:2 rx_order_date rx_order_time rx_prn_flag:1
        rx_providerid rx_quantity:n15.8 rx_quantity_unit:2 rx_refills:n15.8 rx_route rx_source:2
        rx_start_date rxnorm_cui:8"""),
    "private_address_geocode": ("geocodeid", """
        addressid! assignment_date geo_accuracy:2 geo_prov_ref geocode_block geocode_county
        geocode_custom geocode_custom_text geocode_group geocode_latitude geocode_longitude
        geocode_state:2 geocode_tract geocode_zcta geocodeid! shapefile"""),
    "private_address_history": ("addressid", """
        address_city address_county address_detail address_period_end address_period_start
        address_preferred:2! address_state:2 address_street address_type:2! address_use:2!
        address_zip5:5 address_zip9:9 addressid! patid! raw_address_text"""),
    "private_demographic": ("patid", """
        biobank_flag:1 birth_date birth_time gender_identity:2 hispanic:2 managing_org mrn org_patid
        pat_firstname! pat_lastname! pat_maidenname pat_middlename pat_pref_language_spoken:3 pat_ssn
        patid! primary_email primary_phone:10 race:2 raw_gender_identity raw_hispanic raw_pat_name
        raw_pat_pref_language_spoken raw_race raw_sex raw_sexual_orientation sex:2 sexual_orientation:2"""),
    "pro_cm": ("pro_cm_id", """
        encounterid patid! pro_cat:2 pro_cm_id! pro_date! pro_item_fullname pro_item_loinc:10
        pro_item_name pro_item_text pro_item_version pro_measure_count_scored:n15.8
        pro_measure_fullname pro_measure_loinc:10 pro_measure_name pro_measure_scaled_tscore:n15.8
        pro_measure_score:n15.8 pro_measure_seq pro_measure_standard_error:n15.8
        pro_measure_theta:n15.8 pro_measure_version pro_method:2 pro_mode:2 pro_response_num:n15.8
        pro_response_text pro_source:2 pro_time pro_type:2"""),
    "procedures": ("proceduresid", """
        admit_date enc_type:2 encounterid patid! ppx:2 proceduresid! providerid px:11! px_date
        px_source:2 px_type:2! raw_ppx raw_px raw_px_type"""),
    "provider": ("providerid", """
        provider_npi:n20.0 provider_npi_flag:1 provider_sex:2 provider_specialty_primary providerid!
        raw_provider_specialty_primary"""),
    "vital": ("vitalid", """
        bp_position:2 diastolic:n15.8 encounterid ht:n15.8 measure_date! measure_time
        original_bmi:n15.8 patid! raw_bp_position raw_diastolic raw_smoking raw_systolic raw_tobacco
        raw_tobacco_type smoking:2 systolic:n15.8 tobacco:2 tobacco_type:2 vital_source:2! vitalid!
        wt:n15.8"""),
}

# Numbers of the token columns.
_TOKENS = (*range(1, 10), *range(101, 112), 12, 14, 15, 16, 17, 18, 23, 24, 25, 26, 29, 30)

# Date columns whose handling the harvest row describes, and refreshed tables.
MANAGED_DATES = (
    "address_period_end address_period_start admit_date birth_date death_date discharge_date "
    "dispense_date dx_date enr_end_date enr_start_date lab_order_date measure_date "
    "medadmin_start_date medadmin_stop_date obsclin_start_date obsclin_stop_date "
    "obsgen_start_date obsgen_stop_date onset_date pro_date px_date report_date resolve_date "
    "result_date rx_end_date rx_order_date rx_start_date specimen_date vx_admin_date vx_exp_date "
    "vx_record_date").split()
REFRESHED = (
    "condition death_cause death demographic diagnosis dispensing encounter enrollment hash_token "
    "immunization lab_result_cm lds_address_hx med_admin obs_clin obs_gen trial prescribing pro_cm "
    "procedures provider vital").split()
_HARVEST_CODES = ("cdm_version:3 datamart_claims:2 datamart_ehr:2 datamart_name:20 datamart_platform:2 "
                  "datamartid:10! network_name:20 networkid:10!").split()


def _tables() -> dict[str, Table]:
    out = {n: Table(n, tuple(_field(c) for c in spec.split()), tuple(key.split()))
           for n, (key, spec) in _SPECS.items()}
    tokens = [f"token_{n:02d}" for n in _TOKENS]
    out["hash_token"] = Table("hash_token", tuple(
        _field(c) for c in ["patid!", *tokens, "token_encryption_key!"]), ("patid", "token_encryption_key"))
    harvest = [*_HARVEST_CODES, *[f"{d}_mgmt:2" for d in MANAGED_DATES],
               *[f"refresh_{t}_date" for t in REFRESHED]]
    out["harvest"] = Table("harvest", tuple(sorted((_field(c) for c in harvest), key=lambda f: f.name)),
                           ("networkid", "datamartid"), has_site=False)
    log = tuple(_field(c) for c in "operation:100 model:16 model_version:50 dms_version:50 dmsa_version:50".split())
    out["version_history"] = Table("version_history", (Field("datetime", T.TimestampNTZType(), None, True), *log),
                                   ("datetime",), has_site=False)
    return out


TABLES: dict[str, Table] = _tables()

# References between target tables (child column → parent column).
_PATIENT_TABLES = (
    "encounter procedures pro_cm obs_clin obs_gen trial enrollment death death_cause condition diagnosis "
    "dispensing med_admin prescribing vital lab_result_cm hash_token immunization lds_address_history "
    "private_address_history private_demographic").split()
_VISIT_TABLES = ("procedures pro_cm obs_clin obs_gen condition diagnosis prescribing med_admin "
                 "lab_result_cm vital immunization").split()
_PROVIDER_COLUMNS = {
    "procedures": "providerid", "obs_clin": "obsclin_providerid", "obs_gen": "obsgen_providerid",
    "prescribing": "rx_providerid", "diagnosis": "providerid", "med_admin": "medadmin_providerid",
    "encounter": "providerid", "immunization": "vx_providerid"}
REFERENCES: list[tuple[str, str, str, str]] = [
    *[(t, "patid", "demographic", "patid") for t in _PATIENT_TABLES],
    *[(t, "encounterid", "encounter", "encounterid") for t in _VISIT_TABLES],
    *[(t, c, "provider", "providerid") for t, c in _PROVIDER_COLUMNS.items()],
    ("dispensing", "prescribingid", "prescribing", "prescribingid"),
    ("immunization", "proceduresid", "procedures", "proceduresid"),
    ("private_address_geocode", "addressid", "lds_address_history", "addressid"),
]

# Tables whose rows must belong to a cohort person, and to a cohort visit.
PERSON_CHECKED = (
    "condition diagnosis death death_cause demographic dispensing encounter enrollment hash_token "
    "immunization lab_result_cm lds_address_history med_admin obs_clin obs_gen trial prescribing "
    "procedures pro_cm vital").split()
VISIT_CHECKED = ("condition diagnosis immunization lab_result_cm med_admin obs_clin obs_gen prescribing "
                 "procedures pro_cm vital").split()


def _fit(df: DataFrame, field: Field) -> Column:
    if field.name not in df.columns:
        return F.lit(None).cast(field.type).alias(field.name)
    have = df.schema[field.name].dataType
    value = F.col(field.name)
    if have != field.type:
        value = value.try_cast(field.type)
    return value.alias(field.name)


_raw: ContextVar[bool] = ContextVar("raw", default=False)


@contextmanager
def unconformed() -> Iterator[None]:
    """Plans built inside keep the values as they come: columns are named and ordered, not yet cast, so that what
    does not fit can be counted (:func:`misfits`) before :func:`conform` turns it into NULL."""
    token = _raw.set(True)
    try:
        yield
    finally:
        _raw.reset(token)


def misfits(df: DataFrame, table: str) -> dict[str, Column]:
    """Per column of another type than declared: whether a value is lost by the cast."""
    return {f.name: F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.type).isNull() for f in TABLES[table].fields
            if f.name in df.columns and df.schema[f.name].dataType != f.type and not isinstance(f.type, T.StringType)}


def conform(df: DataFrame, table: str, site: str) -> DataFrame:
    """Columns of a target table in order; missing ones are NULL, ``site`` comes last. A value that does
    not fit its column becomes NULL; count such values with :func:`misfits` on the rows before."""
    t = TABLES[table]
    if _raw.get():
        cols = [F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.type).alias(f.name) for f in t.fields]
    else:
        cols = [_fit(df, f) for f in t.fields]
    if t.has_site:
        cols.append(F.lit(site).alias("site"))
    return df.select(*cols)


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A target table without rows (the never-filled tables, or an absent source)."""
    schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in TABLES[table].schema])
    return spark.createDataFrame([], schema)
