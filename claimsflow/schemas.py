"""Final schemas of the replicated claims tables (after every migration).

NUMERIC columns are carried as their PostgreSQL text form (``col::text``),
because the reports print numbers with the scale they were entered with
(``1000`` stays ``1000``, ``2500.00`` stays ``2500.00``).  Arithmetic reads
them through :func:`claimsflow.functions.money.num`.
"""

from __future__ import annotations

from pyspark.sql import types as T

NUMERIC = "string"  # PostgreSQL NUMERIC lexeme, see module doc

_DDL = {
    "submission": f"""
        id string not null, bulk_submission_id string not null,
        office_account_number string not null, submission_period string not null,
        area_of_law string not null, status string not null,
        crime_lower_schedule_number string, previous_submission_id string,
        is_nil_submission boolean, number_of_claims int, error_messages string,
        created_by_user_id string not null, created_on timestamp not null,
        updated_by_user_id string, updated_on timestamp,
        legal_help_submission_reference string, mediation_submission_reference string,
        provider_user_id string not null""",
    "claim": f"""
        id string not null, submission_id string not null, status string not null,
        schedule_reference string, line_number int not null,
        case_reference_number string, unique_file_number string,
        case_start_date date, case_concluded_date date,
        matter_type_code string not null, crime_matter_type_code string,
        fee_scheme_code string, fee_code string, procurement_area_code string,
        access_point_code string, delivery_location string,
        representation_order_date date, suspects_defendants_count int,
        police_station_court_attendances_count int,
        police_station_court_prison_id string, dscc_number string, maat_id string,
        prison_law_prior_approval_number string, is_duty_solicitor boolean,
        is_youth_court boolean, scheme_id string, mediation_sessions_count int,
        mediation_time_minutes int, outreach_location string, referral_source string,
        matched_claim_id string, total_value {NUMERIC},
        created_by_user_id string not null, created_on timestamp not null,
        updated_by_user_id string, updated_on timestamp,
        is_amended boolean not null, has_assessment boolean not null,
        version bigint not null""",
    "client": """
        id string not null, claim_id string not null, client_forename string,
        client_surname string, client_date_of_birth date, unique_client_number string,
        client_postcode string, gender_code string, ethnicity_code string,
        disability_code string, is_legally_aided boolean, client_type_code string,
        home_office_client_number string, cla_reference_number string,
        cla_exemption_code string, client_2_forename string, client_2_surname string,
        client_2_date_of_birth date, client_2_ucn string, client_2_postcode string,
        client_2_gender_code string, client_2_ethnicity_code string,
        client_2_disability_code string, client_2_is_legally_aided boolean,
        created_by_user_id string not null, created_on timestamp not null,
        updated_by_user_id string, updated_on timestamp""",
    "claim_case": """
        id string not null, claim_id string not null, case_id string,
        unique_case_id string, case_stage_code string, stage_reached_code string,
        standard_fee_category_code string, outcome_code string,
        designated_accredited_representative_code string,
        is_postal_application_accepted boolean,
        is_client_2_postal_application_accepted boolean,
        mental_health_tribunal_reference string, is_nrm_advice boolean,
        follow_on_work string, transfer_date date, exemption_criteria_satisfied string,
        exceptional_case_funding_reference string, is_legacy_case boolean,
        created_by_user_id string not null, created_on timestamp not null,
        updated_by_user_id string, updated_on timestamp""",
    "claim_summary_fee": f"""
        id string not null, claim_id string not null, advice_time int,
        travel_time int, waiting_time int, net_profit_costs_amount {NUMERIC},
        net_disbursement_amount {NUMERIC}, net_counsel_costs_amount {NUMERIC},
        disbursements_vat_amount {NUMERIC}, travel_waiting_costs_amount {NUMERIC},
        net_waiting_costs_amount {NUMERIC}, is_vat_applicable boolean,
        is_tolerance_applicable boolean, prior_authority_reference string,
        is_london_rate boolean, adjourned_hearing_fee_amount int,
        is_additional_travel_payment boolean, costs_damages_recovered_amount {NUMERIC},
        meetings_attended_code string, detention_travel_waiting_costs_amount {NUMERIC},
        jr_form_filling_amount {NUMERIC}, is_eligible_client boolean,
        court_location_code string, advice_type_code string,
        medical_reports_count int, is_irc_surgery boolean, surgery_date date,
        surgery_clients_count int, surgery_matters_count int, cmrh_oral_count int,
        cmrh_telephone_count int, ait_hearing_centre_code string,
        is_substantive_hearing boolean, ho_interview int, local_authority_number string,
        created_by_user_id string not null, created_on timestamp not null,
        updated_by_user_id string, updated_on timestamp""",
    "calculated_fee_detail": f"""
        id string not null, claim_summary_fee_id string not null,
        claim_id string not null, fee_code string, fee_type string,
        created_by_user_id string not null, created_on timestamp not null,
        updated_by_user_id string, updated_on timestamp,
        fee_code_description string, category_of_law string,
        total_amount {NUMERIC}, vat_indicator boolean, vat_rate_applied {NUMERIC},
        calculated_vat_amount {NUMERIC}, disbursement_amount {NUMERIC},
        requested_net_disbursement_amount {NUMERIC}, disbursement_vat_amount {NUMERIC},
        hourly_total_amount {NUMERIC}, fixed_fee_amount {NUMERIC},
        net_profit_costs_amount {NUMERIC}, requested_net_profit_costs_amount {NUMERIC},
        net_cost_of_counsel_amount {NUMERIC}, net_travel_costs_amount {NUMERIC},
        net_waiting_costs_amount {NUMERIC},
        detention_travel_and_waiting_costs_amount {NUMERIC},
        jr_form_filling_amount {NUMERIC}, travel_and_waiting_costs_amount {NUMERIC},
        bolt_on_total_fee_amount {NUMERIC}, bolt_on_adjourned_hearing_count int,
        bolt_on_adjourned_hearing_fee {NUMERIC}, bolt_on_cmrh_telephone_count int,
        bolt_on_cmrh_telephone_fee {NUMERIC}, bolt_on_cmrh_oral_count int,
        bolt_on_cmrh_oral_fee {NUMERIC}, bolt_on_home_office_interview_count int,
        bolt_on_home_office_interview_fee {NUMERIC}, escape_case_flag boolean,
        scheme_id string, bolt_on_substantive_hearing_fee {NUMERIC}""",
    "matter_start": """
        id string not null, submission_id string not null, schedule_reference string,
        category_code string, procurement_area_code string, access_point_code string,
        delivery_location string, created_by_user_id string not null,
        created_on timestamp not null, updated_by_user_id string, updated_on timestamp,
        mediation_type string, number_of_matter_starts int""",
    "bulk_submission": """
        id string not null, status string not null, error_code string,
        error_description string, created_by_user_id string not null,
        created_on timestamp not null, updated_by_user_id string, updated_on timestamp,
        authorised_offices string""",
    "replication_summary": """
        table_name string not null, summary_date date not null,
        record_count bigint not null, updated_count bigint not null,
        wal_lsn string not null, created_on timestamp not null""",
}

_TYPES = {
    "string": T.StringType(), "boolean": T.BooleanType(), "int": T.IntegerType(),
    "bigint": T.LongType(), "date": T.DateType(), "timestamp": T.TimestampType(),
}


def _struct(ddl: str) -> T.StructType:
    fields = []
    for item in ddl.split(","):
        name, kind, *rest = item.split()
        fields.append(T.StructField(name, _TYPES[kind], nullable=(rest != ["not", "null"])))
    return T.StructType(fields)


SCHEMAS: dict[str, T.StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}

# Tables whose rows the reports read.
REPORT_TABLES = (
    "submission", "bulk_submission", "claim", "client", "claim_case",
    "claim_summary_fee", "calculated_fee_detail",
)

# Tables that no report reads, counted by the nightly check where the copy holds them.
COUNTED_TABLES = ("matter_start",)

PRIMARY_KEYS: dict[str, tuple[str, ...]] = {
    "submission": ("id",),
    "claim": ("id",),
    "client": ("id",),
    "claim_case": ("id",),
    "claim_summary_fee": ("id",),
    "calculated_fee_detail": ("id",),
    "matter_start": ("id",),
    "bulk_submission": ("id",),
    "replication_summary": ("table_name", "summary_date"),
}

# (child table, child column, parent table, parent column)
FOREIGN_KEYS: tuple[tuple[str, str, str, str], ...] = (
    ("claim", "submission_id", "submission", "id"),
    ("claim", "matched_claim_id", "claim", "id"),
    ("client", "claim_id", "claim", "id"),
    ("claim_case", "claim_id", "claim", "id"),
    ("claim_summary_fee", "claim_id", "claim", "id"),
    ("calculated_fee_detail", "claim_summary_fee_id", "claim_summary_fee", "id"),
    ("calculated_fee_detail", "claim_id", "claim", "id"),
    ("matter_start", "submission_id", "submission", "id"),
)


def required_columns(table: str) -> list[str]:
    return [f.name for f in SCHEMAS[table].fields if not f.nullable]


# Column renames and additions made by later migrations, so that files written
# under an older layout can be read into the final schema (DQ-4).
RENAMES: dict[str, dict[str, str]] = {
    "submission": {
        "crime_schedule_number": "crime_lower_schedule_number",
        "civil_submission_reference": "legal_help_submission_reference",
    },
    "calculated_fee_detail": {
        "detention_and_waiting_costs_amount": "detention_travel_and_waiting_costs_amount",
    },
}

# Added NOT NULL columns and the default existing rows receive.
ADDED_DEFAULTS: dict[str, dict[str, object]] = {
    "claim": {"is_amended": False, "has_assessment": False, "version": 0},
}

# Columns that the first layout of a table does not have, by the release that added
# them together.  Those without a default are null in older files (DQ-3 reports the
# required ones).
LATER_COLUMNS: dict[str, tuple[tuple[str, ...], ...]] = {
    "submission": (("provider_user_id",),),
    "claim": (("is_amended", "has_assessment", "version"),),
    "calculated_fee_detail": (("bolt_on_substantive_hearing_fee",),),
    "matter_start": (("mediation_type",), ("number_of_matter_starts",)),
}
