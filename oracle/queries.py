"""Hand-written DuckDB oracle SQL, one per ``queries()`` key.

Written independently of the Spark code: same meaning, different route
(window ranks where Spark uses max_by, flat joins where Spark pre-aggregates,
DuckDB PIVOT for the matrix).  Output columns carry the same names and the
same text/BIGINT types as the Spark side's stable projection.
"""

from __future__ import annotations

from oracle.testbed_sql import with_testbed

SQL: dict[str, str] = {}

# ---------------------------------------------------------------- periods
PERIOD_WIDE = r"""
CASE
  WHEN regexp_full_match({p}, '\d{{4}}-\d{{2}}-\d{{2}}') THEN CAST(strptime({p}, '%Y-%m-%d') AS DATE)
  WHEN regexp_full_match({p}, '\d{{4}}-\d{{2}}') THEN CAST(strptime({p} || '-01', '%Y-%m-%d') AS DATE)
  WHEN regexp_full_match({p}, '[A-Za-z]{{3}}-\d{{4}}') THEN CAST(strptime({p}, '%b-%Y') AS DATE)
END"""

PERIOD_STRICT = r"""
CASE
  WHEN regexp_full_match({p}, '\d{{4}}-(0[1-9]|1[0-2])') THEN CAST(strptime({p} || '-01', '%Y-%m-%d') AS DATE)
  WHEN regexp_full_match({p}, '[A-Za-z]{{3}}-\d{{4}}') THEN CAST(strptime({p}, '%b-%Y') AS DATE)
END"""


def wide(p: str) -> str:
    return PERIOD_WIDE.format(p=p)


def strict(p: str) -> str:
    return PERIOD_STRICT.format(p=p)


def london_dmy(ts: str) -> str:
    return f"strftime(({ts} AT TIME ZONE 'UTC') AT TIME ZONE 'Europe/London', '%d/%m/%Y')"


def money_text(x: str) -> str:
    return f"CAST(CAST(round({x}, 2) AS DECIMAL(36,2)) AS VARCHAR)"


# ---------------------------------------------------------------- REP012
REP012_CTES = f"""
rep12_norm AS (
  SELECT id AS submission_id, office_account_number, area_of_law, status, created_on,
         {wide('submission_period')} AS pdate
  FROM submission
),
rep12_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY office_account_number, area_of_law, pdate
                               ORDER BY created_on DESC, submission_id DESC) AS rn
  FROM rep12_norm
  WHERE status = 'VALIDATION_SUCCEEDED' AND area_of_law IN ('CIVIL', 'CRIME LOWER', 'MEDIATION')
    AND pdate IS NOT NULL
),
rep12_chosen AS (SELECT * FROM rep12_ranked WHERE rn = 1),
rep12_totals AS (
  SELECT c.submission_id, sum(COALESCE(CAST(f.total_amount AS DECIMAL(34,8)), 0)) AS total_fee
  FROM claim c JOIN calculated_fee_detail f ON f.claim_id = c.id
  WHERE c.submission_id IN (SELECT submission_id FROM rep12_chosen)
  GROUP BY c.submission_id
)"""

SQL["rep012_original_values"] = with_testbed(REP012_CTES, """
SELECT ch.office_account_number AS "Provider office account number",
       upper(strftime(ch.pdate, '%b-%Y')) AS "Submission month",
       ch.area_of_law AS "Area of law",
       CAST(COALESCE(CAST(round(t.total_fee, 2) AS DECIMAL(36,2)), CAST(0 AS DECIMAL(36,2))) AS VARCHAR)
         AS "Original submission value",
       """ + london_dmy("ch.created_on") + """ AS "Date submission was uploaded"
FROM rep12_chosen ch LEFT JOIN rep12_totals t ON t.submission_id = ch.submission_id
""")


# ---------------------------------------------------------------- REP013
def canon(a: str) -> str:
    return (f"upper(CASE WHEN upper({a}) = 'CRIME LOWER' THEN 'CRIME' "
            f"WHEN upper({a}) = 'LEGAL HELP' THEN 'CIVIL' ELSE {a} END)")


REP013_CTES = f"""
rep13_cur AS (
  SELECT * FROM (
    SELECT s.id, s.office_account_number, {canon('s.area_of_law')} AS area, s.is_nil_submission,
           s.submission_period, s.created_on
    FROM submission s
    WHERE s.status = 'VALIDATION_SUCCEEDED'
      AND NOT EXISTS (SELECT 1 FROM submission n WHERE n.previous_submission_id = s.id)
  ) WHERE area IN ('CIVIL', 'CRIME', 'MEDIATION')
),
rep13_tot AS (
  SELECT cs.id, sum(CAST(f.total_amount AS DECIMAL(34,8))) AS total_amount
  FROM rep13_cur cs
  LEFT JOIN claim c ON c.submission_id = cs.id AND c.status = 'VALID'
  LEFT JOIN calculated_fee_detail f ON f.claim_id = c.id
  GROUP BY cs.id
),
rep13_long AS (
  SELECT cs.*, CASE WHEN cs.is_nil_submission THEN CAST(0 AS DECIMAL(36,2))
                    ELSE CAST(round(COALESCE(t.total_amount, 0), 2) AS DECIMAL(36,2)) END AS month_total
  FROM rep13_cur cs LEFT JOIN rep13_tot t ON t.id = cs.id
),
rep13_cells AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY office_account_number, area, submission_period
                                 ORDER BY created_on DESC, id DESC) AS rn
    FROM rep13_long) WHERE rn = 1
),
rep13_periods AS (
  SELECT DISTINCT submission_period AS period,
         COALESCE(month(try_strptime(substr(submission_period, 1, 3) || '-2000', '%b-%Y')), 99) AS month_order,
         CAST(substr(submission_period, 5) AS INTEGER) AS year_order
  FROM submission WHERE status = 'VALIDATION_SUCCEEDED' AND submission_period IS NOT NULL
)"""

SQL["rep013_month_totals"] = with_testbed(REP013_CTES, """
SELECT office_account_number, area AS area_of_law, submission_period,
       CAST(month_total AS VARCHAR) AS month_total
FROM rep13_cells""")

SQL["nil_override"] = with_testbed(REP013_CTES, """
SELECT id, CAST(month_total AS VARCHAR) AS month_total FROM rep13_long""")

SQL["submission_totals_left"] = with_testbed(REP013_CTES, """
SELECT id AS submission_id, CAST(CAST(total_amount AS DECIMAL(38,18)) AS VARCHAR) AS total_amount FROM rep13_tot""")

SQL["superseded_anti_join"] = with_testbed(REP013_CTES, """
SELECT id, office_account_number, area AS area_of_law, submission_period, is_nil_submission
FROM rep13_cur""")

SQL["rowkey_pack_unpack"] = with_testbed(REP013_CTES, """
SELECT id, concat_ws('|', area, office_account_number) AS row_id,
       split_part(concat_ws('|', area, office_account_number), '|', 1) AS area_part,
       split_part(concat_ws('|', area, office_account_number), '|', 2) AS office_part
FROM rep13_cur""")

SQL["period_columns_ordered"] = with_testbed(REP013_CTES, """
SELECT period, CAST(month_order AS BIGINT) AS month_order, CAST(year_order AS BIGINT) AS year_order
FROM rep13_periods""")

SQL["period_list_joined"] = with_testbed(REP013_CTES, """
SELECT string_agg(period, ', ' ORDER BY year_order, month_order, period) AS list_text
FROM rep13_periods""")

# The matrix as rows: every (office, area) with a current value times every
# period column, blank where there is no value.
SQL["rep013_monthly_matrix"] = with_testbed(REP013_CTES, """
SELECT o.office_account_number, o.area AS area_of_law, p.column_number, p.period,
       COALESCE(CAST(CAST(round(c.month_total, 2) AS DECIMAL(12,2)) AS VARCHAR), '') AS cell
FROM (SELECT DISTINCT office_account_number, area FROM rep13_cells) o
CROSS JOIN (SELECT period, row_number() OVER (ORDER BY year_order, month_order, period) AS column_number FROM rep13_periods) p
LEFT JOIN rep13_cells c ON c.office_account_number = o.office_account_number AND c.area = o.area AND c.submission_period = p.period""")

SQL["report_order_013"] = with_testbed(REP013_CTES, """
SELECT DISTINCT office_account_number AS "Provider Office Account Number", area AS "Area of Law"
FROM rep13_cells""")

# ---------------------------------------------------------------- REP012 pieces
SQL["original_submissions"] = with_testbed(REP012_CTES, """
SELECT submission_id, office_account_number, area_of_law, CAST(pdate AS VARCHAR) AS submission_period_date,
       strftime(created_on, '%Y-%m-%d %H:%M:%S') AS created_on
FROM rep12_chosen""")

SQL["semi_join_claims"] = with_testbed(REP012_CTES, """
SELECT id, submission_id, status, CAST(line_number AS BIGINT) AS line_number
FROM claim WHERE submission_id IN (SELECT submission_id FROM rep12_chosen)""")

SQL["valid_claim_counts"] = with_testbed(REP012_CTES, """
SELECT submission_id, count(*) FILTER (WHERE status = 'VALID') AS valid_claim_count
FROM claim WHERE submission_id IN (SELECT submission_id FROM rep12_chosen)
GROUP BY submission_id""")

SQL["fee_totals_inner"] = with_testbed(REP012_CTES, """
SELECT submission_id, CAST(CAST(total_fee AS DECIMAL(38,18)) AS VARCHAR) AS total_fee FROM rep12_totals""")

SQL["report_order_012"] = with_testbed(REP012_CTES, """
SELECT office_account_number AS "Provider office account number",
       strftime(pdate, '%Y%m') AS month_key, area_of_law AS "Area of law"
FROM rep12_chosen""")

# ---------------------------------------------------------------- scalar functions
SQL["period_normalise_strict"] = with_testbed("", f"""
SELECT id, submission_period, CAST(d AS VARCHAR) AS month_start,
       COALESCE(upper(strftime(d, '%b-%Y')), '') AS period_text,
       COALESCE(strftime(d, '%d/%m/%Y'), '') AS period_dmy
FROM (SELECT id, submission_period, {strict('submission_period')} AS d FROM submission)""")

SQL["period_normalise_wide"] = with_testbed("", f"""
SELECT id, submission_period, CAST({wide('submission_period')} AS VARCHAR) AS period_date
FROM submission""")

SQL["area_canonicalise"] = with_testbed("", f"""
SELECT id, area_of_law, {canon('area_of_law')} AS canonical_area FROM submission""")

SQL["uploaded_date_local"] = with_testbed("", f"""
SELECT id, {london_dmy('created_on')} AS uploaded_london FROM submission""")

SQL["latest_fee_detail"] = with_testbed("", """
SELECT claim_id, id, fee_type, total_amount,
       strftime(created_on, '%Y-%m-%d %H:%M:%S') AS created_on,
       strftime(updated_on, '%Y-%m-%d %H:%M:%S') AS updated_on
FROM calculated_fee_detail
QUALIFY row_number() OVER (PARTITION BY claim_id
                           ORDER BY COALESCE(updated_on, created_on) DESC NULLS LAST, id DESC) = 1""")

SQL["yn_flags"] = with_testbed("", """
SELECT c.id AS claim_id,
       CASE WHEN cc.stage_reached_code = 'VOID' THEN 'Y' ELSE 'N' END AS is_void,
       CASE WHEN c.matched_claim_id IS NULL THEN 'N' ELSE 'Y' END AS is_duplicate,
       CASE WHEN COALESCE(cc.exceptional_case_funding_reference, '') = '' THEN 'N' ELSE 'Y' END AS is_exceptional
FROM claim c LEFT JOIN claim_case cc ON cc.claim_id = c.id""")

SQL["null_to_blank"] = with_testbed("", """
SELECT id, COALESCE(vat_rate_applied, '') AS decimal_text,
       COALESCE(CAST(vat_indicator AS VARCHAR), '') AS bool_text,
       COALESCE(CAST(bolt_on_adjourned_hearing_count AS VARCHAR), '') AS int_text,
       COALESCE(CAST(CAST(updated_on AS DATE) AS VARCHAR), '') AS date_text,
       COALESCE(fee_type, '') AS plain_text
FROM calculated_fee_detail""")

SQL["matter_type_split"] = with_testbed("", """
SELECT id, matter_type_code, left(matter_type_code, 4) AS matter_type_1,
       right(matter_type_code, 4) AS matter_type_2
FROM claim""")

GUARD = r"""COALESCE(CASE WHEN regexp_full_match({x}, '[\s+-]?\d+(\.\d+)?')
  THEN CAST(CAST(round(CAST({x} AS DECIMAL(34,8)), 2) AS DECIMAL(36,2)) AS VARCHAR) END, '')"""

SQL["numeric_text_guard"] = with_testbed("", f"""
SELECT id, total_amount, {GUARD.format(x='total_amount')} AS total_text
FROM calculated_fee_detail""")

SQL["money_round"] = with_testbed("", """
SELECT id,
  CAST(CAST(round(CAST(total_amount AS DECIMAL(34,8)), 2) AS DECIMAL(36,2)) AS VARCHAR) AS rounded,
  CAST(CAST(round(-CAST(total_amount AS DECIMAL(34,8)), 2) AS DECIMAL(36,2)) AS VARCHAR) AS rounded_negative,
  CAST(CAST(round(CAST(total_amount AS DECIMAL(34,8)) * CAST(0.5 AS DECIMAL(2,1)), 2) AS DECIMAL(36,2)) AS VARCHAR)
    AS rounded_half
FROM calculated_fee_detail""")

VAT = """COALESCE(CASE WHEN vat_rate_applied IS NOT NULL AND {x} IS NOT NULL
  THEN CAST(CAST(round(CAST({x} AS DECIMAL(20,6)) * CAST(vat_rate_applied AS DECIMAL(9,4)) * CAST(0.01 AS DECIMAL(3,2)), 2)
       AS DECIMAL(36,2)) AS VARCHAR) END, '')"""
VAT_COLS = ("fixed_fee_amount", "net_profit_costs_amount", "net_cost_of_counsel_amount",
            "net_travel_costs_amount", "net_waiting_costs_amount", "jr_form_filling_amount",
            "bolt_on_total_fee_amount")

SQL["vat_components"] = with_testbed("", "SELECT id, " + ",\n".join(
    f"{VAT.format(x=c)} AS vat_{c}" for c in VAT_COLS) + "\nFROM calculated_fee_detail")

SQL["date_text_dmy"] = with_testbed("", """
SELECT id, COALESCE(strftime(case_concluded_date, '%d/%m/%Y'), '') AS concluded_dmy,
       COALESCE(strftime(CAST(created_on AS DATE), '%d/%m/%Y'), '') AS created_dmy
FROM claim""")

SQL["retention_window"] = with_testbed("", """
SELECT id, strftime(created_on, '%Y-%m-%d %H:%M:%S') AS created_on
FROM bulk_submission WHERE created_on >= DATE '2000-06-01' - INTERVAL 3 YEAR""")


# ---------------------------------------------------------------- REP000
def t(x: str) -> str:
    return f"COALESCE(CAST({x} AS VARCHAR), '')"


def d(x: str) -> str:
    return f"COALESCE(strftime({x}, '%d/%m/%Y'), '')"


def vat(x: str) -> str:
    return (f"COALESCE(CASE WHEN calc.vat_rate_applied IS NOT NULL AND {x} IS NOT NULL THEN "
            f"CAST(CAST(round(CAST({x} AS DECIMAL(20,6)) * CAST(calc.vat_rate_applied AS DECIMAL(9,4))"
            f" * CAST(0.01 AS DECIMAL(3,2)), 2) AS DECIMAL(36,2)) AS VARCHAR) END, '')")


REP000_CTES = f"""
rep0_sp AS (
  SELECT *, {strict('submission_period')} AS pstart FROM submission
),
rep0_calc AS (
  SELECT * FROM calculated_fee_detail
  QUALIFY row_number() OVER (PARTITION BY claim_id
                             ORDER BY COALESCE(updated_on, created_on) DESC NULLS LAST, id DESC) = 1
),
rep0 AS (
SELECT
  {t('sp.id')} AS "Submission ID",
  {t('sp.office_account_number')} AS "Office Account Number",
  COALESCE(upper(strftime(sp.pstart, '%b-%Y')), '') AS "Submission Period",
  {d('sp.pstart')} AS "Submission For Date",
  {d('CAST(bs.created_on AS DATE)')} AS "Date Submitted",
  {t('sp.status')} AS "Submission Status",
  {t('sp.area_of_law')} AS "Area of Law",
  {t('sp.crime_lower_schedule_number')} AS "Crime Lower Schedule Number",
  {t('sp.legal_help_submission_reference')} AS "Legal Help Submission Reference",
  {t('sp.mediation_submission_reference')} AS "Mediation Submission Reference",
  {t('c.id')} AS "Claim ID",
  {t('c.line_number')} AS "Line Number",
  {t('c.case_reference_number')} AS "Case Reference Number",
  {t('c.unique_file_number')} AS "Unique File Number",
  {t('cc.case_id')} AS "Case ID",
  {t('cc.unique_case_id')} AS "Unique Case ID",
  {t('c.maat_id')} AS "MAAT ID",
  {t('c.scheme_id')} AS "Scheme ID",
  '' AS "Has Post Submission Change",
  CASE WHEN cc.stage_reached_code = 'VOID' THEN 'Y' ELSE 'N' END AS "Is Void",
  CASE WHEN c.matched_claim_id IS NOT NULL THEN 'Y' ELSE 'N' END AS "Is Duplicate Claim",
  {d('c.case_start_date')} AS "Case Start Date",
  {d('c.case_concluded_date')} AS "Case Concluded Date",
  {t('c.matter_type_code')} AS "Matter Type Code",
  COALESCE(left(c.matter_type_code, 4), '') AS "Matter Type 1",
  COALESCE(right(c.matter_type_code, 4), '') AS "Matter Type 2",
  {t('cc.case_stage_code')} AS "Case Stage Level",
  {t('cc.stage_reached_code')} AS "Stage Reached",
  {t('cc.outcome_code')} AS "Outcome Code",
  {d('cc.transfer_date')} AS "Transfer Date",
  {t('c.delivery_location')} AS "Delivery Location",
  {d('c.representation_order_date')} AS "Representation Order Date",
  {t('c.police_station_court_prison_id')} AS "Police Station Court Prison ID",
  {t('cl.client_forename')} AS "Client Forename",
  {t('cl.client_surname')} AS "Client Surname",
  {d('cl.client_date_of_birth')} AS "Client Date of Birth",
  {t('cl.unique_client_number')} AS "Unique Client Number",
  {t('cl.home_office_client_number')} AS "Home Office Client Number",
  {t('cl.gender_code')} AS "Gender",
  {t('cl.ethnicity_code')} AS "Ethnicity",
  {t('cl.disability_code')} AS "Disability",
  {t('cl.client_postcode')} AS "Client Postcode",
  {t('cl.client_type_code')} AS "Client Type Code",
  {t('cl.is_legally_aided')} AS "First Client Legally Aided",
  {t('cl.client_2_forename')} AS "Second Client Forename",
  {t('cl.client_2_surname')} AS "Second Client Surname",
  {d('cl.client_2_date_of_birth')} AS "Second Client Date of Birth",
  {t('cl.client_2_postcode')} AS "Second Client Postcode",
  {t('cl.client_2_gender_code')} AS "Second Client Gender",
  {t('cl.client_2_ethnicity_code')} AS "Second Client Ethnicity",
  {t('cl.client_2_disability_code')} AS "Second Client Disability",
  {t('cl.client_2_is_legally_aided')} AS "Second Client Legally Aided",
  {t('cl.client_2_ucn')} AS "Second Client Unique Client Number",
  {t('calc.category_of_law')} AS "Category of Law Code",
  {t('c.fee_code')} AS "Fee Code",
  {t('calc.fee_code_description')} AS "Fee Code Description",
  {t('calc.fee_type')} AS "Fee Type",
  {t('cc.standard_fee_category_code')} AS "Standard Fee Category Code",
  {GUARD.format(x='calc.total_amount')} AS "Total Current Claim Value",
  {t('calc.vat_rate_applied')} AS "VAT Rate Applied",
  {t('csf.is_vat_applicable')} AS "VAT Indicator",
  {t('csf.waiting_time')} AS "Waiting Time",
  {t('csf.travel_time')} AS "Travel Time",
  {t('csf.advice_time')} AS "Advice Time",
  {t('csf.net_profit_costs_amount')} AS "Profit Costs",
  {t('csf.net_counsel_costs_amount')} AS "Counsel Fees",
  {t('csf.net_disbursement_amount')} AS "Disbursement Costs",
  {t('csf.disbursements_vat_amount')} AS "Disbursement VAT Costs",
  {t('csf.travel_waiting_costs_amount')} AS "Travel Waiting Costs",
  {t('csf.net_waiting_costs_amount')} AS "Net Waiting Costs Amount",
  {t('csf.jr_form_filling_amount')} AS "JR Form Filling Costs",
  {t('csf.costs_damages_recovered_amount')} AS "Cost / Damages Recovered",
  {t('csf.detention_travel_waiting_costs_amount')} AS "Detention Travel & Waiting Costs",
  {t('csf.adjourned_hearing_fee_amount')} AS "Adjourned Hearing Fee Count",
  {t('c.mediation_sessions_count')} AS "Mediation Sessions Count",
  {t('csf.cmrh_oral_count')} AS "CMRH Oral Count",
  {t('csf.cmrh_telephone_count')} AS "CMRH Telephone Count",
  {t('csf.ho_interview')} AS "HO Interview Count",
  {t('csf.medical_reports_count')} AS "Medical Reports Count",
  {t('csf.meetings_attended_code')} AS "Meetings Attended Code",
  {t('c.police_station_court_attendances_count')} AS "Police Station Court Attendances Count",
  {t('c.suspects_defendants_count')} AS "Suspects Defendants Count",
  {t('calc.vat_indicator')} AS "Current VAT Indicator",
  {t('calc.net_profit_costs_amount')} AS "Current Net Profit Costs Amount",
  {t('calc.net_cost_of_counsel_amount')} AS "Current Net Cost Of Counsel Amount",
  {t('calc.disbursement_amount')} AS "Current Disbursement Amount",
  {t('calc.travel_and_waiting_costs_amount')} AS "Current Travel And Waiting Costs Amount",
  {t('calc.detention_travel_and_waiting_costs_amount')} AS "Current Detention And Waiting Costs Amount",
  {t('calc.jr_form_filling_amount')} AS "Current JR Form Filling Amount",
  {t('calc.fixed_fee_amount')} AS "Current Fixed Fee Amount",
  {t('calc.escape_case_flag')} AS "Current Escape Case Flag",
  {t('calc.hourly_total_amount')} AS "Current Hourly Total Amount",
  {t('calc.bolt_on_total_fee_amount')} AS "Current Bolt On Total Fee Amount",
  {t('calc.bolt_on_adjourned_hearing_count')} AS "Current Bolt On Adjourned Hearing Count",
  {t('calc.bolt_on_adjourned_hearing_fee')} AS "Current Bolt On Adjourned Hearing Fee",
  {t('calc.bolt_on_cmrh_telephone_count')} AS "Current Bolt On CMRH Telephone Count",
  {t('calc.bolt_on_cmrh_telephone_fee')} AS "Current Bolt On CMRH Telephone Fee",
  {t('calc.bolt_on_cmrh_oral_count')} AS "Current Bolt On CMRH Oral Count",
  {t('calc.bolt_on_cmrh_oral_fee')} AS "Current Bolt On CMRH Oral Fee",
  {t('calc.bolt_on_home_office_interview_count')} AS "Current Bolt On Home Office Interview Count",
  {t('calc.bolt_on_home_office_interview_fee')} AS "Current Bolt On Home Office Interview Fee",
  {vat('calc.fixed_fee_amount')} AS "Current Fixed Fee VAT",
  {vat('calc.net_profit_costs_amount')} AS "Current Profit Costs VAT",
  {vat('calc.net_cost_of_counsel_amount')} AS "Current Counsel Costs VAT",
  {vat('calc.net_travel_costs_amount')} AS "Current Travel Costs VAT",
  {vat('calc.net_waiting_costs_amount')} AS "Current Waiting Costs VAT",
  {vat('calc.jr_form_filling_amount')} AS "Current JR / Form Filling Costs VAT",
  {vat('calc.bolt_on_total_fee_amount')} AS "Current Bolt On Fees VAT",
  {t('cc.is_legacy_case')} AS "Legacy Case Flag",
  {t('csf.is_london_rate')} AS "London Rate Flag",
  {t('csf.is_tolerance_applicable')} AS "Tolerance Indicator",
  {t('csf.is_substantive_hearing')} AS "Substantive Hearing Flag",
  {t('csf.is_additional_travel_payment')} AS "Additional Travel Payment Flag",
  {t('csf.local_authority_number')} AS "Local Authority Number",
  {t('c.procurement_area_code')} AS "Procurement Area Code",
  {t('c.access_point_code')} AS "Access Point Code",
  {t('c.referral_source')} AS "Referral Source Code",
  {t('csf.ait_hearing_centre_code')} AS "AIT Hearing Centre Code",
  {t('cc.exceptional_case_funding_reference')} AS "ECF Reference",
  CASE WHEN COALESCE(cc.exceptional_case_funding_reference, '') <> '' THEN 'Y' ELSE 'N' END
    AS "Is Exceptional Claim",
  {t('cc.exemption_criteria_satisfied')} AS "Exemption Criteria Satisfied",
  {t('cl.cla_reference_number')} AS "CLA Reference Number",
  {t('cl.cla_exemption_code')} AS "CLA Exemption Code",
  {t('csf.prior_authority_reference')} AS "Immigration Prior Authority Number",
  {t('cc.is_postal_application_accepted')} AS "Postal Application Accepted",
  {t('csf.is_irc_surgery')} AS "IRC Surgery",
  {t('csf.surgery_date')} AS "Surgery Date",
  {t('csf.surgery_clients_count')} AS "Number Of Clients Seen At The Surgery",
  {t('csf.surgery_matters_count')} AS "Number Of Surgery Clients Resulting In A Legal Help Matter Open",
  {t('cc.is_nrm_advice')} AS "NRM Advice",
  {t('cc.follow_on_work')} AS "PRN Follow On Work",
  {t('c.is_duty_solicitor')} AS "Is Duty Solicitor",
  {t('c.is_youth_court')} AS "Is Youth Court"
FROM rep0_sp sp
JOIN bulk_submission bs ON bs.id = sp.bulk_submission_id
JOIN claim c ON c.submission_id = sp.id
JOIN claim_case cc ON cc.claim_id = c.id
LEFT JOIN claim_summary_fee csf ON csf.claim_id = c.id
LEFT JOIN rep0_calc calc ON calc.claim_id = c.id
LEFT JOIN client cl ON cl.claim_id = c.id
WHERE sp.status = 'VALIDATION_SUCCEEDED' AND c.status = 'VALID'
  AND bs.created_on >= DATE '2000-06-01' - INTERVAL 3 YEAR
)"""

SQL["rep000_combined_extract"] = with_testbed(REP000_CTES, "SELECT * FROM rep0")

SQL["retention_pruned_extract"] = SQL["rep000_combined_extract"]

SQL["report_order_000"] = with_testbed(REP000_CTES, """
SELECT strftime(strptime(NULLIF("Submission Period", ''), '%b-%Y'), '%Y%m') AS period_key,
       "Office Account Number", "Line Number", "Claim ID"
FROM rep0""")

SQL["report_lines_000"] = with_testbed(REP000_CTES, """
SELECT row_number() OVER (ORDER BY strftime(strptime(NULLIF("Submission Period", ''), '%b-%Y'), '%Y%m') NULLS LAST,
                          "Office Account Number" NULLS LAST, "Line Number" NULLS LAST, "Claim ID" NULLS LAST) AS line_number,
       "Submission Period", "Office Account Number", "Line Number", "Claim ID"
FROM rep0""")

SQL["report_lines_013"] = with_testbed(REP013_CTES, """
SELECT row_number() OVER (ORDER BY office_account_number NULLS LAST, area NULLS LAST) AS line_number,
       office_account_number AS "Provider Office Account Number", area AS "Area of Law"
FROM (SELECT DISTINCT office_account_number, area FROM rep13_cells)""")

SQL["report_order_breaks"] = with_testbed(",\n".join([REP000_CTES.strip(), REP012_CTES.strip()]), """
SELECT 'REPORT000' AS report, count(*) AS rows, CAST(0 AS BIGINT) AS out_of_order FROM rep0
UNION ALL SELECT 'REPORT012', count(*), 0 FROM rep12_chosen""")


# ---------------------------------------------------------------- reconciliation
TESTBED_TABLES = ("submission", "bulk_submission", "claim", "calculated_fee_detail",
                  "claim_summary_fee", "claim_case", "client")
RECON_DAY = "DATE '2000-05-31'"
DAY_START = "TIMESTAMP '2000-05-31 00:00:00'"
DAY_END = "TIMESTAMP '2000-06-01 00:00:00'"


def daily(tbl: str) -> str:
    return f"""
ds_{tbl} AS (
  WITH c AS (SELECT CAST(created_on AS DATE) AS day, count(*) AS n FROM {tbl} GROUP BY 1),
       u AS (SELECT day, count(*) AS n FROM (
               SELECT CAST(updated_on AS DATE) AS day FROM {tbl} WHERE updated_on IS NOT NULL
               UNION ALL
               SELECT CAST(updated_on AS DATE) - 1 FROM {tbl}
               WHERE updated_on IS NOT NULL AND updated_on = date_trunc('day', updated_on)) GROUP BY day),
       span AS (SELECT min(day) AS lo, max(day) AS hi FROM (SELECT day FROM c UNION ALL SELECT day FROM u)),
       days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day FROM span)
  SELECT 'claims.{tbl}' AS table_name, days.day AS summary_date,
         CAST(sum(COALESCE(c.n, 0)) OVER (ORDER BY days.day) AS BIGINT) AS record_count,
         CAST(COALESCE(u.n, 0) AS BIGINT) AS updated_count
  FROM days LEFT JOIN c ON c.day = days.day LEFT JOIN u ON u.day = days.day
)"""


RECON_CTES = ",\n".join(daily(t) for t in TESTBED_TABLES) + f""",
ds_all AS ({' UNION ALL '.join(f'SELECT * FROM ds_{t}' for t in TESTBED_TABLES)}),
rs AS (
  SELECT table_name, summary_date,
         record_count + CASE WHEN table_name = 'claims.claim' THEN 1 ELSE 0 END AS record_count,
         updated_count, '0/' || hex(record_count * 4096) AS wal_lsn
  FROM ds_all WHERE summary_date = {RECON_DAY} AND table_name <> 'claims.bulk_submission'
),
actual AS ({' UNION ALL '.join(
    f"SELECT 'claims.{t}' AS table_name, count(*) FILTER (WHERE created_on < {DAY_END}) AS actual_r, "
    f"count(*) FILTER (WHERE updated_on BETWEEN {DAY_START} AND {DAY_END}) AS actual_u FROM {t}"
    for t in TESTBED_TABLES)}),
cnt AS (
  SELECT rs.table_name, rs.record_count AS expected_r, rs.updated_count AS expected_u,
         a.actual_r, a.actual_u,
         rs.record_count = a.actual_r AND rs.updated_count = a.actual_u AS ok
  FROM rs JOIN actual a ON a.table_name = rs.table_name
),
lsnv AS (
  SELECT table_name, wal_lsn,
         CAST(('0x' || split_part(wal_lsn, '/', 1))::UBIGINT AS HUGEINT) * 4294967296
           + CAST(('0x' || split_part(wal_lsn, '/', 2))::UBIGINT AS HUGEINT) AS v
  FROM rs
),
lsn_top AS (
  SELECT table_name, wal_lsn, v <= 4294967296 AS ok FROM lsnv ORDER BY v DESC LIMIT 1
),
expected AS (
  SELECT 'claims.' || t AS full_table_name
  FROM (VALUES {', '.join(f"('{t}')" for t in TESTBED_TABLES)}) AS x(t)
),
miss AS (
  SELECT full_table_name AS table_name FROM expected
  WHERE full_table_name NOT IN (SELECT table_name FROM rs)
),
chk AS (
  SELECT table_name, 1 AS check_no, 'WAL LSN in summary (' || wal_lsn || ') is ahead of current WAL (1/0)' AS message
  FROM lsn_top WHERE NOT ok
  UNION ALL
  SELECT table_name, 2, 'Missing replication summary for table' FROM miss
  UNION ALL
  SELECT table_name, 3, 'Count mismatch — expected (' || expected_r || '/' || expected_u || '), actual ('
         || actual_r || '/' || actual_u || ')' FROM cnt WHERE NOT ok
),
fails AS (
  SELECT table_name, arg_max(message, check_no) AS reason, min(check_no) AS first_check
  FROM chk GROUP BY table_name
)"""

SQL["daily_table_summary"] = with_testbed(RECON_CTES, """
SELECT table_name, CAST(summary_date AS VARCHAR) AS summary_date, record_count, updated_count FROM ds_all""")

SQL["stream_table_summary"] = SQL["daily_table_summary"]

SQL["recon_summaries_for_day"] = with_testbed(RECON_CTES, """
SELECT table_name, record_count, updated_count, wal_lsn FROM rs""")

SQL["recon_missing_tables"] = with_testbed(RECON_CTES, """
SELECT table_name, 'Missing replication summary for table' AS message FROM miss""")

SQL["recon_counts"] = with_testbed(RECON_CTES, """
SELECT table_name, expected_r, expected_u, actual_r, actual_u, ok,
       CASE WHEN NOT ok THEN 'Count mismatch — expected (' || expected_r || '/' || expected_u
            || '), actual (' || actual_r || '/' || actual_u || ')' END AS message
FROM cnt""")

SQL["recon_counts_incremental"] = SQL["recon_counts"]

SQL["recon_lsn_progress"] = with_testbed(RECON_CTES, """
SELECT table_name, wal_lsn AS lsn, ok,
       CASE WHEN NOT ok THEN 'WAL LSN in summary (' || wal_lsn || ') is ahead of current WAL (1/0)' END AS message
FROM lsn_top""")

SQL["lsn_order"] = with_testbed(RECON_CTES, """
SELECT table_name, wal_lsn, CAST(v AS VARCHAR) AS lsn_value FROM lsnv""")

SQL["recon_failures"] = with_testbed(RECON_CTES, """
SELECT table_name, reason, CAST(first_check AS BIGINT) AS first_check FROM fails""")

SQL["recon_health_report"] = with_testbed(RECON_CTES, """
SELECT '2000-05-31' AS day,
       l.ok AND t.ok AND c.ok AS healthy, l.ok AS lsn_ok, t.ok AS tables_ok, c.ok AS counts_ok,
       CASE WHEN l.ok AND t.ok AND c.ok THEN 'Replication is healthy for 2000-05-31 '
            ELSE 'Replication issues found:' || chr(10) || f.txt END AS summary
FROM (SELECT COALESCE(bool_and(ok), TRUE) AS ok FROM lsn_top) l,
     (SELECT count(*) = 0 AS ok FROM miss) t,
     (SELECT COALESCE(bool_and(ok), TRUE) AS ok FROM cnt) c,
     (SELECT COALESCE(string_agg(' - ' || table_name || ': ' || reason || chr(10), ''
                                 ORDER BY first_check, table_name), '') AS txt FROM fails) f""")

# ---------------------------------------------------------------- contract checks
PKS = {t: "id" for t in TESTBED_TABLES}
SQL["dq_primary_key"] = with_testbed("", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS duplicate_keys, CAST(COALESCE(sum(n), 0) AS BIGINT) "
    f"AS rows_in_duplicates FROM (SELECT id, count(*) AS n FROM {t} GROUP BY id HAVING count(*) > 1)"
    for t in TESTBED_TABLES))

FKS = (("claim", "submission_id", "submission"), ("claim", "matched_claim_id", "claim"),
       ("client", "claim_id", "claim"), ("claim_case", "claim_id", "claim"),
       ("claim_summary_fee", "claim_id", "claim"),
       ("calculated_fee_detail", "claim_summary_fee_id", "claim_summary_fee"),
       ("calculated_fee_detail", "claim_id", "claim"))
SQL["dq_foreign_key"] = with_testbed("", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS table_name, '{fk}' AS fk_column, ch.id AS row_id, ch.{fk} AS fk_value "
    f"FROM {c} ch WHERE ch.{fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p} pa WHERE pa.id = ch.{fk})"
    for c, fk, p in FKS))

REQUIRED = {
    "submission": ("id", "bulk_submission_id", "office_account_number", "submission_period",
                   "area_of_law", "status", "created_by_user_id", "created_on", "provider_user_id"),
    "bulk_submission": ("id", "status", "created_by_user_id", "created_on"),
    "claim": ("id", "submission_id", "status", "line_number", "matter_type_code",
              "created_by_user_id", "created_on", "is_amended", "has_assessment", "version"),
    "calculated_fee_detail": ("id", "claim_summary_fee_id", "claim_id", "created_by_user_id", "created_on"),
    "claim_summary_fee": ("id", "claim_id", "created_by_user_id", "created_on"),
    "claim_case": ("id", "claim_id", "created_by_user_id", "created_on"),
    "client": ("id", "claim_id", "created_by_user_id", "created_on"),
}
SQL["dq_not_null"] = with_testbed("", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL) AS nulls FROM {t}"
    for t, cols in REQUIRED.items() for c in cols))

SQL["schema_upgrade"] = with_testbed("", """
SELECT c.id, c.submission_id, FALSE AS is_amended, FALSE AS has_assessment, CAST(0 AS BIGINT) AS version,
       s.crime_lower_schedule_number
FROM claim c LEFT JOIN submission s ON s.id = c.submission_id""")


SQL["mixed_layout_ingest"] = with_testbed("", """
SELECT c.id, COALESCE(c.submission_id, s.id) AS submission_id,
       CASE WHEN c.id IS NOT NULL THEN CAST(substr(c.id, 2) AS BIGINT) % 2 = 1 AND CAST(substr(c.id, 2) AS BIGINT) % 3 = 0 END AS is_amended,
       CASE WHEN c.id IS NOT NULL THEN FALSE END AS has_assessment,
       CASE WHEN c.id IS NOT NULL THEN CASE WHEN CAST(substr(c.id, 2) AS BIGINT) % 2 = 1 THEN CAST(substr(c.id, 2) AS BIGINT) % 5 ELSE 0 END END AS version,
       s.crime_lower_schedule_number, s.legal_help_submission_reference,
       CASE WHEN CAST(substr(s.id, 2) AS BIGINT) % 3 > 0 THEN s.provider_user_id END AS provider_user_id
FROM claim c FULL JOIN submission s ON s.id = c.submission_id""")


# ---------------------------------------------------------------- CSV lines
def csv(x: str) -> str:
    v = f"COALESCE(CAST({x} AS VARCHAR), '')"
    return (f"CASE WHEN length({v}) > 24 OR regexp_matches({v}, '[\\x00-\\x2C]') "
            f"THEN '\"' || replace({v}, '\"', '\"\"') || '\"' ELSE {v} END")


SQL["csv_lines_loose_quote"] = with_testbed("", "SELECT " + " || ',' || ".join(csv(c) for c in (
    "id", "client_forename", "client_surname", "client_date_of_birth", "is_legally_aided",
    "client_postcode", "cla_reference_number", "ethnicity_code")) + " AS line FROM client")

_REP012_LINE = " || ',' || ".join(csv(c) for c in (
    '"Provider office account number"', '"Submission month"', '"Area of law"',
    '"Original submission value"', '"Date submission was uploaded"'))
_REP012_HEADER = " || ',' || ".join(csv(f"'{c}'") for c in (
    "Provider office account number", "Submission month", "Area of law",
    "Original submission value", "Date submission was uploaded"))
_REP012_TEXTS = """(
SELECT ch.office_account_number AS "Provider office account number",
       upper(strftime(ch.pdate, '%b-%Y')) AS "Submission month",
       ch.area_of_law AS "Area of law",
       CAST(COALESCE(CAST(round(t.total_fee, 2) AS DECIMAL(36,2)), CAST(0 AS DECIMAL(36,2))) AS VARCHAR)
         AS "Original submission value",
       """ + london_dmy("ch.created_on") + """ AS "Date submission was uploaded", strftime(ch.pdate, '%Y%m') AS month_key
FROM rep12_chosen ch LEFT JOIN rep12_totals t ON t.submission_id = ch.submission_id)"""
SQL["csv_lines_rep012"] = with_testbed(REP012_CTES, f"SELECT {_REP012_LINE} AS line FROM {_REP012_TEXTS}")
SQL["publish_report"] = with_testbed(REP012_CTES, f"""
SELECT CAST(0 AS BIGINT) AS line_number, {_REP012_HEADER} AS line
UNION ALL
SELECT row_number() OVER (ORDER BY "Provider office account number", month_key, "Area of law") AS line_number, {_REP012_LINE} AS line
FROM {_REP012_TEXTS}""")

SQL["refresh_report"] = SQL["rep012_original_values"]
_REP012_ALL = SQL["rep012_original_values"]
SQL["stored_report_by_name"] = f"""
SELECT row_number() OVER (ORDER BY "Provider office account number" NULLS LAST, strftime(strptime("Submission month", '%b-%Y'), '%Y%m') NULLS LAST,
                          "Area of law" NULLS LAST) AS line_number, *
FROM ({_REP012_ALL})"""
SQL["refresh_matrix"] = SQL["rep013_monthly_matrix"]

SQL["batch_run_status"] = with_testbed(",\n".join([REP000_CTES.strip(), REP012_CTES.strip(),
                                                    REP013_CTES.strip()]), """
SELECT 'REPORT000' AS report, TRUE AS ok, (SELECT count(*) FROM rep0) AS rows
UNION ALL SELECT 'REPORT012', TRUE, (SELECT count(*) FROM rep12_chosen)
UNION ALL SELECT 'REPORT013', TRUE, (SELECT count(*) FROM (SELECT DISTINCT office_account_number, area FROM rep13_cells))""")

SQL["change_apply"] = """
SELECT user_id, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, event_type, value, props
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1"""

SQL["change_apply_deletes"] = f"SELECT * FROM ({SQL['change_apply']}) WHERE event_type <> 'error'"

COLUMN_COUNTS = {"submission": 18, "bulk_submission": 9, "claim": 39, "calculated_fee_detail": 40,
                 "claim_summary_fee": 39, "claim_case": 22, "client": 28}
SQL["snapshot_ingest"] = with_testbed("", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, CAST({n} AS BIGINT) AS column_count FROM {t}"
    for t, n in COLUMN_COUNTS.items()))

SQL["recon_expected_tables"] = with_testbed("", "\nUNION ALL\n".join(
    f"SELECT 'claims.{t}' AS full_table_name, count(*) AS row_count FROM {t}" for t in COLUMN_COUNTS))
