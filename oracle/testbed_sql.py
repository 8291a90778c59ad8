"""DuckDB side of the claims-shaped testbed (same formulas as
``claimsflow.sources.testbed``, written separately in SQL).

Every oracle query starts ``WITH`` + :data:`TESTBED` and then its own CTEs.
Every column that a report reads is filled, each by a modulus of its own.
"""

SUBMISSION = r"""
submission AS (
  SELECT
    'S' || lpad(CAST(o_orderkey AS VARCHAR), 10, '0') AS id,
    'B' || lpad(CAST(o_orderkey // 10 AS VARCHAR), 9, '0') AS bulk_submission_id,
    'OA' || lpad(CAST(o_custkey % 40 AS VARCHAR), 3, '0') AS office_account_number,
    CASE
      WHEN o_orderstatus = 'P' AND o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN o_orderstatus = 'P' THEN 'UNKNOWN'
      WHEN o_orderkey % 8 >= 6 THEN strftime(o_orderdate, '%Y-%m')
      ELSE upper(strftime(o_orderdate, '%b-%Y'))
    END AS submission_period,
    CASE
      WHEN o_orderkey % 5 = 0 THEN 'CIVIL'
      WHEN o_orderkey % 5 = 1 AND o_orderkey % 3 = 0 THEN 'crime lower'
      WHEN o_orderkey % 5 = 1 THEN 'CRIME LOWER'
      WHEN o_orderkey % 5 = 2 THEN 'MEDIATION'
      WHEN o_orderkey % 5 = 3 THEN 'LEGAL HELP'
      WHEN o_orderkey % 2 = 1 THEN 'Legal Help'
      ELSE 'OTHER'
    END AS area_of_law,
    CASE WHEN o_orderstatus = 'P' THEN 'VALIDATION_FAILED' ELSE 'VALIDATION_SUCCEEDED' END AS status,
    CASE WHEN o_orderkey % 5 = 1 THEN 'CSN' || lpad(CAST(o_custkey % 97 AS VARCHAR), 3, '0') END
      AS crime_lower_schedule_number,
    CASE WHEN o_orderkey % 7 = 0 AND o_orderkey > 0
         THEN 'S' || lpad(CAST(o_orderkey - 1 AS VARCHAR), 10, '0') END AS previous_submission_id,
    CASE WHEN o_orderkey % 11 = 0 THEN TRUE WHEN o_orderkey % 13 = 0 THEN NULL ELSE FALSE END
      AS is_nil_submission,
    o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
      + to_minutes(CAST((o_orderkey % 2) * 30 AS INTEGER)) AS created_on,
    CASE WHEN o_orderkey % 3 = 0 THEN o_orderdate + to_hours(CAST(o_orderkey % 24 AS INTEGER))
      + to_minutes(CAST((o_orderkey % 2) * 30 AS INTEGER)) + to_days(1) END AS updated_on,
    CASE WHEN o_orderkey % 5 = 3 THEN 'LH' || CAST(o_orderkey AS VARCHAR) END
      AS legal_help_submission_reference,
    CASE WHEN o_orderkey % 5 = 2 THEN 'MED' || CAST(o_orderkey AS VARCHAR) END
      AS mediation_submission_reference,
    'loader' AS created_by_user_id,
    'provider' || CAST(o_custkey % 40 AS VARCHAR) AS provider_user_id
  FROM orders
)"""

BULK = r"""
bulk_submission AS (
  SELECT bulk_submission_id AS id, 'READY_FOR_PARSING' AS status, 'loader' AS created_by_user_id,
         arg_min(created_on, id) AS created_on, CAST(NULL AS TIMESTAMP) AS updated_on
  FROM submission GROUP BY bulk_submission_id
)"""

CLAIM = r"""
claim_grp AS (
  SELECT l_orderkey, l_linenumber, count(*) AS n, min(l_shipdate) AS first_ship,
         max(l_shipdate) AS last_ship, min(l_returnflag) AS min_flag, min(l_partkey) AS partkey,
         l_orderkey * 10 + l_linenumber AS num
  FROM lineitem GROUP BY l_orderkey, l_linenumber
),
claim AS (
  SELECT
    'C' || lpad(CAST(num AS VARCHAR), 11, '0') AS id,
    'S' || lpad(CAST(l_orderkey AS VARCHAR), 10, '0') AS submission_id,
    CASE WHEN min_flag = 'R' THEN 'INVALID' ELSE 'VALID' END AS status,
    l_linenumber AS line_number,
    'CRN' || CAST(l_orderkey AS VARCHAR) AS case_reference_number,
    CASE WHEN l_orderkey % 2 = 1 THEN 'UFN' || CAST(l_linenumber AS VARCHAR) END AS unique_file_number,
    CAST(first_ship AS DATE) AS case_start_date,
    CASE WHEN last_ship > first_ship THEN CAST(last_ship AS DATE) END AS case_concluded_date,
    CASE WHEN l_linenumber % 2 = 0 THEN 'MT' || CAST(partkey % 1000 AS VARCHAR)
         ELSE 'MT' || lpad(CAST(partkey % 1000 AS VARCHAR), 3, '0') END AS matter_type_code,
    'FEE' || CAST(l_linenumber AS VARCHAR) AS fee_code,
    CAST(n AS INTEGER) AS suspects_defendants_count,
    l_linenumber % 2 = 0 AS is_duty_solicitor,
    CASE WHEN l_linenumber % 3 = 0 THEN l_linenumber END AS mediation_sessions_count,
    CASE WHEN n > 1 AND l_linenumber > 1 THEN 'C' || lpad(CAST(num - 1 AS VARCHAR), 11, '0') END
      AS matched_claim_id,
    CASE WHEN l_orderkey % 4 = 0 THEN 'MAAT' || CAST(l_orderkey AS VARCHAR) END AS maat_id,
    CASE WHEN num % 3 <> 0 THEN 'SCH' || CAST(num % 11 AS VARCHAR) END AS scheme_id,
    CASE WHEN num % 4 <> 0 THEN CAST(last_ship AS DATE) END AS representation_order_date,
    CASE WHEN num % 5 <> 0 THEN 'LOC' || CAST(num % 13 AS VARCHAR) END AS delivery_location,
    CASE WHEN num % 3 <> 0 THEN 'PS' || CAST(num % 101 AS VARCHAR) END AS police_station_court_prison_id,
    CASE WHEN num % 4 <> 0 THEN CAST(num % 7 AS INTEGER) END AS police_station_court_attendances_count,
    CASE WHEN num % 6 <> 0 THEN 'PA' || CAST(num % 17 AS VARCHAR) END AS procurement_area_code,
    CASE WHEN num % 5 <> 0 THEN 'AP' || CAST(num % 19 AS VARCHAR) END AS access_point_code,
    CASE WHEN num % 7 <> 0 THEN 'RS' || CAST(num % 23 AS VARCHAR) END AS referral_source,
    CASE WHEN num % 3 <> 0 THEN num % 5 = 1 END AS is_youth_court,
    'loader' AS created_by_user_id,
    first_ship AS created_on,
    CASE WHEN last_ship > first_ship THEN last_ship END AS updated_on,
    FALSE AS is_amended, FALSE AS has_assessment, CAST(0 AS BIGINT) AS version
  FROM claim_grp
)"""

FEE = r"""
calculated_fee_detail AS (
  SELECT
    'C' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 11, '0') || '-' || CAST(row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_extendedprice, l_partkey, l_suppkey, l_quantity, l_discount, l_tax
    ) AS VARCHAR) AS id,
    'X' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 11, '0') AS claim_summary_fee_id,
    'C' || lpad(CAST(l_orderkey * 10 + l_linenumber AS VARCHAR), 11, '0') AS claim_id,
    'Type' || l_returnflag AS fee_type,
    'loader' AS created_by_user_id,
    l_shipdate AS created_on,
    CASE WHEN l_discount >= 0.05 THEN l_shipdate + to_days(CAST(l_partkey % 30 AS INTEGER)) END AS updated_on,
    'Description ' || CAST(l_linenumber AS VARCHAR) AS fee_code_description,
    CASE WHEN l_partkey % 2 = 0 THEN 'CRIME LOWER' ELSE 'LEGAL HELP' END AS category_of_law,
    CASE WHEN l_linenumber = 7
         THEN CAST(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))) AS DECIMAL(18,4)) AS VARCHAR)
         ELSE CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l_discount AS DECIMAL(18,2))), 2) AS DECIMAL(18,2)) AS VARCHAR)
    END AS total_amount,
    CAST(l_tax AS DECIMAL(18,2)) > 0 AS vat_indicator,
    CASE WHEN CAST(l_tax AS DECIMAL(18,2)) > 0
         THEN CAST(CAST(CAST(l_tax AS DECIMAL(18,2)) * 100 AS DECIMAL(18,2)) AS VARCHAR) END AS vat_rate_applied,
    CASE WHEN l_linenumber % 2 = 1 THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS fixed_fee_amount,
    CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS VARCHAR)
      AS net_profit_costs_amount,
    CASE WHEN l_tax >= 0.04 THEN CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS VARCHAR) END
      AS net_cost_of_counsel_amount,
    CASE WHEN l_quantity > 25 THEN CAST(CAST(l_quantity AS DECIMAL(18,2)) AS VARCHAR) END AS net_travel_costs_amount,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 4 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 211 AS VARCHAR) || '.' || lpad(CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 97 AS VARCHAR), 2, '0') END AS net_waiting_costs_amount,
    CASE WHEN l_linenumber = 1 THEN '0' END AS jr_form_filling_amount,
    CASE WHEN l_returnflag = 'A' THEN '12.5' END AS bolt_on_total_fee_amount,
    CAST(CAST(round(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(18,2)), 2) AS DECIMAL(18,2)) AS VARCHAR)
      AS disbursement_amount,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 3 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 223 AS VARCHAR) || '.' || lpad(CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 97 AS VARCHAR), 2, '0') END AS travel_and_waiting_costs_amount,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 5 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 227 AS VARCHAR) || '.' || lpad(CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 97 AS VARCHAR), 2, '0') END AS detention_travel_and_waiting_costs_amount,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 2 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 229 AS VARCHAR) || '.' || lpad(CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 97 AS VARCHAR), 2, '0') END AS hourly_total_amount,
    CASE WHEN l_returnflag = 'A' THEN 1 END AS bolt_on_adjourned_hearing_count,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 6 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 233 AS VARCHAR) || '.' || lpad(CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 97 AS VARCHAR), 2, '0') END AS bolt_on_adjourned_hearing_fee,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 4 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 5 AS INTEGER) END AS bolt_on_cmrh_telephone_count,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 7 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 239 AS VARCHAR) || '.' || lpad(CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 97 AS VARCHAR), 2, '0') END AS bolt_on_cmrh_telephone_fee,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 5 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 6 AS INTEGER) END AS bolt_on_cmrh_oral_count,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 3 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 241 AS VARCHAR) || '.' || lpad(CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 97 AS VARCHAR), 2, '0') END AS bolt_on_cmrh_oral_fee,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 6 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 8 AS INTEGER) END AS bolt_on_home_office_interview_count,
    CASE WHEN (l_orderkey * 10 + l_linenumber + l_partkey) % 4 <> 0 THEN CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 251 AS VARCHAR) || '.' || lpad(CAST((l_orderkey * 10 + l_linenumber + l_partkey) % 97 AS VARCHAR), 2, '0') END AS bolt_on_home_office_interview_fee,
    l_linestatus = 'F' AS escape_case_flag
  FROM lineitem
)"""

SUMMARY_FEE = r"""
claim_summary_fee AS (
  SELECT
    'X' || lpad(CAST(g.num AS VARCHAR), 11, '0') AS id,
    'C' || lpad(CAST(g.num AS VARCHAR), 11, '0') AS claim_id,
    CAST(g.n * 10 AS INTEGER) AS advice_time,
    g.l_linenumber * 5 AS travel_time,
    CASE WHEN g.l_orderkey % 3 = 0 THEN 15 END AS waiting_time,
    CAST(s.sum_price AS VARCHAR) AS net_profit_costs_amount,
    CASE WHEN g.l_linenumber = 2 THEN '200' END AS net_disbursement_amount,
    CASE WHEN g.l_linenumber = 3 THEN '500.00' END AS net_counsel_costs_amount,
    CASE WHEN g.num % 3 <> 0 THEN CAST(g.num % 257 AS VARCHAR) || '.' || lpad(CAST(g.num % 97 AS VARCHAR), 2, '0') END AS disbursements_vat_amount,
    CASE WHEN g.num % 4 <> 0 THEN CAST(g.num % 263 AS VARCHAR) || '.' || lpad(CAST(g.num % 97 AS VARCHAR), 2, '0') END AS travel_waiting_costs_amount,
    CASE WHEN g.num % 5 <> 0 THEN CAST(g.num % 269 AS VARCHAR) || '.' || lpad(CAST(g.num % 97 AS VARCHAR), 2, '0') END AS net_waiting_costs_amount,
    g.l_orderkey % 2 = 0 AS is_vat_applicable,
    CASE WHEN g.l_orderkey % 3 = 0 THEN FALSE END AS is_tolerance_applicable,
    CASE WHEN g.num % 6 <> 0 THEN 'PRI' || CAST(g.num % 29 AS VARCHAR) END AS prior_authority_reference,
    g.l_linenumber = 1 AS is_london_rate,
    CASE WHEN g.l_linenumber = 4 THEN 2 END AS adjourned_hearing_fee_amount,
    CASE WHEN g.num % 3 <> 0 THEN g.num % 4 = 1 END AS is_additional_travel_payment,
    CASE WHEN g.num % 7 <> 0 THEN CAST(g.num % 271 AS VARCHAR) || '.' || lpad(CAST(g.num % 97 AS VARCHAR), 2, '0') END AS costs_damages_recovered_amount,
    CASE WHEN g.num % 4 <> 0 THEN 'MTG' || CAST(g.num % 31 AS VARCHAR) END AS meetings_attended_code,
    CASE WHEN g.num % 5 <> 0 THEN CAST(g.num % 277 AS VARCHAR) || '.' || lpad(CAST(g.num % 97 AS VARCHAR), 2, '0') END AS detention_travel_waiting_costs_amount,
    CASE WHEN g.num % 3 <> 0 THEN CAST(g.num % 281 AS VARCHAR) || '.' || lpad(CAST(g.num % 97 AS VARCHAR), 2, '0') END AS jr_form_filling_amount,
    CASE WHEN g.num % 6 <> 0 THEN CAST(g.num % 9 AS INTEGER) END AS medical_reports_count,
    CASE WHEN g.num % 5 <> 0 THEN g.num % 6 = 1 END AS is_irc_surgery,
    CASE WHEN g.l_linenumber = 5 THEN CAST(g.first_ship AS DATE) END AS surgery_date,
    CASE WHEN g.num % 4 <> 0 THEN CAST(g.num % 10 AS INTEGER) END AS surgery_clients_count,
    CASE WHEN g.num % 7 <> 0 THEN CAST(g.num % 11 AS INTEGER) END AS surgery_matters_count,
    CASE WHEN g.num % 3 <> 0 THEN CAST(g.num % 12 AS INTEGER) END AS cmrh_oral_count,
    CASE WHEN g.num % 5 <> 0 THEN CAST(g.num % 13 AS INTEGER) END AS cmrh_telephone_count,
    CASE WHEN g.num % 6 <> 0 THEN 'AIT' || CAST(g.num % 37 AS VARCHAR) END AS ait_hearing_centre_code,
    CASE WHEN g.num % 4 <> 0 THEN g.num % 7 = 1 END AS is_substantive_hearing,
    CASE WHEN g.num % 7 <> 0 THEN CAST(g.num % 14 AS INTEGER) END AS ho_interview,
    CASE WHEN g.num % 5 <> 0 THEN 'LA' || CAST(g.num % 41 AS VARCHAR) END AS local_authority_number,
    'loader' AS created_by_user_id,
    g.first_ship AS created_on,
    CAST(NULL AS TIMESTAMP) AS updated_on
  FROM claim_grp g
  JOIN (SELECT l_orderkey, l_linenumber, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS sum_price
        FROM lineitem GROUP BY l_orderkey, l_linenumber) s
    ON s.l_orderkey = g.l_orderkey AND s.l_linenumber = g.l_linenumber
  WHERE g.num % 17 <> 0
)"""

CASE = r"""
claim_case AS (
  SELECT
    'K' || lpad(CAST(g.num AS VARCHAR), 11, '0') AS id,
    'C' || lpad(CAST(g.num AS VARCHAR), 11, '0') AS claim_id,
    'CASE' || CAST(g.l_orderkey AS VARCHAR) AS case_id,
    'UCASE' || CAST(g.l_orderkey AS VARCHAR) AS unique_case_id,
    p.p_type AS case_stage_code,
    CASE WHEN g.num % 9 = 0 THEN 'VOID' ELSE 'R' || CAST(g.l_linenumber AS VARCHAR) END AS stage_reached_code,
    p.p_brand AS standard_fee_category_code,
    CASE WHEN g.l_orderkey % 2 = 0 THEN 'SUCCESS' END AS outcome_code,
    CASE WHEN g.num % 6 = 0 THEN FALSE END AS is_postal_application_accepted,
    CASE WHEN g.num % 3 = 0 THEN TRUE END AS is_nrm_advice,
    CASE WHEN g.num % 4 = 0 THEN 'YES' END AS follow_on_work,
    CASE WHEN g.num % 8 = 0 THEN CAST(g.first_ship AS DATE) END AS transfer_date,
    CASE WHEN g.num % 4 <> 0 THEN 'EX' || CAST(g.num % 43 AS VARCHAR) END AS exemption_criteria_satisfied,
    CASE WHEN g.num % 5 = 0 THEN 'ECF' || CAST(g.num AS VARCHAR) WHEN g.num % 5 = 1 THEN '' END
      AS exceptional_case_funding_reference,
    g.num % 2 = 0 AS is_legacy_case,
    'loader' AS created_by_user_id,
    g.first_ship AS created_on,
    CAST(NULL AS TIMESTAMP) AS updated_on
  FROM claim_grp g LEFT JOIN part p ON p.p_partkey = g.partkey
  WHERE g.num % 13 <> 0
)"""

CLIENT = r"""
client_src AS (
  SELECT g.*, c.c_custkey, c.c_name, c.c_mktsegment, c.c_nationkey, c.c_acctbal, n.n_name, FALSE AS second
  FROM claim_grp g
  LEFT JOIN orders o ON o.o_orderkey = g.l_orderkey
  LEFT JOIN customer c ON c.c_custkey = o.o_custkey
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  WHERE g.num % 19 <> 0
),
client AS (
  SELECT
    CASE WHEN second THEN 'M' ELSE 'L' END || lpad(CAST(num AS VARCHAR), 11, '0') AS id,
    'C' || lpad(CAST(num AS VARCHAR), 11, '0') AS claim_id,
    CASE WHEN second THEN 'Second, ' || c_name ELSE c_name END AS client_forename,
    c_mktsegment AS client_surname,
    DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER) AS client_date_of_birth,
    'UCN' || CAST(c_custkey AS VARCHAR) AS unique_client_number,
    'AB' || CAST(c_nationkey AS VARCHAR) || ' 3CD' AS client_postcode,
    CASE WHEN c_custkey % 2 = 0 THEN 'M' ELSE 'F' END AS gender_code,
    n_name AS ethnicity_code,
    CASE WHEN num % 3 <> 0 THEN 'DIS' || CAST(num % 47 AS VARCHAR) END AS disability_code,
    c_acctbal > 0 AS is_legally_aided,
    'Type1' AS client_type_code,
    CASE WHEN num % 5 <> 0 THEN 'HO' || CAST(num % 53 AS VARCHAR) END AS home_office_client_number,
    CASE WHEN c_custkey % 3 = 0 THEN 'CLA' || CAST(c_custkey AS VARCHAR) END AS cla_reference_number,
    CASE WHEN num % 4 <> 0 THEN 'CE' || CAST(num % 59 AS VARCHAR) END AS cla_exemption_code,
    CASE WHEN num % 6 <> 0 THEN 'Forename' || CAST(num % 61 AS VARCHAR) END AS client_2_forename,
    CASE WHEN num % 5 <> 0 THEN 'Surname' || CAST(num % 67 AS VARCHAR) END AS client_2_surname,
    CASE WHEN num % 3 <> 0 THEN DATE '1960-01-01' + CAST(num % 9000 AS INTEGER) END AS client_2_date_of_birth,
    CASE WHEN num % 7 <> 0 THEN 'UCN2-' || CAST(num % 71 AS VARCHAR) END AS client_2_ucn,
    CASE WHEN num % 4 <> 0 THEN 'CD' || CAST(num % 73 AS VARCHAR) END AS client_2_postcode,
    CASE WHEN num % 5 <> 0 THEN 'G' || CAST(num % 3 AS VARCHAR) END AS client_2_gender_code,
    CASE WHEN num % 6 <> 0 THEN 'ETH' || CAST(num % 79 AS VARCHAR) END AS client_2_ethnicity_code,
    CASE WHEN num % 3 <> 0 THEN 'D2-' || CAST(num % 83 AS VARCHAR) END AS client_2_disability_code,
    CASE WHEN num % 4 <> 0 THEN num % 8 = 1 END AS client_2_is_legally_aided,
    'loader' AS created_by_user_id,
    first_ship AS created_on,
    CAST(NULL AS TIMESTAMP) AS updated_on
  FROM (SELECT * FROM client_src
        UNION ALL
        SELECT * REPLACE (TRUE AS second) FROM client_src WHERE num % 23 = 0)
)"""

TESTBED = ",\n".join([SUBMISSION, BULK, CLAIM, FEE, SUMMARY_FEE, CASE, CLIENT])


def with_testbed(body_ctes: str, select: str) -> str:
    """``WITH <testbed>, <body_ctes> <select>``; body_ctes may be empty."""
    ctes = TESTBED + (",\n" + body_ctes if body_ctes.strip() else "")
    return f"WITH {ctes}\n{select}"
