"""The reference's integration fixture as DataFrames (FIXTURES.md §1).

Clock: 2025-11-03 05:00 UTC ("T"); T-1 / T-2 are one / two days before.
Ids are one digit repeated in UUID form.  Columns not given are null.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from claimsflow.schemas import SCHEMAS

T = dt.datetime(2025, 11, 3, 5, 0)
T1 = T - dt.timedelta(days=1)
T2 = T - dt.timedelta(days=2)
AS_OF = dt.date(2025, 11, 3)


def uid(digit: str, last: str = "") -> str:
    d = digit * 32
    if last:
        d = d[: 32 - len(last)] + last
    return f"{d[:8]}-{d[8:12]}-{d[12:16]}-{d[16:20]}-{d[20:]}"


def frame(spark: SparkSession, table: str, rows: list[dict]) -> DataFrame:
    schema = SCHEMAS[table]
    data = [tuple(r.get(f.name) for f in schema.fields) for r in rows]
    return spark.createDataFrame(data, schema)


def tables(spark: SparkSession) -> dict[str, DataFrame]:
    bulk = [
        dict(id=uid("1"), status="READY_FOR_PARSING", created_by_user_id="test_user", created_on=T,
             authorised_offices="OfficeA,OfficeB"),
        dict(id=uid("1", "2"), status="READY_FOR_PARSING", created_by_user_id="test_user", created_on=T,
             authorised_offices="OfficeA,OfficeB"),
    ]
    base_sub = dict(office_account_number="OA001", status="VALIDATION_SUCCEEDED", is_nil_submission=False,
                    number_of_claims=1, created_by_user_id="test_user", created_on=T,
                    provider_user_id="test provider user")
    sub = [
        dict(base_sub, id=uid("2"), bulk_submission_id=uid("1"), submission_period="APR-2025",
             area_of_law="CRIME LOWER", crime_lower_schedule_number="CSN001"),
        dict(base_sub, id=uid("2", "3"), bulk_submission_id=uid("1", "2"), submission_period="MAY-2025",
             area_of_law="CRIME LOWER", crime_lower_schedule_number="CSN001"),
        dict(base_sub, id=uid("2", "4"), bulk_submission_id=uid("1", "2"), submission_period="MAY-2025",
             area_of_law="CIVIL", crime_lower_schedule_number="CSN002"),
    ]
    base_claim = dict(submission_id=uid("2"), status="VALID", line_number=1, matter_type_code="MT001",
                      created_by_user_id="test_user", created_on=T1, is_amended=False,
                      has_assessment=False, version=0)
    claim = [dict(base_claim, id=uid("3"), updated_on=T1), dict(base_claim, id=uid("3", "4"))]
    base_client = dict(client_surname="Doe", client_date_of_birth=dt.date(1980, 1, 1),
                       unique_client_number="UCN001", client_postcode="AB12 3CD", gender_code="M",
                       ethnicity_code="White", is_legally_aided=True, client_type_code="Type1",
                       home_office_client_number="HO123", cla_reference_number="CLA001",
                       cla_exemption_code="EX001", created_by_user_id="test_user", created_on=T1)
    client = [dict(base_client, id=uid("4"), claim_id=uid("3"), client_forename="John, Mr. S", updated_on=T1),
              dict(base_client, id=uid("4", "5"), claim_id=uid("3", "4"), client_forename="John")]
    base_case = dict(case_id="CASE001", unique_case_id="UCASE001", case_stage_code="STAGE1",
                     stage_reached_code="REACHED1", outcome_code="SUCCESS",
                     created_by_user_id="test_user", created_on=T1)
    case = [dict(base_case, id=uid("5"), claim_id=uid("3")),
            dict(base_case, id=uid("5", "6"), claim_id=uid("3", "4"))]
    base_csf = dict(advice_time=60, travel_time=30, waiting_time=15, net_profit_costs_amount="1000",
                    net_disbursement_amount="200", net_counsel_costs_amount="500",
                    disbursements_vat_amount="100", travel_waiting_costs_amount="50",
                    net_waiting_costs_amount="20", is_vat_applicable=True, is_tolerance_applicable=False,
                    created_by_user_id="test_user", updated_on=T1)
    csf = [dict(base_csf, id=uid("6"), claim_id=uid("3"), created_on=T1),
           dict(base_csf, id=uid("6", "7"), claim_id=uid("3", "4"), created_on=T2)]

    def fee(i, csf_id, claim_id, code, ftype, created, updated, desc, cat, amount):
        return dict(id=i, claim_summary_fee_id=csf_id, claim_id=claim_id, fee_code=code, fee_type=ftype,
                    created_by_user_id="test_user", created_on=created, updated_by_user_id="test_user",
                    updated_on=updated, fee_code_description=desc, category_of_law=cat, total_amount=amount)
    fees = [
        fee(uid("7"), uid("6"), uid("3"), "FEE001", "TypeA", dt.datetime(2025, 10, 20, 9),
            dt.datetime(2025, 4, 20, 9, 30), "Description 1", "CRIME LOWER", "1500"),
        fee(uid("8"), uid("6"), uid("3"), "FEE002", "TypeB", dt.datetime(2025, 10, 21, 10),
            dt.datetime(2025, 4, 21, 10, 30), "Description 2", "LEGAL HELP", "2000"),
        fee(uid("8", "9"), uid("6", "7"), uid("3", "4"), "FEE002", "TypeB", dt.datetime(2025, 10, 21, 10),
            dt.datetime(2025, 5, 21, 10, 30), "Description 2", "LEGAL HELP", "2000"),
        fee(uid("9"), uid("6"), uid("3"), "FEE003", "TypeC", dt.datetime(2025, 10, 22, 11),
            dt.datetime(2025, 4, 22, 11, 30), "Description 3", "CRIME LOWER", "2500"),
    ]
    return {
        "bulk_submission": frame(spark, "bulk_submission", bulk),
        "submission": frame(spark, "submission", sub),
        "claim": frame(spark, "claim", claim),
        "client": frame(spark, "client", client),
        "claim_case": frame(spark, "claim_case", case),
        "claim_summary_fee": frame(spark, "claim_summary_fee", csf),
        "calculated_fee_detail": frame(spark, "calculated_fee_detail", fees),
    }


# Expected report files of the reference's end-to-end test (fixed values).
GOLDEN_012 = """\
"Provider office account number","Submission month","Area of law","Original submission value","Date submission was uploaded"
OA001,APR-2025,"CRIME LOWER",8000.00,03/11/2025
OA001,MAY-2025,CIVIL,0.00,03/11/2025
OA001,MAY-2025,"CRIME LOWER",0.00,03/11/2025"""

GOLDEN_013 = """\
"Provider Office Account Number","Area of Law",APR-2025,MAY-2025
OA001,CIVIL,,0.00
OA001,CRIME,8000.00,0.00"""

GOLDEN_000_ROWS = (
    '"22222222-2222-2222-2222-222222222222",OA001,APR-2025,01/04/2025,03/11/2025,VALIDATION_SUCCEEDED,'
    '"CRIME LOWER",CSN001,,,"33333333-3333-3333-3333-333333333333",1,,,CASE001,UCASE001,,,,N,N,,,MT001,'
    'MT00,T001,STAGE1,REACHED1,SUCCESS,,,,,"John, Mr. S",Doe,01/01/1980,UCN001,HO123,M,White,,'
    '"AB12 3CD",Type1,true,,,,,,,,,,"CRIME LOWER",,"Description 3",TypeC,,2500.00,,true,15,30,60,1000,'
    '500,200,100,50,20,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,false,,,,,,,,,N,,CLA001,EX001,,,,,,,,,,',
    '"22222222-2222-2222-2222-222222222222",OA001,APR-2025,01/04/2025,03/11/2025,VALIDATION_SUCCEEDED,'
    '"CRIME LOWER",CSN001,,,"33333333-3333-3333-3333-333333333334",1,,,CASE001,UCASE001,,,,N,N,,,MT001,'
    'MT00,T001,STAGE1,REACHED1,SUCCESS,,,,,John,Doe,01/01/1980,UCN001,HO123,M,White,,"AB12 3CD",Type1,'
    'true,,,,,,,,,,"LEGAL HELP",,"Description 2",TypeB,,2000.00,,true,15,30,60,1000,500,200,100,50,20,'
    ',,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,,false,,,,,,,,,N,,CLA001,EX001,,,,,,,,,,',
)
