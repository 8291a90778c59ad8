"""Claims-shaped input built from the driver's TPC-H-like tables.

This module only *shapes input*: every output row is one driver row (or one
group of driver rows) renamed into the claims schema, so that the report jobs
can run on data whose size grows with the scale factor.  No report logic
lives here; the jobs must be right on any data of these schemas.

  orders                  -> submission (one per order), bulk_submission (ten orders)
  lineitem (orderkey, line) -> claim, claim_summary_fee, claim_case, client
  lineitem row            -> calculated_fee_detail (several per claim)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.schemas import SCHEMAS

DRIVER_TABLES = ("orders", "lineitem", "customer", "part", "nation", "events")


def read_driver(spark: SparkSession, sf_dir: str, names=DRIVER_TABLES) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _pad(c: Column, width: int) -> Column:
    return F.lpad(c.cast("string"), width, "0")


def sid(orderkey: Column) -> Column:
    return F.concat(F.lit("S"), _pad(orderkey, 10))


def cid(num: Column) -> Column:
    return F.concat(F.lit("C"), _pad(num, 11))


def _conform(df: DataFrame, table: str) -> DataFrame:
    """Select the table's final columns, typed, filling absent ones with null."""
    have = set(df.columns)
    cols = []
    for f in SCHEMAS[table].fields:
        src = F.col(f.name) if f.name in have else F.lit(None)
        cols.append(src.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def _hours(n: Column) -> Column:
    return F.make_interval(hours=n.cast("int"))


def submissions(orders: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    failed = F.col("o_orderstatus") == "P"
    day = F.col("o_orderdate")
    mon = F.upper(F.date_format(day, "MMM-yyyy"))
    period = (
        F.when(failed & (k % 2 == 0), F.date_format(day, "yyyy-MM-dd"))
        .when(failed, F.lit("UNKNOWN"))
        .when(k % 8 >= 6, F.date_format(day, "yyyy-MM"))
        .otherwise(mon)
    )
    area = (
        F.when((k % 5 == 0), "CIVIL")
        .when((k % 5 == 1) & (k % 3 == 0), "crime lower")
        .when(k % 5 == 1, "CRIME LOWER")
        .when(k % 5 == 2, "MEDIATION")
        .when(k % 5 == 3, "LEGAL HELP")
        .when(k % 2 == 1, "Legal Help")
        .otherwise("OTHER")
    )
    created = (day.cast("timestamp") + _hours(k % 24)
               + F.make_interval(mins=((k % 2) * 30).cast("int")))
    cust = F.col("o_custkey")
    df = orders.select(
        sid(k).alias("id"),
        F.concat(F.lit("B"), _pad(F.expr("o_orderkey div 10"), 9)).alias("bulk_submission_id"),
        F.concat(F.lit("OA"), _pad(cust % 40, 3)).alias("office_account_number"),
        period.alias("submission_period"),
        area.alias("area_of_law"),
        F.when(failed, "VALIDATION_FAILED").otherwise("VALIDATION_SUCCEEDED").alias("status"),
        F.when(k % 5 == 1, F.concat(F.lit("CSN"), _pad(cust % 97, 3))).alias("crime_lower_schedule_number"),
        F.when((k % 7 == 0) & (k > 0), sid(k - 1)).alias("previous_submission_id"),
        F.when(k % 11 == 0, True).when(k % 13 == 0, None).otherwise(False).alias("is_nil_submission"),
        F.lit("loader").alias("created_by_user_id"),
        created.alias("created_on"),
        F.when(k % 3 == 0, created + F.make_interval(days=F.lit(1))).alias("updated_on"),
        F.when(k % 5 == 3, F.concat(F.lit("LH"), k.cast("string"))).alias("legal_help_submission_reference"),
        F.when(k % 5 == 2, F.concat(F.lit("MED"), k.cast("string"))).alias("mediation_submission_reference"),
        F.concat(F.lit("provider"), (cust % 40).cast("string")).alias("provider_user_id"),
    )
    return _conform(df, "submission")


def bulk_submissions(submission: DataFrame) -> DataFrame:
    df = submission.groupBy(F.col("bulk_submission_id").alias("id")).agg(
        F.min_by("created_on", "id").alias("created_on"))
    df = df.select("id", F.lit("READY_FOR_PARSING").alias("status"),
                   F.lit("loader").alias("created_by_user_id"), "created_on")
    return _conform(df, "bulk_submission")


def _claim_groups(lineitem: DataFrame) -> DataFrame:
    # Every aggregate is of a type that a hash aggregate holds (the least of a text
    # is not), so no task sorts its line items.
    flag = F.col("l_returnflag")
    return lineitem.groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("l_shipdate").alias("first_ship"),
        F.max("l_shipdate").alias("last_ship"),
        (F.bool_or(flag == "R") & F.bool_and(flag >= "R")).alias("least_flag_is_r"),
        F.min("l_partkey").alias("partkey"),
        F.sum(_dec("l_extendedprice")).alias("sum_price"),
    ).withColumn("num", F.col("l_orderkey") * 10 + F.col("l_linenumber"))


def claims(groups: DataFrame) -> DataFrame:
    k, line, num = F.col("l_orderkey"), F.col("l_linenumber"), F.col("num")
    later = F.col("last_ship") > F.col("first_ship")
    pk = F.col("partkey") % 1000
    df = groups.select(
        cid(num).alias("id"),
        sid(k).alias("submission_id"),
        F.when(F.col("least_flag_is_r"), "INVALID").otherwise("VALID").alias("status"),
        line.alias("line_number"),
        F.concat(F.lit("CRN"), k.cast("string")).alias("case_reference_number"),
        F.when(k % 2 == 1, F.concat(F.lit("UFN"), line.cast("string"))).alias("unique_file_number"),
        F.to_date("first_ship").alias("case_start_date"),
        F.when(later, F.to_date("last_ship")).alias("case_concluded_date"),
        F.when(line % 2 == 0, F.concat(F.lit("MT"), pk.cast("string")))
        .otherwise(F.concat(F.lit("MT"), _pad(pk, 3))).alias("matter_type_code"),
        F.concat(F.lit("FEE"), line.cast("string")).alias("fee_code"),
        F.col("n").cast("int").alias("suspects_defendants_count"),
        (line % 2 == 0).alias("is_duty_solicitor"),
        F.when(line % 3 == 0, line).alias("mediation_sessions_count"),
        F.when((F.col("n") > 1) & (line > 1), cid(num - 1)).alias("matched_claim_id"),
        F.when(k % 4 == 0, F.concat(F.lit("MAAT"), k.cast("string"))).alias("maat_id"),
        F.when(num % 3 != 0, F.concat(F.lit("SCH"), (num % 11).cast("string"))).alias("scheme_id"),
        F.when(num % 4 != 0, F.to_date("last_ship")).alias("representation_order_date"),
        F.when(num % 5 != 0, F.concat(F.lit("LOC"), (num % 13).cast("string"))).alias("delivery_location"),
        F.when(num % 3 != 0, F.concat(F.lit("PS"), (num % 101).cast("string"))).alias("police_station_court_prison_id"),
        F.when(num % 4 != 0, num % 7).alias("police_station_court_attendances_count"),
        F.when(num % 6 != 0, F.concat(F.lit("PA"), (num % 17).cast("string"))).alias("procurement_area_code"),
        F.when(num % 5 != 0, F.concat(F.lit("AP"), (num % 19).cast("string"))).alias("access_point_code"),
        F.when(num % 7 != 0, F.concat(F.lit("RS"), (num % 23).cast("string"))).alias("referral_source"),
        F.when(num % 3 != 0, num % 5 == 1).alias("is_youth_court"),
        F.lit("loader").alias("created_by_user_id"),
        F.col("first_ship").cast("timestamp").alias("created_on"),
        F.when(later, F.col("last_ship").cast("timestamp")).alias("updated_on"),
        F.lit(False).alias("is_amended"), F.lit(False).alias("has_assessment"),
        F.lit(0).alias("version"),
    )
    return _conform(df, "claim")


def _dec(c: str) -> Column:
    return F.col(c).cast("decimal(18,2)")


def _money_text(c: Column) -> Column:
    return F.round(c, 2).cast("decimal(18,2)").cast("string")


def _amount(n: Column, most: int) -> Column:
    """A NUMERIC text with two decimals."""
    return F.concat((n % most).cast("string"), F.lit("."), _pad(n % 97, 2))


def fee_details(lineitem: DataFrame) -> DataFrame:
    from pyspark.sql import Window as W
    w = W.partitionBy("l_orderkey", "l_linenumber").orderBy(
        "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity",
        "l_discount", "l_tax")
    line, num = F.col("l_linenumber"), F.col("l_orderkey") * 10 + F.col("l_linenumber")
    part = num + F.col("l_partkey")  # differs between the details of a claim
    p, d, x = _dec("l_extendedprice"), _dec("l_discount"), _dec("l_tax")
    shipped = F.col("l_shipdate").cast("timestamp")
    # Numbered before the texts are made: the shuffle carries lineitem's columns.
    df = lineitem.withColumn("_n", F.row_number().over(w)).select(
        F.concat(cid(num), F.lit("-"), F.col("_n").cast("string")).alias("id"),
        F.concat(F.lit("X"), _pad(num, 11)).alias("claim_summary_fee_id"),
        cid(num).alias("claim_id"),
        F.concat(F.lit("FEE"), line.cast("string")).alias("fee_code"),
        F.concat(F.lit("Type"), F.col("l_returnflag")).alias("fee_type"),
        F.lit("loader").alias("created_by_user_id"),
        shipped.alias("created_on"),
        F.when(F.col("l_discount") >= 0.05,
               shipped + F.make_interval(days=(F.col("l_partkey") % 30).cast("int"))).alias("updated_on"),
        F.concat(F.lit("Description "), line.cast("string")).alias("fee_code_description"),
        F.when(F.col("l_partkey") % 2 == 0, "CRIME LOWER").otherwise("LEGAL HELP").alias("category_of_law"),
        F.when(line == 7, (p * (1 - d)).cast("decimal(18,4)").cast("string"))
        .otherwise(_money_text(p * (1 - d))).alias("total_amount"),
        (x > 0).alias("vat_indicator"),
        F.when(x > 0, (x * 100).cast("decimal(18,2)").cast("string")).alias("vat_rate_applied"),
        F.when(line % 2 == 1, p.cast("string")).alias("fixed_fee_amount"),
        _money_text(p * d).alias("net_profit_costs_amount"),
        F.when(F.col("l_tax") >= 0.04, _money_text(p * x)).alias("net_cost_of_counsel_amount"),
        F.when(F.col("l_quantity") > 25, _dec("l_quantity").cast("string")).alias("net_travel_costs_amount"),
        F.when(line == 1, F.lit("0")).alias("jr_form_filling_amount"),
        F.when(F.col("l_returnflag") == "A", F.lit("12.5")).alias("bolt_on_total_fee_amount"),
        _money_text(p * x).alias("disbursement_amount"),
        F.when(F.col("l_returnflag") == "A", F.lit(1)).alias("bolt_on_adjourned_hearing_count"),
        F.when(part % 4 != 0, _amount(part, 211)).alias("net_waiting_costs_amount"),
        F.when(part % 3 != 0, _amount(part, 223)).alias("travel_and_waiting_costs_amount"),
        F.when(part % 5 != 0, _amount(part, 227)).alias("detention_travel_and_waiting_costs_amount"),
        F.when(part % 2 != 0, _amount(part, 229)).alias("hourly_total_amount"),
        F.when(part % 6 != 0, _amount(part, 233)).alias("bolt_on_adjourned_hearing_fee"),
        F.when(part % 4 != 0, part % 5).alias("bolt_on_cmrh_telephone_count"),
        F.when(part % 7 != 0, _amount(part, 239)).alias("bolt_on_cmrh_telephone_fee"),
        F.when(part % 5 != 0, part % 6).alias("bolt_on_cmrh_oral_count"),
        F.when(part % 3 != 0, _amount(part, 241)).alias("bolt_on_cmrh_oral_fee"),
        F.when(part % 6 != 0, part % 8).alias("bolt_on_home_office_interview_count"),
        F.when(part % 4 != 0, _amount(part, 251)).alias("bolt_on_home_office_interview_fee"),
        (F.col("l_linestatus") == "F").alias("escape_case_flag"),
    )
    return _conform(df, "calculated_fee_detail")


def summary_fees(groups: DataFrame) -> DataFrame:
    g = groups.where(F.col("num") % 17 != 0)
    k, line, num = F.col("l_orderkey"), F.col("l_linenumber"), F.col("num")
    df = g.select(
        F.concat(F.lit("X"), _pad(num, 11)).alias("id"),
        cid(num).alias("claim_id"),
        (F.col("n") * 10).cast("int").alias("advice_time"),
        (line * 5).alias("travel_time"),
        F.when(k % 3 == 0, F.lit(15)).alias("waiting_time"),
        F.col("sum_price").cast("string").alias("net_profit_costs_amount"),
        F.when(line == 2, F.lit("200")).alias("net_disbursement_amount"),
        F.when(line == 3, F.lit("500.00")).alias("net_counsel_costs_amount"),
        (k % 2 == 0).alias("is_vat_applicable"),
        F.when(k % 3 == 0, F.lit(False)).alias("is_tolerance_applicable"),
        (line == 1).alias("is_london_rate"),
        F.when(line == 4, F.lit(2)).alias("adjourned_hearing_fee_amount"),
        F.when(line == 5, F.to_date("first_ship")).alias("surgery_date"),
        F.when(num % 3 != 0, _amount(num, 257)).alias("disbursements_vat_amount"),
        F.when(num % 4 != 0, _amount(num, 263)).alias("travel_waiting_costs_amount"),
        F.when(num % 5 != 0, _amount(num, 269)).alias("net_waiting_costs_amount"),
        F.when(num % 6 != 0, F.concat(F.lit("PRI"), (num % 29).cast("string"))).alias("prior_authority_reference"),
        F.when(num % 3 != 0, num % 4 == 1).alias("is_additional_travel_payment"),
        F.when(num % 7 != 0, _amount(num, 271)).alias("costs_damages_recovered_amount"),
        F.when(num % 4 != 0, F.concat(F.lit("MTG"), (num % 31).cast("string"))).alias("meetings_attended_code"),
        F.when(num % 5 != 0, _amount(num, 277)).alias("detention_travel_waiting_costs_amount"),
        F.when(num % 3 != 0, _amount(num, 281)).alias("jr_form_filling_amount"),
        F.when(num % 6 != 0, num % 9).alias("medical_reports_count"),
        F.when(num % 5 != 0, num % 6 == 1).alias("is_irc_surgery"),
        F.when(num % 4 != 0, num % 10).alias("surgery_clients_count"),
        F.when(num % 7 != 0, num % 11).alias("surgery_matters_count"),
        F.when(num % 3 != 0, num % 12).alias("cmrh_oral_count"),
        F.when(num % 5 != 0, num % 13).alias("cmrh_telephone_count"),
        F.when(num % 6 != 0, F.concat(F.lit("AIT"), (num % 37).cast("string"))).alias("ait_hearing_centre_code"),
        F.when(num % 4 != 0, num % 7 == 1).alias("is_substantive_hearing"),
        F.when(num % 7 != 0, num % 14).alias("ho_interview"),
        F.when(num % 5 != 0, F.concat(F.lit("LA"), (num % 41).cast("string"))).alias("local_authority_number"),
        F.lit("loader").alias("created_by_user_id"),
        F.col("first_ship").cast("timestamp").alias("created_on"),
    )
    return _conform(df, "claim_summary_fee")


def claim_cases(groups: DataFrame, part: DataFrame) -> DataFrame:
    g = groups.where(F.col("num") % 13 != 0).join(
        part.select(F.col("p_partkey").alias("partkey"), "p_type", "p_brand"), "partkey", "left")
    k, line, num = F.col("l_orderkey"), F.col("l_linenumber"), F.col("num")
    df = g.select(
        F.concat(F.lit("K"), _pad(num, 11)).alias("id"),
        cid(num).alias("claim_id"),
        F.concat(F.lit("CASE"), k.cast("string")).alias("case_id"),
        F.concat(F.lit("UCASE"), k.cast("string")).alias("unique_case_id"),
        F.col("p_type").alias("case_stage_code"),
        F.when(num % 9 == 0, F.lit("VOID")).otherwise(F.concat(F.lit("R"), line.cast("string"))).alias("stage_reached_code"),
        F.col("p_brand").alias("standard_fee_category_code"),
        F.when(k % 2 == 0, F.lit("SUCCESS")).alias("outcome_code"),
        F.when(num % 6 == 0, F.lit(False)).alias("is_postal_application_accepted"),
        F.when(num % 3 == 0, F.lit(True)).alias("is_nrm_advice"),
        F.when(num % 4 == 0, F.lit("YES")).alias("follow_on_work"),
        F.when(num % 8 == 0, F.to_date("first_ship")).alias("transfer_date"),
        F.when(num % 4 != 0, F.concat(F.lit("EX"), (num % 43).cast("string"))).alias("exemption_criteria_satisfied"),
        F.when(num % 5 == 0, F.concat(F.lit("ECF"), num.cast("string")))
        .when(num % 5 == 1, F.lit("")).alias("exceptional_case_funding_reference"),
        (num % 2 == 0).alias("is_legacy_case"),
        F.lit("loader").alias("created_by_user_id"),
        F.col("first_ship").cast("timestamp").alias("created_on"),
    )
    return _conform(df, "claim_case")


def clients(groups: DataFrame, orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    people = (orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("c_custkey"))
              .join(customer, "c_custkey", "left")
              .join(nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name"), "c_nationkey", "left"))
    g = groups.where(F.col("num") % 19 != 0).join(people, "l_orderkey", "left")
    both = F.when(F.col("num") % 23 == 0, F.array(F.lit(False), F.lit(True))).otherwise(F.array(F.lit(False)))
    g = g.withColumn("second", F.explode(both))
    num, ck, sec = F.col("num"), F.col("c_custkey"), F.col("second")
    df = g.select(
        F.concat(F.when(sec, "M").otherwise("L"), _pad(num, 11)).alias("id"),
        cid(num).alias("claim_id"),
        F.when(sec, F.concat(F.lit("Second, "), F.col("c_name"))).otherwise(F.col("c_name")).alias("client_forename"),
        F.col("c_mktsegment").alias("client_surname"),
        F.date_add(F.lit("1950-01-01").cast("date"), (ck % 20000).cast("int")).alias("client_date_of_birth"),
        F.concat(F.lit("UCN"), ck.cast("string")).alias("unique_client_number"),
        F.concat(F.lit("AB"), F.col("c_nationkey").cast("string"), F.lit(" 3CD")).alias("client_postcode"),
        F.when(ck % 2 == 0, "M").otherwise("F").alias("gender_code"),
        F.col("n_name").alias("ethnicity_code"),
        (F.col("c_acctbal") > 0).alias("is_legally_aided"),
        F.lit("Type1").alias("client_type_code"),
        F.when(ck % 3 == 0, F.concat(F.lit("CLA"), ck.cast("string"))).alias("cla_reference_number"),
        F.when(num % 3 != 0, F.concat(F.lit("DIS"), (num % 47).cast("string"))).alias("disability_code"),
        F.when(num % 5 != 0, F.concat(F.lit("HO"), (num % 53).cast("string"))).alias("home_office_client_number"),
        F.when(num % 4 != 0, F.concat(F.lit("CE"), (num % 59).cast("string"))).alias("cla_exemption_code"),
        F.when(num % 6 != 0, F.concat(F.lit("Forename"), (num % 61).cast("string"))).alias("client_2_forename"),
        F.when(num % 5 != 0, F.concat(F.lit("Surname"), (num % 67).cast("string"))).alias("client_2_surname"),
        F.when(num % 3 != 0, F.date_add(F.lit("1960-01-01").cast("date"), (num % 9000).cast("int"))).alias("client_2_date_of_birth"),
        F.when(num % 7 != 0, F.concat(F.lit("UCN2-"), (num % 71).cast("string"))).alias("client_2_ucn"),
        F.when(num % 4 != 0, F.concat(F.lit("CD"), (num % 73).cast("string"))).alias("client_2_postcode"),
        F.when(num % 5 != 0, F.concat(F.lit("G"), (num % 3).cast("string"))).alias("client_2_gender_code"),
        F.when(num % 6 != 0, F.concat(F.lit("ETH"), (num % 79).cast("string"))).alias("client_2_ethnicity_code"),
        F.when(num % 3 != 0, F.concat(F.lit("D2-"), (num % 83).cast("string"))).alias("client_2_disability_code"),
        F.when(num % 4 != 0, num % 8 == 1).alias("client_2_is_legally_aided"),
        F.lit("loader").alias("created_by_user_id"),
        F.col("first_ship").cast("timestamp").alias("created_on"),
    )
    return _conform(df, "client")


def claim_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a claim, from which four of the tables are shaped."""
    return _claim_groups(read_driver(spark, sf_dir, ["lineitem"])["lineitem"])


#: The tables that :func:`claim_groups` feeds.
GROUPED = ("claim", "claim_summary_fee", "claim_case", "client")


def claims_tables(spark: SparkSession, sf_dir: str, groups: DataFrame | None = None) -> dict[str, DataFrame]:
    """All report tables, claims-shaped, over the whole driver tables.  ``groups``
    are the stored rows of :func:`claim_groups`, if they are."""
    d = read_driver(spark, sf_dir)
    sub = submissions(d["orders"])
    groups = _claim_groups(d["lineitem"]) if groups is None else groups
    return {
        "submission": sub,
        "bulk_submission": bulk_submissions(sub),
        "claim": claims(groups),
        "calculated_fee_detail": fee_details(d["lineitem"]),
        "claim_summary_fee": summary_fees(groups),
        "claim_case": claim_cases(groups, d["part"]),
        "client": clients(groups, d["orders"], d["customer"], d["nation"]),
    }


# Fixed parameters of the testbed runs: the driver's orders span 1995-2001.
AS_OF = "2000-06-01"


# Replication check inputs.  The summaries are what the source side would
# have written for the day before AS_OF: true daily counts (computed by the
# library's own daily_summary), with one table's record count off by one and
# one table's summary left out, so that both failure paths are exercised.
CURRENT_LSN = "1/0"
SUMMARY_ERROR_TABLE = "claims.claim"
SUMMARY_OMITTED_TABLE = "claims.bulk_submission"


def source_lsn(summaries: DataFrame) -> str:
    """The source's position when a run begins: ``CURRENT_LSN``, or the greatest that
    the day's summaries name where the tables have grown past it (a source is never
    behind what it wrote)."""
    from claimsflow.operators.reconcile import lsn_value
    low = F.lit(CURRENT_LSN).alias("wal_lsn")
    top = (summaries.select("wal_lsn").unionByName(summaries.sparkSession.range(1).select(low))
           .agg(F.max_by("wal_lsn", lsn_value(F.col("wal_lsn"))).alias("lsn")))
    return top.first()["lsn"]


def replication_summaries(tables: dict[str, DataFrame], day, schema: str = "claims") -> DataFrame:
    from claimsflow.operators.reconcile import daily_summaries
    s = daily_summaries(tables, schema).where(F.col("summary_date") == F.lit(day))
    s = s.where(F.col("table_name") != SUMMARY_OMITTED_TABLE)
    return s.select(
        "table_name", "summary_date",
        (F.col("record_count") + F.when(F.col("table_name") == SUMMARY_ERROR_TABLE, 1).otherwise(0))
        .alias("record_count"),
        "updated_count",
        F.concat(F.lit("0/"), F.hex(F.col("record_count") * 4096)).alias("wal_lsn"),
        F.lit(day).cast("timestamp").alias("created_on"))
