"""Nightly run: read the replica, check it, then refresh and publish the reports.

    spark-submit -m claimsflow --snapshot s3a://bucket/replica --out s3a://bucket/out \
        --current-lsn 0/16B6C50 [--as-of 2025-11-03] [--ignore-rowcount-mismatch]
    spark-submit -m claimsflow --jdbc-url jdbc:postgresql://host/db --user u --password-env PGPASS ...

Exit status is non-zero when the copy fails the check (and the mismatch flag
does not apply) or when any report fails.
"""

from __future__ import annotations

import argparse
import datetime as dt
import os
import sys

from pyspark.sql import SparkSession

from claimsflow.operators import reconcile
from claimsflow.plans import batch
from claimsflow.schemas import COUNTED_TABLES, REPORT_TABLES
from claimsflow.session import configure, tune_for_input
from claimsflow.sources import jdbc, snapshot


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="claimsflow")
    src = ap.add_mutually_exclusive_group(required=True)
    src.add_argument("--snapshot", help="folder with one parquet table per claims table")
    src.add_argument("--jdbc-url", help="PostgreSQL replica")
    ap.add_argument("--user")
    ap.add_argument("--password-env", default="PGPASSWORD")
    ap.add_argument("--publication", help="publication whose tables the copy must hold (JDBC)")
    ap.add_argument("--subscription", help="subscription whose LSN is current (JDBC)")
    ap.add_argument("--out", required=True, help="shared output root (store + reports/)")
    ap.add_argument("--as-of", default=dt.date.today().isoformat())
    ap.add_argument("--current-lsn", help="current subscription LSN (read from the catalog over JDBC)")
    ap.add_argument("--ignore-rowcount-mismatch", action="store_true")
    ap.add_argument("--single-file", action="store_true", help="one CSV file per report")
    args = ap.parse_args(argv)

    spark = configure(SparkSession.builder.appName("claimsflow-nightly").getOrCreate())
    as_of = dt.date.fromisoformat(args.as_of)
    if args.snapshot:
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(args.snapshot)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        tune_for_input(spark, fs.getContentSummary(path).getLength())
        names = snapshot.names_to_check(spark, args.snapshot)
        tables = snapshot.read_tables(spark, args.snapshot, names)
        summary = snapshot.read_table(spark, args.snapshot, reconcile.SUMMARY_TABLE)
        expected = reconcile.expected_tables(spark, names)
        current = args.current_lsn
    else:
        props = {"user": args.user or "", "password": os.environ.get(args.password_env, ""),
                 "driver": "org.postgresql.Driver"}
        tables = jdbc.read_tables(spark, args.jdbc_url, (*REPORT_TABLES, *COUNTED_TABLES), props)
        summary = jdbc.read_table(spark, args.jdbc_url, reconcile.SUMMARY_TABLE, props, partitions=1)
        expected = jdbc.publication_tables(spark, args.jdbc_url, props, args.publication)
        current = args.current_lsn or jdbc.current_lsn(spark, args.jdbc_url, props, args.subscription)

    verdict = reconcile.health(spark, tables, summary, current, as_of, expected=expected).first().asDict()
    print(verdict["summary"])
    try:
        status = batch.run(spark, tables, batch.standard_reports(as_of), args.out, verdict=verdict,
                           ignore_rowcount_mismatch=args.ignore_rowcount_mismatch,
                           single_file=args.single_file)
    except batch.ReplicationUnhealthy:
        print("Replication health check failed — aborting report generation", file=sys.stderr)
        return 2
    rows = status.collect()
    for r in rows:
        print(r)
    return 0 if all(r["ok"] for r in rows) else 1


if __name__ == "__main__":
    sys.exit(main())
