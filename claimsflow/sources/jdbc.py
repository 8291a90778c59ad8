"""Read the replica straight from PostgreSQL over JDBC (SRC-1 alternative).

Each table is read by ``partitions`` parallel JDBC queries, split by a hash
of the primary key computed in the database (UUID keys have no numeric
range to split on).  NUMERIC columns are selected as ``col::text`` so that
the entered scale survives (SURVEY H1), UUIDs as text; everything else maps
to the Spark type of the final schema.  The current LSN and the publication's
table list (the reference reads both from the catalog) are one small query
each.  Nothing here runs without a database; the query text is unit-tested.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.schemas import PRIMARY_KEYS, SCHEMAS

# Columns that are PostgreSQL NUMERIC or UUID in the source (read as text).
_TEXT_CAST = {"string"}


def select_list(table: str) -> str:
    cols = []
    for f in SCHEMAS[table].fields:
        if f.dataType.simpleString() in _TEXT_CAST:
            cols.append(f'"{f.name}"::text AS "{f.name}"')
        else:
            cols.append(f'"{f.name}"')
    return ", ".join(cols)


def predicates(table: str, partitions: int) -> list[str]:
    """One WHERE clause per parallel reader, disjoint and complete."""
    key = " || '|' || ".join(f'"{k}"::text' for k in PRIMARY_KEYS[table])
    return [f"mod(abs(hashtext({key})::bigint), {partitions}) = {i}" for i in range(partitions)]


def read_table(spark: SparkSession, url: str, table: str, properties: dict,
               schema: str = "claims", partitions: int = 64, fetchsize: int = 10000) -> DataFrame:
    props = {"fetchsize": str(fetchsize), **properties}
    query = f'(SELECT {select_list(table)} FROM {schema}."{table}") AS src'
    df = spark.read.jdbc(url, query, predicates=predicates(table, partitions), properties=props)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in SCHEMAS[table].fields])


def read_tables(spark: SparkSession, url: str, tables, properties: dict, **kw) -> dict[str, DataFrame]:
    return {t: read_table(spark, url, t, properties, **kw) for t in tables}


def current_lsn(spark: SparkSession, url: str, properties: dict, subscription: str) -> str | None:
    q = (f"(SELECT latest_end_lsn::text AS lsn FROM pg_stat_subscription "
         f"WHERE subname = '{subscription}') AS s")
    row = spark.read.jdbc(url, q, properties=properties).first()
    return None if row is None else row["lsn"]


def publication_tables(spark: SparkSession, url: str, properties: dict, publication: str) -> DataFrame:
    """SRC-3 from the catalog: ``schema.table`` of the publication, without
    the summary table itself."""
    q = (f"(SELECT schemaname || '.' || tablename AS full_table_name FROM pg_publication_tables "
         f"WHERE pubname = '{publication}' AND tablename <> 'replication_summary') AS p")
    return spark.read.jdbc(url, q, properties=properties)
