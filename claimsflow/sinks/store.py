"""Stored report results with an all-or-nothing refresh (SNK-1, SNK-2).

Each refresh writes a fresh run folder; only after the write has succeeded does
a new numbered pointer ``_CURRENT.<n>`` appear (write, then rename).  Readers take
the highest number and see the old or the new result, never a mix; the previous
run stays until the next refresh.  A report whose
columns change between runs (REP013) needs nothing special: each run folder
carries its own schema.  Writing the result also cuts the lineage, so the
export reads the stored columns rather than recomputing the report.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession

POINTER = "_CURRENT"
#: Runs that no pointer names are kept for so long after their last change.
LEASE_S = 6 * 3600


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p, _ = _fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p, jvm = _fs(spark, path)
    if not fs.exists(p):
        return None
    inp = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(inp, "UTF-8")
    finally:
        inp.close()


def _pointers(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """(number, path) of the complete pointer files, oldest first."""
    fs, p, _ = _fs(spark, folder)
    if not fs.exists(p):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(p)]
    numbered = [n for n in names if n.startswith(f"{POINTER}.") and n.rsplit(".", 1)[1].isdigit()]
    return sorted((int(n.rsplit(".", 1)[1]), f"{folder}/{n}") for n in numbered)


def pointed(spark: SparkSession, folder: str) -> str | None:
    """What the newest pointer of ``folder`` names; None where nothing was ever
    stored.  Data without a pointer raises: it is never taken for "no state yet"."""
    found = _pointers(spark, folder)
    if found:
        return _read_text(spark, found[-1][1])
    fs, p, _ = _fs(spark, folder)
    if fs.exists(p) and any(not st.getPath().getName().startswith(("_", ".")) for st in fs.listStatus(p)):
        raise OSError(f"{folder} holds data but no pointer; a first write was cut off: remove the folder or restore the pointer")
    return None


def _name(path: str) -> str:
    return path.rstrip("/").rsplit("/", 1)[-1]


def switch_pointer(spark: SparkSession, folder: str, target: str) -> set[str]:
    """Make ``folder`` point to ``target``: the pointer with the next number is
    written aside and renamed to a name that is not there yet.  Nothing is
    deleted before; the pointers older than the previous one go afterwards.
    Returns the names of what only those pointed to."""
    found = _pointers(spark, folder)
    number = found[-1][0] + 1 if found else 1
    tmp = f"{folder}/{POINTER}-{uuid.uuid4().hex}.tmp"
    _write_text(spark, tmp, target)
    fs, tmp_p, jvm = _fs(spark, tmp)
    dst = jvm.org.apache.hadoop.fs.Path(f"{folder}/{POINTER}.{number:012d}")
    if fs.exists(dst) or not fs.rename(tmp_p, dst):
        raise OSError(f"could not switch {folder} to {target}")
    gone = {_name(_read_text(spark, old)) for _, old in found[:-1]}
    for _, old in found[:-1]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(old), False)
    return gone - {_name(target), *(_name(_read_text(spark, old)) for _, old in found[-1:])}


def prune_runs(spark: SparkSession, folder: str, superseded: set[str], lease_s: float = LEASE_S) -> None:
    """Remove the ``superseded`` run folders, and those that no pointer names and
    nobody has touched within the lease (left by a writer that failed; a younger
    one may still be written).  Runs are told by name, not by the text of paths."""
    kept = {_name(_read_text(spark, path)) for _, path in _pointers(spark, folder)}
    fs, p, _ = _fs(spark, folder)
    oldest = (time.time() - lease_s) * 1000
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("run-") and name not in kept and (name in superseded or st.getModificationTime() < oldest):
            fs.delete(st.getPath(), True)


def remove(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


COLUMNS_FILE = "_columns.json"


def refresh(spark: SparkSession, df: DataFrame, store: str, name: str) -> str:
    """Recompute ``df`` into a new run folder and switch the pointer to it.

    Report columns are kept by position in the files (``c0``, ``c1``, ...) and
    their names in a small sidecar: report headers may differ only in case
    (two period texts), which PostgreSQL keeps apart and Spark's
    case-insensitive column matching would not."""
    run = f"{store}/{name}/run-{uuid.uuid4().hex}"
    df.toDF(*[f"c{i}" for i in range(len(df.columns))]).write.mode("errorifexists").option("compression", "zstd").parquet(run)
    _write_text(spark, f"{run}/{COLUMNS_FILE}", json.dumps(df.columns))
    prune_runs(spark, f"{store}/{name}", switch_pointer(spark, f"{store}/{name}", run))
    return run


def current(spark: SparkSession, store: str, name: str) -> DataFrame:
    """SRC-4 without the ORDER BY: the stored result the pointer names."""
    run = pointed(spark, f"{store}/{name}")
    if run is None:
        raise FileNotFoundError(f"no stored result for {name}")
    names = json.loads(_read_text(spark, f"{run}/{COLUMNS_FILE}"))
    return spark.read.parquet(run).toDF(*names)


def expose(spark: SparkSession, store: str, name: str, view: str) -> None:
    """SRC-4 under a catalog name: ``view`` shows the newest result, so that
    ``spark.table(view).orderBy(...)`` reads the stored report.  Replaced as a whole;
    a query that began on the old one reads the previous run to its end.  The names
    of the columns must differ by more than case."""
    run = pointed(spark, f"{store}/{name}")
    if run is None:
        raise FileNotFoundError(f"no stored result for {name}")
    names = json.loads(_read_text(spark, f"{run}/{COLUMNS_FILE}"))
    quoted = lambda x: "`" + x.replace("`", "``") + "`"
    columns = ", ".join(f"c{i} AS {quoted(n)}" for i, n in enumerate(names))
    spark.sql(f"CREATE OR REPLACE VIEW {quoted(view)} AS SELECT {columns} FROM parquet.{quoted(run)}")
