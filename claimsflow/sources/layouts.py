"""Files of several layouts in one table folder (SRC-1 with DQ-4).

A table's folder may hold files written before and after its columns were renamed
or added to.  The footers of all files are read by a Spark job (a task a few
hundred files), files of equal columns form a group, and each group is read as it
is, brought to the final schema by ``operators.quality.upgrade`` and united with
the others.  So an older file gets the defaults of the columns it lacks, while a
null in a newer file stays a null for the DQ-3 check to find.

A column that no layout knows, or a missing one that was there from the start, is
an error.  Only file names and one column list a group are kept on the driver.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimsflow.operators import quality
from claimsflow.schemas import LATER_COLUMNS, RENAMES, SCHEMAS

FILES_A_TASK = 200
#: Footers that the driver asks Spark for at once, where tasks cannot open the files.
AT_ONCE = 16


class SchemaMismatch(ValueError):
    pass


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files below ``path``, on whatever file system it is."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = []
    listing = fs.listFiles(p, True)
    top = len(str(fs.makeQualified(p).toString()))
    while listing.hasNext():
        file = listing.next().getPath().toString()
        if not any(part.startswith(("_", ".")) for part in file[top:].split("/") if part):
            found.append(file)
    return sorted(found)


def _footers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import pyarrow.fs
    import pyarrow.parquet

    for batch in batches:
        layouts = []
        for uri in batch.column("file").to_pylist():
            try:
                fs, path = pyarrow.fs.FileSystem.from_uri(uri)
            except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                layouts.append(None)  # a store that only Spark opens
                continue
            with fs.open_input_file(path) as f:
                layouts.append(sorted(f"{c.name} {c.type}" for c in pyarrow.parquet.read_schema(f)))
        yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(layouts, pa.list_(pa.string()))], names=["file", "layout"])


def layouts(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """Layout (its columns with their types) -> the files that have it."""
    files = data_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no data files in {path}")
    rows = spark.createDataFrame([(f,) for f in files], "file string").repartition(-(-len(files) // FILES_A_TASK))
    groups = rows.mapInArrow(_footers, "file string, layout array<string>").groupBy("layout").agg(F.sort_array(F.collect_list("file")).alias("files"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in groups.collect():
        if row.layout is not None:
            found[tuple(row.layout)] = list(row.files)
            continue
        with ThreadPoolExecutor(AT_ONCE) as pool:
            schemas = pool.map(lambda f: spark.read.parquet(f).schema, row.files)
        for file, schema in zip(row.files, schemas, strict=True):
            found.setdefault(tuple(sorted(f"{c.name} {c.dataType.simpleString()}" for c in schema)), []).append(file)
    return found


def names_of(layout: tuple[str, ...]) -> set[str]:
    return {c.split(" ")[0] for c in layout}


def check_layout(name: str, columns: set[str]) -> None:
    """Raise where ``columns`` are no layout that table ``name`` ever had."""
    final = {f.name for f in SCHEMAS[name].fields}
    renames = RENAMES.get(name, {})
    both = [f"{old} and {new}" for old, new in renames.items() if {old, new} <= columns]
    extra = sorted(columns - final - renames.keys()) + both
    given = {renames.get(c, c) for c in columns}
    absent = {c for added in LATER_COLUMNS.get(name, ()) if not given & set(added) for c in added}
    missing = sorted(final - given - absent)
    if missing or extra:
        raise SchemaMismatch(f"{name}: missing {missing}, unexpected {extra}")


def read_mixed(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The table in ``path`` under its final schema, whatever layouts its files have."""
    found = layouts(spark, path)
    for layout in found:
        check_layout(name, names_of(layout))
    final = {f.name for f in SCHEMAS[name].fields}
    if all(names_of(layout) == final for layout in found) and len(found) == 1:
        return spark.read.schema(SCHEMAS[name]).parquet(path)
    parts = [quality.upgrade(spark.read.parquet(*files), name) for _, files in sorted(found.items())]
    return functools.reduce(DataFrame.unionByName, parts)
