"""CSV export of a report (SNK-3/4/5, STR-9).

Lines are built by Spark expressions (one ``line`` column) and written with
``DataFrame.write.text``: Spark's own CSV writer quotes differently (``""`` for
empty strings, backslash escapes, a header even for an empty result).

The export never funnels rows through one task: the report is range-sorted
into ordered part files by all tasks; a single file is made afterwards by
concatenating the parts in order, on the file system, never by
``coalesce(1)`` in front of the sort.
"""

from __future__ import annotations

import logging
import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from claimsflow.operators import ordering
from claimsflow.sinks import store

log = logging.getLogger(__name__)

# Fixed behaviour of the reference's CSV writer (deduced from its goldens):
# a field is quoted when longer than 24 characters or when it holds any
# character below '-' (0x2D); an embedded quote is doubled; null and '' are
# written as nothing; lines end in LF.
QUOTE_LONGER_THAN = 24
NEEDS_QUOTES = r"[\x00-\x2C]"
#: Digits of a published part's number: names sort by number up to that many parts.
PART_DIGITS = 10


def csv_field(value: Column) -> Column:
    v = F.coalesce(value.cast("string"), F.lit(""))
    quoted = F.concat(F.lit('"'), F.replace(v, F.lit('"'), F.lit('""')), F.lit('"'))
    # The length is in UTF-16 units: characters plus those beyond U+FFFF, which
    # can only decide where half the limit is passed and some bytes are not ASCII.
    units = F.length(v) + F.length(F.regexp_replace(v, r"[\x{0}-\x{FFFF}]", ""))
    wide = (F.length(v) > QUOTE_LONGER_THAN // 2) & (F.octet_length(v) > F.length(v)) & (units > QUOTE_LONGER_THAN)
    return F.when((F.length(v) > QUOTE_LONGER_THAN) | v.rlike(NEEDS_QUOTES) | wide, quoted).otherwise(v)


def csv_lines(df: DataFrame) -> DataFrame:
    """SNK-3: one ``line`` per row, fields in column order (taken by
    position, so headers that differ only in case stay apart)."""
    pos = df.toDF(*[f"_f{i}" for i in range(len(df.columns))])
    return pos.select(F.concat_ws(",", *[csv_field(F.col(c)) for c in pos.columns]).alias("line"))


def header_line(columns: list[str]) -> str:
    def q(name: str) -> str:
        if len(name.encode("utf-16-le")) // 2 > QUOTE_LONGER_THAN or any(ord(ch) < 0x2D for ch in name):
            return '"' + name.replace('"', '""') + '"'
        return name
    return ",".join(q(c) for c in columns)


def part_number(name: str) -> int:
    """The number in a part file's name; the name pads it to five digits only,
    so names of 100,000 parts and more do not sort by number."""
    return int(name.split("-")[1])


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p, jvm


def write_parts(df: DataFrame, sort_keys: list, out_dir: str) -> int:
    """Range-sort the report and write ordered ``part-*`` text files.

    Returns the row count, observed while writing (no second pass)."""
    obs = Observation("export")
    lines = csv_lines(ordering.ordered(df, sort_keys) if sort_keys else df)
    lines = lines.observe(obs, F.count(F.lit(1)).alias("rows"))
    lines.write.mode("overwrite").text(out_dir)
    return int(obs.get["rows"])


def concat_parts(spark: SparkSession, parts_dir: str, dest: str, header: str | None,
                 max_bytes: int | None = None) -> int:
    """Join ordered part files (by number = sort order) into one file, header
    first.  The file is made beside the parts and then takes the place of
    ``dest`` in one rename, so readers see the old or the new report.

    Where the file system concatenates natively (HDFS), no byte moves; other
    file systems stream the parts file to file.  ``max_bytes``, where given,
    refuses a larger report on every file system before anything is written."""
    fs, pdir, jvm = _jvm_fs(spark, parts_dir)
    statuses = sorted((s for s in fs.listStatus(pdir) if s.getPath().getName().startswith("part-")),
                      key=lambda s: part_number(s.getPath().getName()))
    total = sum(s.getLen() for s in statuses)
    if max_bytes is not None and total > max_bytes:
        raise ValueError(f"report is {total} bytes, over the single-file limit {max_bytes}; "
                         f"publish with single_file=False")
    head = jvm.org.apache.hadoop.fs.Path(f"{parts_dir}/header.csv")
    out = fs.create(head, True)
    try:
        if total and header is not None:  # SNK-4: empty report, 0-byte file, no header
            out.write(bytearray((header + "\n").encode("utf-8")))
    finally:
        out.close()
    srcs = [s.getPath() for s in statuses if s.getLen() > 0]
    if srcs:
        head = _joined(spark, fs, jvm, parts_dir, head, srcs)
    _replace(spark, jvm, head, dest)
    return total


def _joined(spark: SparkSession, fs, jvm, folder: str, head, srcs: list):
    """The path of a file with the header and all parts."""
    try:
        fs.concat(head, _path_array(spark, srcs))  # metadata only; the header file becomes the target
        return head
    except Exception as e:  # noqa: BLE001 - local and object stores have no concat;
        # HDFS refuses some layouts: either way fall back to streaming below
        log.info("native concat unavailable for %s (%s); streaming the parts", folder, e)
    whole = jvm.org.apache.hadoop.fs.Path(f"{folder}/whole.csv")
    out = fs.create(whole, True)
    try:
        for p in [head, *srcs]:
            inp = fs.open(p)
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(inp, out, 1 << 20, False)
            finally:
                inp.close()
    finally:
        out.close()
    return whole


def _replace(spark: SparkSession, jvm, source, dest: str) -> None:
    """Rename ``source`` to ``dest``, over a file that is there."""
    target = jvm.org.apache.hadoop.fs.Path(dest)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target.getFileSystem(conf).mkdirs(target.getParent())
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf)
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    files.rename(files.makeQualified(source), files.makeQualified(target), options)


def _path_array(spark: SparkSession, paths):
    gw = spark.sparkContext._gateway
    arr = gw.new_array(gw.jvm.org.apache.hadoop.fs.Path, len(paths))
    for i, p in enumerate(paths):
        arr[i] = p
    return arr


def publish(spark: SparkSession, df: DataFrame, root: str, name: str, sort_keys: list,
            local_file: str | None = None, single_file: bool = True, max_bytes: int | None = None) -> dict:
    """SNK-5: write ``<root>/reports/<name>``.  The name (and the local file,
    when given) must end with ``.csv``, case-sensitive, as in the reference.

    ``single_file=True`` gives the reference's one CSV file (SNK-4: an empty
    report is a 0-byte file without header); ``max_bytes`` is its limit, if any.
    ``single_file=False`` writes a fresh run folder of ordered part files below
    ``<root>/reports/<name>``, header first, whose names sort in report order,
    and then points to it (:func:`published`): readers see the old or the new
    report, and no row passes through the driver."""
    if not name.endswith(".csv"):
        raise ValueError(f"report name must end with .csv: {name}")
    if local_file is not None and not local_file.endswith(".csv"):
        raise ValueError(f"file must end with .csv: {local_file}")
    dest = f"{root}/reports/{name}"
    if not single_file:
        run = f"{dest}/run-{uuid.uuid4().hex}"
        rows = write_parts(df, sort_keys, run)
        _number_parts(spark, run)
        if rows:
            _write_header(spark, f"{run}/part-{0:0{PART_DIGITS}d}.csv", header_line(df.columns))
        store.prune_runs(spark, dest, store.switch_pointer(spark, dest, run))
        return {"rows": rows, "bytes": None, "path": run}
    parts = f"{root}/_parts/{name}-{uuid.uuid4().hex}"
    rows = write_parts(df, sort_keys, parts)
    size = concat_parts(spark, parts, dest, header_line(df.columns) if rows else None, max_bytes)
    fs, p, _ = _jvm_fs(spark, parts)
    fs.delete(p, True)
    return {"rows": rows, "bytes": size, "path": dest}


def _number_parts(spark: SparkSession, folder: str) -> None:
    """Name the parts by number from 1 on, at a fixed width (0 is the header)."""
    fs, p, jvm = _jvm_fs(spark, folder)
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("part-"):
            to = jvm.org.apache.hadoop.fs.Path(p, f"part-{part_number(name) + 1:0{PART_DIGITS}d}.csv")
            if not fs.rename(st.getPath(), to):
                raise OSError(f"could not name {to}")


def published(spark: SparkSession, root: str, name: str) -> str:
    """The folder of the report published last as parts."""
    run = store.pointed(spark, f"{root}/reports/{name}")
    if run is None:
        raise FileNotFoundError(f"no published report {name}")
    return run


def published_lines(spark: SparkSession, root: str, name: str) -> DataFrame:
    """``line_number`` (the header is 0) and ``line`` of a report published as
    parts.  Lines are numbered within each piece of a file that a task reads and
    moved on by the lines of the pieces before: only the pieces' counts come
    together in one place, never the lines."""
    read = spark.read.text(published(spark, root, name)).select(
        F.col("_metadata.file_name").alias("part"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))
    piece = ["part", "start"]
    counts = read.groupBy(*piece).agg(F.count(F.lit(1)).alias("n"))
    before = counts.select(*piece, (F.sum("n").over(Window.orderBy(*piece)) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy(*piece).orderBy("at"))
    return (read.withColumn("at", F.monotonically_increasing_id()).withColumn("place", place).join(before, piece)
            .select((F.col("before") + F.col("place") - 1).cast("bigint").alias("line_number"), "line"))


def _write_header(spark: SparkSession, path: str, header: str) -> None:
    fs, p, _ = _jvm_fs(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray((header + "\n").encode("utf-8")))
    finally:
        out.close()


def default_root(spark: SparkSession) -> str:
    """Shared output root: ``claimsflow.output.dir`` or the checkpoint folder."""
    root = spark.conf.get("claimsflow.output.dir", None)
    if not root:
        from claimsflow.session import ensure_checkpoint_dir
        root = os.path.join(ensure_checkpoint_dir(spark), "claimsflow-out")
    return root
