"""File sources and sinks.

Readers take explicit schemas where the format has no types, and return
the long/native form every operator expects. JSON maps are read line by
line: the reference writes one JSON document per file on a single line,
and the sinks here write one key per line, so one reader serves both and a
large output never has to pass through one task; a document laid out over
several lines is put together from them.
"""

from __future__ import annotations

import math
import os

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timeparts import format_arrival
from ..operators import static
from ..operators.static import parse_stop_list

ETA_MAP = "map<string, map<string, string>>"
#: Size of the files that features are written in.
FILE_BYTES = 128 << 20


# ---- sources -----------------------------------------------------------------

def read_stops_csv(spark: SparkSession, path: str) -> DataFrame:
    """Stops CSV with header; ``stop_id`` as text, coordinates DOUBLE,
    other columns passed through as text."""
    df = spark.read.option("header", True).csv(path)
    return df.withColumns({"stop_id": F.col("stop_id").cast("string"),
                           "stop_lat": F.expr("try_cast(stop_lat AS DOUBLE)"),
                           "stop_lon": F.expr("try_cast(stop_lon AS DOUBLE)")})


def read_route_sequences_csv(spark: SparkSession, path: str) -> DataFrame:
    """``route_id, stop_id_list`` where the list is a Python literal."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return df.select(F.expr("try_cast(route_id AS BIGINT)").alias("route_id"),
                     parse_stop_list("stop_id_list").alias("stop_id_list"))


def read_processed_sequences_csv(spark: SparkSession, path: str) -> DataFrame:
    """S3 (legacy CSV form): ', '-joined ids and distances -> native arrays."""
    df = spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
    return df.select(F.expr("try_cast(route_id AS BIGINT)").alias("route_id"),
                     F.split("stop_id_list", ", ").alias("stop_id_list"),
                     F.expr("transform(split(next_stop_distances, ', '), x -> CAST(x AS DOUBLE))")
                     .alias("next_stop_distances"))


def read_static(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """S3: processed stops and sequences written by :func:`write_static`."""
    return spark.read.parquet(f"{root}/stops"), spark.read.parquet(f"{root}/route_sequences")


def read_pings(spark: SparkSession, root: str, dates=None, skip_unreadable: bool = False) -> DataFrame:
    """Raw pings under ``root/date=YYYY-MM-DD/``; only the listed dates
    are scanned (partition pruning). With ``skip_unreadable`` files that cannot
    be read are left out instead of failing the job; :func:`audit_pings` tells
    which."""
    r = (spark.read.option("ignoreMissingFiles", skip_unreadable).option("ignoreCorruptFiles", skip_unreadable)
         .option("mergeSchema", skip_unreadable)   # else the one footer that is read may be a bad one
         .option("basePath", root).parquet(root))
    if dates:
        r = r.where(F.col("date").isin([str(d).replace("date=", "") for d in dates]))
    return r


def file_status(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, footer_rows, rows, status`` for every Parquet file below
    ``root``. Status is ``unreadable`` without a readable footer, ``empty`` if
    that counts no rows, ``damaged`` if fewer rows can be read than it counts
    (all columns are read), else ``ok``."""
    known = footers(spark, root)
    got = read_any(spark, root, skip_unreadable=True, file_col="_file", nested=True)
    if got is None:
        got = spark.createDataFrame([], "_file string, x int")
    values = F.bit_xor(F.xxhash64(*[F.col(f"`{c}`") for c in got.columns if c != "_file"]))     # reads every column
    got = got.groupBy(local_path("_file").alias("path")).agg(F.count(F.lit(1)).alias("rows"), values.alias("_values"))
    j = known.select(local_path("path").alias("path"), "length", F.col("rows").alias("footer_rows")).join(got, "path", "left")
    rows = F.when(F.col("_values").isNotNull(), F.col("rows")).otherwise(0)
    status = (F.when(F.col("footer_rows").isNull(), "unreadable").when(F.col("footer_rows") == 0, "empty").when(rows < F.col("footer_rows"), "damaged").otherwise("ok"))
    return j.select("path", "length", "footer_rows", rows.alias("rows"), status.alias("status"))


def audit_pings(spark: SparkSession, root: str, dates=None) -> DataFrame:
    """What :func:`read_pings` with ``skip_unreadable`` reads and leaves out:
    ``date, files, ok, empty, unreadable, damaged, rows, status`` by date
    folder. A listed date without any file is ``missing``, one where a file
    could not be read in full is ``partial``."""
    day = F.regexp_extract("path", "/date=([^/]+)/", 1)
    by = file_status(spark, root).withColumn("date", F.when(day != "", day))
    count = lambda s: F.count_if(F.col("status") == s).alias(s)
    by = by.groupBy("date").agg(F.count(F.lit(1)).alias("files"), *[count(s) for s in ("ok", "empty", "unreadable", "damaged")], F.sum("rows").alias("rows"))
    if dates:
        listed = spark.createDataFrame([(str(d).replace("date=", ""),) for d in dates], "date string").distinct()
        by = listed.join(by, "date", "left").na.fill(0)
    status = F.when(F.col("files") == 0, "missing").when(F.col("unreadable") + F.col("damaged") > 0, "partial").otherwise("ok")
    return by.withColumn("status", status)


def local_path(col: str) -> F.Column:
    """A file's path, with any spelling of a local one as a plain path."""
    return F.regexp_replace(F.regexp_replace(col, "^file:/+", "/"), "(?<=[^/])/+$", "")


def read_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """``{"idx": "path", ...}`` -> ``query_id, manifest_pos, path``, in its order."""
    text = spark.read.text(manifest_path, wholetext=True).where(F.length(F.trim("value")) > 0)
    return (text.select(F.posexplode(F.from_json("value", "map<string, string>")).alias("manifest_pos", "query_id", "path"))
            .select("query_id", "manifest_pos", local_path("path").alias("path")))


def _manifest_roots(entries: DataFrame) -> list[str]:
    """The deepest folder that all listed paths share, for each top folder of a store."""
    top = F.regexp_extract("path", "^([a-zA-Z0-9+.-]+:/*[^/]*)?/*[^/]*", 0)
    ends = entries.where("path is not null").groupBy(top).agg(F.min("path").alias("a"), F.max("path").alias("b")).collect()   # a row per top folder
    shared = (a if a == b else os.path.commonprefix([a, b]) for _, a, b in ends)
    return sorted(p.rpartition("/")[0] or "/" for p in shared)


def _listed(entries: DataFrame, files: DataFrame) -> DataFrame:
    """Rows with a ``_file`` -> those of listed files, or of files in listed folders."""
    own = local_path("_file")
    names = F.array(own, F.regexp_replace(own, "/[^/]*$", ""))
    return files.withColumn("path", F.explode(names)).join(entries, "path")


def read_query_manifest(spark: SparkSession, manifest_path: str) -> DataFrame:
    """The pings of every file that a manifest ``{"idx": "path", ...}`` lists,
    with ``query_id`` (its key) and ``manifest_pos`` (its place).

    A path is a Parquet file or a folder of part files. The folder that all
    entries share is scanned, and each file meets its entries by one join, so
    no path is part of the plan; keep it to the queries' files. Entries that
    are missing or can't be read give no rows and don't hold up the others;
    :func:`query_status` tells which."""
    entries = read_manifest(spark, manifest_path)
    out = None
    for root in _manifest_roots(entries):
        try:
            got = read_any(spark, root, skip_unreadable=True, file_col="_file", nested=True)
        except AnalysisException:       # not there
            got = None
        if got is not None:
            got = _listed(entries, got).drop("path", "_file")
            out = got if out is None else out.unionByName(got, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no file of {manifest_path} can be read")
    return out


def query_status(spark: SparkSession, manifest_path: str) -> DataFrame:
    """``query_id, manifest_pos, path, files, rows, status`` of every entry of
    a manifest: ``missing`` without a file, else the worst of its files'
    (unreadable, damaged, empty, ok; see :func:`file_status`)."""
    entries = static.materialize(read_manifest(spark, manifest_path))
    found = spark.createDataFrame([], "_file string, rows long, status string")
    for root in _manifest_roots(entries):
        try:
            found = found.unionByName(file_status(spark, root).select(F.col("path").alias("_file"), "rows", "status"))
        except AnalysisException:       # not there
            continue
    worst = F.array_position(F.array(*map(F.lit, ("unreadable", "damaged", "empty", "ok"))), F.col("status"))
    found = _listed(entries, found).groupBy("manifest_pos", "query_id").agg(F.count(F.lit(1)).alias("files"), F.sum("rows").alias("rows"), F.min_by("status", worst).alias("status"))
    return (entries.join(found, ["manifest_pos", "query_id"], "left").na.fill(0, ["files", "rows"])
            .select("query_id", "manifest_pos", "path", "files", "rows", F.coalesce("status", F.lit("missing")).alias("status")))


def footers(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, rows, columns`` of every Parquet file below ``root``, from
    the files' footers; rows and columns (text: names and types) are null where
    there is no readable footer. Only the footers leave the scan."""
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(root))
    size = F.expr("cast(conv(concat(hex(substring(content, -5, 1)), hex(substring(content, -6, 1)), hex(substring(content, -7, 1)), hex(substring(content, -8, 1))), 16, 10) as long)")
    whole = F.expr("length >= 12 and substring(content, -4, 4) = cast('PAR1' as binary)")
    files = files.withColumn("_size", F.when(whole, size))
    footer = F.when(F.col("_size") + 12 <= F.col("length"), F.expr("substring(content, -cast(_size + 8 as int), cast(_size + 8 as int))"))
    read = files.select("path", "length", _footer(footer).alias("f"))
    return read.select("path", "length", "f.rows", "f.columns")


FOOTER = T.StructType([T.StructField("rows", T.LongType()), T.StructField("columns", T.StringType())])


@F.arrow_udf(FOOTER)
def _footer(tails: pa.Array) -> pa.Array:
    import pyarrow.parquet as pq
    out = []
    for tail in tails:
        try:    # the tail of a file is all that its metadata takes
            m = pq.read_metadata(pa.BufferReader(b"PAR1" + tail.as_py()))
            out.append({"rows": m.num_rows, "columns": "\n".join(f"{f.name}\t{f.type}" for f in m.schema.to_arrow_schema())})
        except (pa.ArrowException, OSError, TypeError):
            out.append({"rows": None, "columns": None})
    return pa.array(out, pa.struct([("rows", pa.int64()), ("columns", pa.string())]))


#: Numeric types from narrow to wide.
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double")


def common_type(types: set[str]) -> str:
    """The least type that holds the values of all: the widest of numbers (a
    float beside a long: double), timestamp for dates and timestamps, else text."""
    if len(types) == 1:
        return next(iter(types))
    if types <= set(NUMBERS):
        return "double" if "float" in types and types & {"int", "bigint"} else max(types, key=NUMBERS.index)
    if types <= {"date", "timestamp", "timestamp_ntz"}:
        return "timestamp" if "timestamp" in types else "timestamp_ntz"
    return "string"


def _typed_scans(spark: SparkSession, root: str, **options) -> list[tuple[DataFrame, int]]:
    """One scan per distinct file schema below ``root``, with its number of
    files. The lists of paths are parts of the list that any scan of the
    folder holds."""
    groups = (footers(spark, root).where("columns is not null").groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("columns").collect())
    base = {} if options.get("recursiveFileLookup") else {"basePath": root}
    scans = []
    for g in groups:
        schema = spark.read.options(**base).parquet(g["paths"][0]).schema
        scans.append((spark.read.options(**base, **options).schema(schema).parquet(*g["paths"]), len(g["paths"])))
    return scans


def _column_types(scans: list[tuple[DataFrame, int]]) -> dict[str, set[str]]:
    types: dict[str, set[str]] = {}
    for df, _ in scans:
        for f in df.schema:
            types.setdefault(f.name, set()).add(f.dataType.simpleString())
    return types


def read_any(spark: SparkSession, root: str, skip_unreadable: bool = False, file_col: str | None = None, nested: bool = False) -> DataFrame | None:
    """All Parquet files below ``root`` in one table; columns that a file lacks
    are null. Where files disagree in a column's type, each distinct file schema
    is a scan of its own and the column has the least common type of all; files
    without a readable footer are then left out. ``file_col`` adds each row's
    file, ``nested`` takes files of any folder depth, without partition columns.
    None if no file can be read."""
    options = {"ignoreCorruptFiles": skip_unreadable, "ignoreMissingFiles": skip_unreadable}
    if nested:
        options["recursiveFileLookup"] = True
    add = lambda df: df.withColumn(file_col, F.col("_metadata.file_path")) if file_col else df
    try:
        return add(spark.read.options(mergeSchema=True, **options).parquet(root))
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    except Exception as e:      # raised while the footers are merged, as a plain Java error
        if "CANNOT_MERGE" not in str(e):
            raise
    scans = _typed_scans(spark, root, **options)
    target = {c: common_type(t) for c, t in _column_types(scans).items()}
    out = None
    for df, _ in scans:
        df = add(df).select(*[F.col(f"`{c}`").cast(target[c]).alias(c) for c in df.columns], *([file_col] if file_col else []))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out


def read_route_features(spark: SparkSession, root: str) -> DataFrame:
    """Features written by :func:`write_route_features`, or laid out by
    route and date (partition discovery), whatever types their files have (see
    :func:`read_any`); :func:`coerced_values` tells what was converted,
    :func:`file_status` what could not be read."""
    return read_any(spark, root)


def coerced_values(spark: SparkSession, root: str) -> DataFrame:
    """``column, file_type, read_as, files, values``: the columns that files
    below ``root`` disagree on; per type that differs from what the column is
    read as, its files and the non-null values that are converted."""
    scans = _typed_scans(spark, root)
    types = _column_types(scans)
    target = {c: common_type(t) for c, t in types.items()}
    out = spark.createDataFrame([], "column string, file_type string, read_as string, files long, values long")
    for df, n in scans:
        for f in df.schema:
            kind = f.dataType.simpleString()
            if kind != target[f.name]:
                out = out.unionByName(df.agg(F.count(F.col(f"`{f.name}`")).alias("values")).select(
                    F.lit(f.name).alias("column"), F.lit(kind).alias("file_type"), F.lit(target[f.name]).alias("read_as"), F.lit(n).cast("long").alias("files"), "values"))
    return out.groupBy("column", "file_type", "read_as").agg(F.sum("files").alias("files"), F.sum("values").alias("values"))


def read_patterns(spark: SparkSession, path: str) -> DataFrame:
    """The pattern model table."""
    return spark.read.parquet(path)


def _documents(text: DataFrame) -> DataFrame:
    """Rows (file, block, at, value) of text lines -> one row ``m`` per JSON document.

    The layout is decided file by file: where every line is a document of its
    own, lines are; any other file is put together from its lines in order and
    has to be one document. A line or file with anything after its document is
    none, and raises.
    """
    strict = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), f"array<{ETA_MAP}>")   # inside a list, text after a document is an error
    one = F.when(F.size(strict) == 1, strict[0])
    lines = text.where(F.length(F.trim("value")) > 0).withColumn("m", one)
    laid_out = lines.where(F.col("m").isNull()).select("file").distinct()
    whole = (lines.drop("m").join(laid_out, "file", "left_semi").groupBy("file")
             .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "at", "value"))), lambda x: x["value"]), "\n").alias("value")))
    error = F.raise_error(F.concat(F.lit("not one JSON document of {key: {stop: time}} a line or file: "), "file"))
    return (lines.join(laid_out, "file", "left_anti").select("m")
            .unionByName(whole.select(F.coalesce(one, error).alias("m"))))


def read_eta_json(spark: SparkSession, path: str, key: str = "route_id") -> DataFrame:
    """``{key: {stop: 'YYYY-MM-DD HH:MM:SS'}}`` -> ``key, stop_id, arrival``.

    A file has one document a line, or one laid out over several lines; a
    folder may mix both. A key with an empty map yields one row with NULL stop
    (so evaluation can score it 0.0).
    """
    text = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                                        F.monotonically_increasing_id().alias("at"))
    k = _documents(text).select(F.explode("m").alias(key, "stops"))
    return k.select(key, F.explode_outer("stops").alias("stop_id", "arrival"))


# ---- sinks -------------------------------------------------------------------

def write_static(stops: DataFrame, sequences: DataFrame, root: str) -> None:
    """K1: processed stops and sequences as Parquet (native arrays)."""
    stops.write.mode("overwrite").parquet(f"{root}/stops")
    sequences.write.mode("overwrite").parquet(f"{root}/route_sequences")


def write_route_features(features: DataFrame, root: str, file_bytes: int = FILE_BYTES) -> None:
    """K2: features by date, geometry as WKT text. Within a date rows are ranged
    and sorted by route, in files of about ``file_bytes``, so a scan of one
    route reads the files and row groups whose route range holds it.

    Writing a route of a date again replaces that route's rows of the date; the
    date's other routes, and other dates, stay."""
    from ..functions.geo import wkt_point_sql
    new = static.materialize(features.withColumn("geometry", F.expr(wkt_point_sql("latitude", "longitude"))))
    rows, size = new, stored_bytes(new)
    try:
        old = read_route_features(features.sparkSession, root)
    except AnalysisException:       # nothing is there yet
        old = None
    if old is not None:
        written = static.materialize(new.select("date", "route_id").distinct())
        stays = static.materialize(old.join(written.select("date").distinct(), "date", "left_semi")     # read before its folder is replaced
                                   .join(written, ["date", "route_id"], "left_anti"))
        rows, size = rows.unionByName(stays, allowMissingColumns=True), size + stored_bytes(stays)
    by_date = rows.groupBy("date").agg(F.count(F.lit(1)).alias("n")).agg(F.count(F.lit(1)), F.max("n"), F.sum("n")).first()
    dates, largest, total = (x or 0 for x in by_date)
    n = max(1, math.ceil(size / file_bytes))
    if size * largest <= file_bytes * total:    # every date is a file
        ranged = rows.repartitionByRange(max(n, min(dates, features.sparkSession.sparkContext.defaultParallelism)), "date")
    else:
        ranged = rows.repartitionByRange(n, "date", "route_id")
    out = ranged.sortWithinPartitions("date", "route_id").write.partitionBy("date")
    if old is None:
        out.mode("append").parquet(root)
    else:
        out.mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(root)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that a stored table has."""
    files = df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size")).distinct()
    return files.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]


def write_patterns(patterns: DataFrame, path: str) -> None:
    """K3: save the model table."""
    patterns.write.mode("overwrite").parquet(path)


def predictions_json_lines(pred: DataFrame, key: str = "route_id") -> DataFrame:
    """K4 text: one ``{"key": {"stop": "YYYY-MM-DD HH:MM:SS", ...}}`` per key.
    A stop predicted more than once under a key keeps its latest arrival."""
    pred = pred.groupBy(key, "stop_id").agg(F.max("arrival_ts").alias("arrival_ts"))
    g = pred.groupBy(key).agg(F.map_from_entries(F.collect_list(F.struct(
        "stop_id", format_arrival("arrival_ts")))).alias("m"))
    return g.select(F.to_json(F.create_map(F.col(key).cast("string"), F.col("m"))).alias("value"))


def write_predictions_json(pred: DataFrame, path: str, key: str = "route_id") -> None:
    """K4: write predictions, one key per line."""
    predictions_json_lines(pred, key).write.mode("overwrite").text(path)


def evaluation_json(scores: DataFrame, key: str = "route_id") -> DataFrame:
    """K5 text: ``{"total_routes", "overall_eta_score_minutes", "route_details"}``
    with details in key order (T3)."""
    doc = scores.agg(
        F.count(F.lit(1)).alias("total_routes"),
        F.avg("eta_score_minutes").alias("overall_eta_score_minutes"),
        F.sort_array(F.collect_list(F.struct(F.col(key).cast("string").alias("route_id"),
                                             "eta_score_minutes"))).alias("route_details"))
    return doc.select(F.to_json(F.struct("*")).alias("value"))


def write_evaluation_json(scores: DataFrame, path: str, key: str = "route_id") -> None:
    """K5: write the evaluation document (parent folders are created)."""
    evaluation_json(scores, key).coalesce(1).write.mode("overwrite").text(path)
