"""File source: CSV, JSON lines and Parquet under a folder, new files only."""

from __future__ import annotations

import re
from datetime import datetime

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..operators.schema import ragged_union, widened_union
from ..sinks.files import list_names
from ..spec import SpecError, utc

FILE_CURSOR = "_file_cursor"

# File name endings and the format they stand for.
FORMATS = {
    "csv": ("csv", "tsv"),
    "jsonl": ("jsonl", "ndjson", "json"),
    "parquet": ("parquet", "pq"),
}
SCHEMES = ("", "file", "gs", "s3", "s3a", "hdfs")


def format_of(name: str) -> str:
    ending = name.lower().rpartition(".")[2]
    for fmt, endings in FORMATS.items():
        if ending in endings:
            return fmt
    raise SpecError(f"cannot tell the format of {name!r}; name it: {', '.join(FORMATS)}")


def _any_case(ending: str) -> str:
    return "".join(f"[{c}{c.upper()}]" for c in ending)


def _name_glob(pattern: str, fmt: str) -> str:
    """Glob on file names for the files of one format that the pattern admits."""
    name = pattern.rpartition("/")[2]
    if not name.endswith("*"):
        return name
    return f"{name}.{{{','.join(_any_case(e) for e in FORMATS[fmt])}}}"


def _folder_regex(path: str, pattern: str) -> str | None:
    """Regex on the whole path for the folder part of a pattern; ``None`` if it is only ``**``."""
    folders = pattern.rpartition("/")[0]
    if folders in ("**", ""):
        return None
    steps = {"**/": "(?:.*/)?", "*": "[^/]*", "?": "[^/]"}
    tokens = re.split(r"(\*\*/|\*|\?)", folders + "/")
    body = "".join(steps.get(t, re.escape(t)) for t in tokens)
    return re.escape(path.rstrip("/")) + "/" + body + "[^/]+$"


def _is_unset(since) -> bool:
    return since is None or since == "" or (isinstance(since, datetime) and utc(since).year <= 1970)


class _Listing:
    """Reader options and metadata filters shared by all formats."""

    def __init__(self, spark, path, pattern, cursor, since, name_glob):
        self.spark, self.path = spark, path
        self.recursive = "/" in pattern
        self.regex = _folder_regex(path, pattern)
        self.cursor, self.since, self.name_glob = cursor, since, name_glob

    def new_paths(self) -> str | list[str]:
        """What to give to a reader that looks into the files for their schema: the folder, or
        just the new files.  A reader's own listing holds as many paths on the driver."""
        if _is_unset(self.since):
            return self.path
        return [r.path for r in self.files().collect()]

    def reader(self):
        reader = self.spark.read.option("pathGlobFilter", self.name_glob)
        if self.recursive:
            reader = reader.option("recursiveFileLookup", "true")
        return reader

    def only_new(self, df: DataFrame, columns: list[Column] | None = None) -> DataFrame:
        """Filters on file metadata: Spark drops the files before it reads them.  All columns,
        or those given, and the file cursor."""
        meta = F.col("_metadata")
        value = meta["file_modification_time"]
        if self.cursor == "name":
            value = meta["file_name"]
            if self.path.startswith(("gs://", "s3://", "s3a://")):
                value = F.regexp_replace(meta["file_path"], "^[a-z0-9]+://[^/]+/", "")
        if self.regex is not None:
            df = df.filter(meta["file_path"].rlike(self.regex))
        if not _is_unset(self.since):
            df = df.filter(value > F.lit(self.since))
        if columns is None:
            columns = [F.col(f"`{c}`") for c in df.columns if c != FILE_CURSOR]
        return df.select(*columns, value.alias(FILE_CURSOR))

    def files(self) -> DataFrame:
        """The new files themselves, one row each; their content is not read."""
        return self.only_new(self.reader().format("binaryFile").load(self.path)).select("path")


# Quotes are doubled, never escaped; text after a closing quote is an error that
# names the line; lines may be long.  Without column pruning a row is torn or not whatever
# is selected from it.
_CSV = {"quote": '"', "escape": '"', "emptyValue": "", "enforceSchema": "false", "columnPruning": "false",
        "unescapedQuoteHandling": "RAISE_ERROR", "encoding": "UTF-8", "mode": "PERMISSIVE"}
# What Spark says of files whose types don't go together.
NOT_MERGED = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE", "FAILED_MERGE_FIELDS")
_TORN = "__torn"
_LAST_CELL = "\u0001last cell"


def read_csv(listing: _Listing, delimiter: str = ",", header: bool = True, multiline: bool = True,
             same_header: bool = True, max_columns: int = 20480) -> DataFrame:
    """All-text rows.  An empty cell is ``""``; a row too short is NULL at its end, and one
    with more cells than the header (or than ``max_columns``) is an error that names its
    file and shows the row.  Without a header the longest row sets the columns, found in one
    more pass.

    Quoted line breaks force ``multiline``, which reads each file in one task; turn it
    off for big files without them and Spark splits the files.  With ``same_header`` a
    file whose header differs is an error, never a silent shift of columns; without it
    the headers are looked up first, in one more pass over the text.
    """
    def width(reader, paths) -> int:
        """Cells of the longest row of the new files: what doesn't fit one column comes back as it was, and delimiters
        outside of quotes are counted."""
        whole = listing.only_new(reader.schema(f"one string, {_TORN} string").option("columnNameOfCorruptRecord", _TORN)
                                 .csv(list(paths)), [F.col("one"), F.col(_TORN)])
        bare = F.regexp_replace(_TORN, r'"(?:[^"]|"")*"', "")
        cells = F.length(bare) - F.length(F.replace(bare, F.lit(delimiter), F.lit(""))) + 1
        return whole.agg(F.max(F.coalesce(cells, F.length("one") * 0 + 1, F.lit(1)))).first()[0] or 0

    def read(reader, *paths):
        reader = reader.options(**_CSV, sep=delimiter, header=str(header).lower(), multiLine=str(multiline).lower(),
                                maxColumns=str(max_columns))
        names = reader.csv(list(paths)).columns if header else [f"_c{i}" for i in range(width(reader, paths))]
        fields = [T.StructField(n, T.StringType()) for n in [*names, _TORN]]
        rows = reader.schema(T.StructType(fields)).option("columnNameOfCorruptRecord", _TORN).csv(list(paths))
        # a torn row and one more cell behind it: that cell is not among the header's if the row is too long
        more = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names) + 1)])
        parsed = F.from_csv(F.concat(_TORN, F.lit(delimiter + _LAST_CELL)), more.simpleString()[7:-1].replace(":", " "),
                            {"sep": delimiter, "quote": '"', "escape": '"', "maxColumns": str(max_columns + 1)})
        short = F.array_contains(F.array(*[F.coalesce(parsed[f.name], F.lit("")) for f in more]), _LAST_CELL)
        surplus = F.raise_error(F.concat(F.lit("more cells than the header has in "), F.col("_metadata.file_path"),
                                         F.lit(": "), F.col(_TORN))).cast("string")
        cells = [F.when(F.col(_TORN).isNull(), F.coalesce(F.col(f"`{n}`"), F.lit("")))
                 .when(short, F.col(f"`{n}`")).otherwise(surplus)
                 .alias(n if header else f"col_{i}") for i, n in enumerate(names)]
        return listing.only_new(rows, cells)

    if same_header or not header:
        return read(listing.reader(), listing.path)
    by_header: dict[str, list[str]] = {}
    for row in _headers(listing).collect():
        by_header.setdefault(row["header"], []).append(row["path"])
    return ragged_union(*[read(listing.spark.read, *paths) for paths in by_header.values()])


def _headers(listing: _Listing) -> DataFrame:
    """``path, header``: the first line of every new file."""
    lines = listing.only_new(listing.reader().text(listing.path).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("line"), F.col("_metadata")))
    return lines.filter("start = 0").groupBy("path").agg(F.min_by("value", "line").alias("header"))


def read_jsonl(listing: _Listing, schema: T.StructType | None = None) -> DataFrame:
    """One object per line; blank lines are skipped, anything else ends the job.  Without a
    schema, that of the new files is taken; older ones are not looked at."""
    reader = listing.reader().option("mode", "FAILFAST").option("primitivesAsString", "false")
    if schema is not None:
        reader = reader.schema(schema)
    return listing.only_new(reader.json(listing.new_paths() if schema is None else listing.path))


def _condition(error: Py4JJavaError) -> str | None:
    """The name of a Spark error."""
    java = error.java_exception
    return java.getCondition() if hasattr(java, "getCondition") else None


def read_parquet(listing: _Listing) -> DataFrame:
    """All new files.  Where files type a column differently they are read by groups that agree, found by
    halving, and united: whole numbers become bigint, numbers double, days and times timestamp, anything else text."""
    paths = listing.new_paths()

    def read(paths: list[str]) -> list[DataFrame]:
        try:
            return [listing.only_new(listing.reader().option("mergeSchema", "true").parquet(*paths))]
        except Py4JJavaError as error:
            if _condition(error) not in NOT_MERGED or len(paths) == 1:
                raise
        half = len(paths) // 2
        return [part for side in (paths[:half], paths[half:]) for part in read(side)]

    try:
        parts = read([paths] if isinstance(paths, str) else paths)
    except Py4JJavaError as error:
        if _condition(error) not in NOT_MERGED:
            raise
        parts = read(sorted(r.path for r in listing.files().collect()))
    by_schema: dict[str, DataFrame] = {}
    for part in parts:
        shape = part.schema.json()
        by_schema[shape] = by_schema[shape].unionByName(part) if shape in by_schema else part
    return widened_union(*by_schema.values())


def read_files(spark: SparkSession, path: str, pattern: str = "**/*.csv", fmt: str = "auto",
               cursor: str = "mtime", since=None, delimiter: str = ",", header: bool = True,
               multiline: bool = True, same_header: bool = True,
               json_schema: T.StructType | None = None) -> DataFrame | None:
    """Rows of the files newer than ``since``, stamped with their file cursor.

    ``cursor`` is ``mtime`` (full precision) or ``name``.  ``None`` when no file
    matches, which a load reads as "nothing was read".  Several formats are united by
    column name; a column they type differently becomes text.
    """
    if cursor not in ("mtime", "name"):
        raise SpecError(f"cursor must be 'mtime' or 'name', not {cursor!r}")
    scheme = path.partition("://")[0].lower() if "://" in path else ""
    if scheme not in SCHEMES:
        raise SpecError(f"unsupported scheme {scheme!r}; known: {', '.join(s for s in SCHEMES if s)}")
    if cursor == "mtime" and isinstance(since, str) and since:
        since = datetime.fromisoformat(since)
    if isinstance(since, datetime):
        since = utc(since)
    if not list_names(spark, path):
        return None
    parts = []
    for f, glob in _globs(spark, path, pattern, fmt, cursor, since):
        listing = _Listing(spark, path, pattern, cursor, since, glob)
        if f == "csv":
            parts.append(read_csv(listing, delimiter, header, multiline, same_header))
        elif f == "jsonl":
            parts.append(read_jsonl(listing, json_schema))
        else:
            parts.append(read_parquet(listing))
    return ragged_union(*parts) if parts else None


def _globs(spark, path, pattern, fmt, cursor, since) -> list[tuple[str, str]]:
    """(format, file name glob) of the new files that are there, from one listing.

    A file of an unknown kind is an error unless the format is named.
    """
    name = pattern.rpartition("/")[2]
    files = _Listing(spark, path, pattern, cursor, since, name).files()
    if fmt != "auto":
        if fmt not in FORMATS:
            raise SpecError(f"unknown format {fmt!r}; known: {', '.join(FORMATS)}")
        return [] if files.isEmpty() else [(fmt, name)]
    ending = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    endings = [r[0] for r in files.select(ending.alias("e")).distinct().collect()]
    found = {format_of(f"file.{e}") for e in endings}
    return [(f, _name_glob(pattern, f)) for f in FORMATS if f in found]


def observed_file_cursor():
    """Aggregate: the newest file cursor among the rows read."""
    return F.max(FILE_CURSOR)
