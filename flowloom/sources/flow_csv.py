"""Messy multi-file flow CSV: inventory, schema discovery, repair, lineage, compact copy."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from flowloom.contracts import HEADER_PREFIX, KNOWN_HEADERLESS
from flowloom.operators.schema import drop_identity, stamp, to_numeric
from flowloom.session import literal_table, settle
from flowloom.sources.files import locate

HEAD_BYTES = 65_536


def _relative(path: Column, root: str) -> Column:
    tail = re.escape(root.rstrip("/").split(":")[-1].lstrip("/"))
    return F.regexp_replace(path, f"^(?:.*?/)?{tail}/", "")


def _decoded(path: Column) -> Column:
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _plain(path: Column) -> Column:
    """A local path without its file: prefix, which listings and scans spell in several ways."""
    return F.regexp_replace(path, "^file:/+", "/")


def lineage(root: str, path: Column) -> dict[str, Column]:
    """Relative path, file name and top folder (= class) of a source path."""
    relative = _relative(path, root)
    return {
        "source_relative_file": relative,
        "source_file_name": F.element_at(F.split(relative, "/"), -1),
        "source_class_folder": F.split(relative, "/")[0],
    }


def list_csv(spark: SparkSession, root: str) -> DataFrame:
    """Paths of all CSV files below root, empty ones included (a scan gives no row for those, so
    they come from the file index that the driver holds for any scan); file contents are not read."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv")
    paths = [(p,) for p in sorted(listing.load(root).inputFiles())]
    encoded = literal_table(spark, paths, "encoded string").repartition(max(1, len(paths) // 1000))
    return encoded.select(_decoded(F.col("encoded")).alias("path")).withColumns(lineage(root, F.col("path")))


def _heads(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Size and first line of each listed file; reads no further than the first line break."""
    for files in batches:
        sizes, lines = [], []
        for uri in files["path"]:
            system, path = locate(uri)
            sizes.append(system.get_file_info(path).size)
            with system.open_input_stream(path) as stream:
                head = b""
                while b"\n" not in head and (more := stream.read(HEAD_BYTES)):
                    head += more
            lines.append(head.split(b"\n", 1)[0].decode("utf-8", "replace").strip())
        yield files.assign(length=sizes, first_line=lines)


def file_inventory(spark: SparkSession, root: str, known_headerless: Sequence[str] = KNOWN_HEADERLESS) -> DataFrame:
    """One row per CSV file: size, first line, column count, header flags.

    An empty file has no header answer (NULL) and is suspicious, as is a file
    without header that is not on the known list.
    """
    files = list_csv(spark, root)
    found = [StructField("length", LongType()), StructField("first_line", StringType())]
    heads = files.mapInPandas(_heads, StructType([*files.schema.fields, *found]))
    known = F.replace("source_relative_file", F.lit("\\"), F.lit("/")).isin(
        [k.replace("\\", "/") for k in known_headerless]
    )
    has_header = F.when(F.col("first_line") != "", F.startswith(F.col("first_line"), F.lit(HEADER_PREFIX)))
    return heads.select(
        "path", "source_relative_file", "source_class_folder", "first_line",
        F.round(F.col("length") / (1024 * 1024), 2).alias("size_mb"),
        has_header.alias("has_header"),
        F.when(F.col("first_line") == "", 0).otherwise(F.size(F.split("first_line", ","))).alias("columns"),
        known.alias("known_headerless"),
        (~F.coalesce(has_header, F.lit(False)) & ~known).alias("suspicious"),
    )


def class_rollup(inventory: DataFrame) -> DataFrame:
    """Files and megabytes per class folder, with header problems."""
    return inventory.groupBy("source_class_folder").agg(
        F.count(F.lit(1)).alias("files"), F.round(F.sum("size_mb"), 2).alias("total_mb"),
        F.count_if("known_headerless").alias("known_headerless"), F.count_if("suspicious").alias("suspicious"),
    )


def canonical_columns(inventory: DataFrame) -> list[str]:
    """Column names of the first file, by path, that has a proper header."""
    good = inventory.where("has_header AND NOT known_headerless")
    first = good.orderBy("source_relative_file").select("first_line").first()
    if first is None:
        raise RuntimeError("no CSV file with a proper header")
    return [c.strip() for c in first.first_line.split(",")]


def file_plans(inventory: DataFrame, columns: Sequence[str], on_suspicious: str) -> DataFrame:
    """(path, header, width, places, known) for each file with a first line: whether that line is a header, the cells of a line, and the
    cell of each of `columns`, -1 for absent ones. A repeated name stands for its first place.

    A file without a known name in its first line that isn't known to be headerless has no `known` name: its columns are taken by position
    ("positional") or absent.
    """
    names = F.transform(F.split("first_line", ","), lambda n: F.regexp_replace(n, r"(?U)^\s+|\s+$", ""))
    by_name = F.array(*(F.array_position(names, F.lit(c)).cast("int") - 1 for c in columns))
    by_place = F.array(*(F.lit(i) for i in range(len(columns))))
    named_files = ~F.col("known_headerless")
    told = inventory.where("first_line <> ''").withColumn("known", ~named_files | F.exists(by_name, lambda i: i >= 0))
    placed = ~named_files | (~F.col("known") & F.lit(on_suspicious == "positional"))
    return told.select("path", (~placed).alias("header"), F.when(placed, len(columns)).otherwise(F.size(names)).alias("width"),
                       F.when(placed, by_place).otherwise(by_name).alias("places"), "known")


def _lines(spark: SparkSession, root: str, header: bool) -> DataFrame:
    """(line, path) of every CSV file below root, byte for byte (as latin-1); with `header`, without the first of each file."""
    reader = spark.read.schema("line string").option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").option("header", header)
    whole = reader.options(sep="\x01", quote="", encoding="ISO-8859-1", maxCharsPerColumn=-1).csv(root)
    return whole.where(F.col("line").isNotNull()).select("line", _plain(_decoded(F.col("_metadata.file_path"))).alias("path"))


def _cells(lines: DataFrame, files: DataFrame, columns: Sequence[str], width: int, tolerant: bool) -> DataFrame:
    """Lines as text columns, by the plan of their file."""
    raw = F.encode("line", "ISO-8859-1").cast("string")
    text = F.when(F.is_valid_utf8(raw), raw).otherwise(F.col("line")) if tolerant else F.make_valid_utf8(raw)
    row = F.from_csv(text, ", ".join(f"c{i} string" for i in range(width + 1)), {"mode": "PERMISSIVE", "maxCharsPerColumn": "-1", "maxColumns": str(width + 2)})
    cells = lines.join(files.withColumn("path", _plain(F.col("path"))), "path").withColumn("row", row).withColumn("cells", F.array(*(F.col(f"row.c{i}") for i in range(width + 1))))
    if tolerant:
        cells = cells.where(~F.col("known") | F.get("cells", F.col("width")).isNull())
    return cells.select(*(F.when(F.get("places", F.lit(i)) >= 0, F.get("cells", F.get("places", F.lit(i)))).alias(c) for i, c in enumerate(columns)), F.col("path").alias("_path"))


def read_flow_csv(
    spark: SparkSession,
    root: str,
    columns: Sequence[str] | None = None,
    known_headerless: Sequence[str] = KNOWN_HEADERLESS,
    tolerant: bool = False,
    on_suspicious: str = "raise",
) -> DataFrame:
    """All CSV files below root as text columns in one schema, with lineage.

    Lines are read as they are and joined to the plan of their file, one small row a file with the cell of each of `columns`
    as its header has it; files and header variants may be any number. Known files without header take the
    columns by position. `tolerant` skips overlong lines and reads lines that
    are not UTF-8 as latin-1. A file whose first line has no known name, and which is not known to
    be headerless, is an error; `on_suspicious` may also read it by position ("positional"), as rows of
    NULL without its first line ("null"), or leave it out ("skip").
    """
    if on_suspicious not in ("raise", "positional", "null", "skip"):
        raise ValueError(f"on_suspicious: {on_suspicious}")
    inventory = file_inventory(spark, root, known_headerless)
    columns = list(columns or canonical_columns(inventory))
    files = settle(file_plans(inventory, columns, on_suspicious), "csv-files")
    unknown = files.where(~F.col("known"))
    if on_suspicious == "raise" and (odd := unknown.orderBy("path").first()):
        raise RuntimeError(f"{odd.path} has no known column name in its first line; say what it is by known_headerless or on_suspicious")
    if on_suspicious == "skip":
        files = files.where("known")
    kinds = {r.header: r.width for r in files.groupBy("header").agg(F.max("width").alias("width")).collect()}  # two rows at most
    if not kinds:
        raise RuntimeError(f"no readable CSV file below {root}")
    parts = []
    for header, width in sorted(kinds.items()):
        lines = _lines(spark, root, header)
        if not header and on_suspicious != "positional":  # prunes the scan to the files of those names
            lines = lines.where(_decoded(F.col("_metadata.file_name")).isin([re.split(r"[\\/]", k)[-1] for k in known_headerless]))
        parts.append(_cells(lines, files.where(F.col("header") == header), columns, width, tolerant))
    return reduce(DataFrame.unionByName, parts).withColumns(lineage(root, F.col("_path"))).drop("_path")


def read_preferred(spark: SparkSession, root: str, reader=read_flow_csv) -> DataFrame:
    """Parquet below root if there is any, else its CSV files."""
    parquet = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if parquet.option("pathGlobFilter", "*.parquet").load(root).select("path").isEmpty():
        return reader(spark, root)
    return spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").parquet(root)


def first_existing(spark: SparkSession, *paths: str) -> DataFrame:
    """The first Parquet table that exists, for example the augmented training set before the plain one."""
    from pyspark.errors import AnalysisException

    for path in paths[:-1]:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":  # a table that is there but empty or broken is an error
                raise
    return spark.read.parquet(paths[-1])


def compact(raw: DataFrame, dataset: str) -> DataFrame:
    """Text rows with lineage to the compact form: meta columns, no identity columns, float32 features."""
    return to_numeric(drop_identity(stamp(raw, dataset)))


def compact_manifest(df: DataFrame, known_headerless: Sequence[str] = KNOWN_HEADERLESS) -> DataFrame:
    """Rows per source file as written, and whether its header was repaired."""
    counts = df.groupBy("source_relative_file", "source_class_folder").agg(F.count(F.lit(1)).alias("rows_written"))
    fixed = F.col("source_relative_file").isin([k.replace("\\", "/") for k in known_headerless])
    return counts.withColumn("headerless_fixed", fixed.cast("int"))


def class_totals(manifest: DataFrame) -> DataFrame:
    return manifest.groupBy("source_class_folder").agg(
        F.count(F.lit(1)).alias("files"), F.sum("rows_written").alias("rows_written")
    )


def write_compact(df: DataFrame, out: str) -> DataFrame:
    """Write zstd Parquet by class folder and return the manifest of what was written.

    Tasks write where they are: no shuffle, and later scans prune by class. For a table that readers
    use while it is replaced, see `tables.commit`.
    """
    df.write.partitionBy("source_class_folder").option("compression", "zstd").parquet(out)
    return compact_manifest(df.sparkSession.read.parquet(out))


def write_splits(df: DataFrame, out: str) -> DataFrame:
    """Write the split table so that a reader of one split prunes the others."""
    df.write.partitionBy("split").option("compression", "zstd").parquet(out)
    return df.sparkSession.read.parquet(out)
