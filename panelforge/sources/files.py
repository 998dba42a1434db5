"""File scans.  Paths may be local or any Hadoop filesystem URI; directory
listings go through the Hadoop FileSystem API, never a local glob."""

from __future__ import annotations

import csv
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelforge.functions.coerce import normalize_nulls
from panelforge.operators.reshape import union_by_name


# RFC 4180: a quote inside a quoted field is written twice.
CSV_QUOTES = {"quote": '"', "escape": '"'}


def _expand(spark: SparkSession, path: str | Sequence[str]) -> list[str]:
    """Data files behind paths, globs and directories (one level), sorted by name."""
    conf = spark._jsc.hadoopConfiguration()
    out = []
    for one in ([path] if isinstance(path, str) else path):
        p = spark._jvm.org.apache.hadoop.fs.Path(one)
        for s in p.getFileSystem(conf).globStatus(p) or []:
            inner = p.getFileSystem(conf).listStatus(s.getPath()) if s.isDirectory() else [s]
            out += [str(f.getPath().toString()) for f in inner
                    if f.isFile() and not f.getPath().getName().startswith(("_", "."))]
    return sorted(out)


HEADER_READERS = 32


def _first_lines(spark: SparkSession, files: list[str]) -> list[str | None]:
    """The first line of each file (None: the file is empty), a few kilobytes each, through the Hadoop filesystem with its
    codecs; many files are read at once and no Spark job runs for any of them."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def read(name):
        path = jvm.org.apache.hadoop.fs.Path(name)
        stream = path.getFileSystem(conf).open(path)
        try:
            codec = codecs.getCodec(path)
            text = jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8")
            return jvm.java.io.BufferedReader(text).readLine()
        finally:
            stream.close()

    with ThreadPoolExecutor(HEADER_READERS) as pool:
        return list(pool.map(read, files))


def _header_groups(spark: SparkSession, path: str | Sequence[str]) -> dict[tuple[str, ...], list[str]]:
    """Files by their header: only the first line of each is read, and files of one header share a scan.
    Empty files are left out; a path without files raises."""
    files = _expand(spark, path)
    if not files:
        raise FileNotFoundError(f"no CSV files at {path}")
    found: dict[tuple[str, ...], list[str]] = {}
    for f, line in zip(files, _first_lines(spark, files)):
        if line:
            header = next(csv.reader([line.lstrip("\ufeff")]))
            # a column without a name, or a repeated one, is named by its place
            names = [c if c and header.count(c) == 1 else f"{c or '_c'}{i}" for i, c in enumerate(header)]
            found.setdefault(tuple(names), []).append(f)
    return found


def _text_scan(spark: SparkSession, files: list[str], header: Sequence[str], extra: Sequence[str] = (), **options) -> DataFrame:
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*header, *extra)])
    return spark.read.schema(schema).options(header=True, **CSV_QUOTES, **options).csv(files)


def _typed(df: DataFrame, schema: T.StructType) -> list:
    """The schema's columns by name; one that the file lacks is null."""
    have = set(df.columns)
    return [(F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields]


def read_typed_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType | str,
                   null_tokens: Iterable[str] = ("",)) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass).  Columns are
    found by header name, whatever their order in a file; values that do not
    parse as their type become null.  ``null_tokens`` lists the texts that mean
    null, explicitly: a code such as 'NA' stays data unless listed."""
    if not isinstance(schema, T.StructType):
        schema = T._parse_datatype_string(schema)
    out = spark.createDataFrame([], schema)
    for header, files in _header_groups(spark, path).items():
        raw = normalize_nulls(_text_scan(spark, files, header), list(null_tokens))
        out = out.unionByName(raw.select(*_typed(raw, schema)))
    return out


_BAD = "_corrupt_record"


def read_lenient_csv(spark: SparkSession, path: str | Sequence[str], keep_rejects: bool = False, counts: Observation | None = None) -> DataFrame:
    """Every column as text, malformed rows (wrong field count) skipped.  With
    ``keep_rejects`` they are kept instead, with the raw line in ``_corrupt_record``.
    Files whose headers differ are stacked by name.

    ``counts`` is the reject channel: an ``Observation`` that gets ``rows_read`` and ``rows_rejected`` from the very
    scan that delivers the rows, whatever job runs it."""
    frames = [_text_scan(spark, files, header, (_BAD,), mode="PERMISSIVE", columnNameOfCorruptRecord=_BAD, enforceSchema=False, columnPruning=False)
              for header, files in _header_groups(spark, path).items()]
    if not frames:
        return spark.createDataFrame([], T.StructType())
    rows = union_by_name(frames)
    rows = rows.select(*[c for c in rows.columns if c != _BAD], _BAD)
    if counts is not None:
        rows = rows.observe(counts, F.count(F.lit(1)).alias("rows_read"), F.count(_BAD).alias("rows_rejected"))
    return rows if keep_rejects else rows.where(F.col(_BAD).isNull()).drop(_BAD)


#: Name of a dataset in a path: of a file, of a folder of part files, or the value of a partition folder.
STEM = r"/(?:[^/=]+=)?([^/]+?)(?:\.[A-Za-z]+)?(?:/part-[^/]+)?$"


def read_with_provenance(spark: SparkSession, path: str | Sequence[str], group_tag: str,
                         schema: T.StructType | None = None, year_col: str = "SOURCE_FILE_YEAR",
                         group_col: str = "SOURCE_GROUP") -> DataFrame:
    """Many files (a glob or list), each row tagged with its file stem (e.g. the
    year of yearly files) and a source-group label.  One scan per distinct
    header; columns are matched by name.  Part files carry the name of their folder."""
    stem = F.regexp_extract(F.col("_metadata.file_path"), STEM, 1)
    frames = []
    for header, files in _header_groups(spark, path).items():
        raw = _text_scan(spark, files, header)
        cols = ["*"] if schema is None else _typed(raw, schema)
        frames.append(raw.select(*cols, stem.alias(year_col), F.lit(group_tag).alias(group_col)))
    return union_by_name(frames) if frames else spark.createDataFrame([], T.StructType())


def _fs_list(spark: SparkSession, directory: str) -> list[str]:
    jvm = spark._jvm
    conf = spark._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(directory)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().toString()) for s in fs.listStatus(p))


def list_datasets(spark: SparkSession, directory: str, suffix: str = ".csv",
                  exclude: Iterable[str] = ()) -> list[str]:
    """Datasets of a stage directory with the suffix, sorted by name, minus the
    excluded names: files, or folders of part files as Spark writes them."""
    ex = set(exclude)
    return [p for p in _fs_list(spark, directory)
            if p.endswith(suffix) and p.rsplit("/", 1)[-1] not in ex]


def scan_stage_dir(spark: SparkSession, directory: str, exclude: Iterable[str] = (),
                   lenient: bool = True) -> dict[str, DataFrame]:
    """{file name: DataFrame} for every CSV of a stage directory (one frame per
    dataset: their schemas differ)."""
    out = {}
    for p in list_datasets(spark, directory, ".csv", exclude):
        name = p.rsplit("/", 1)[-1]
        out[name] = read_lenient_csv(spark, p) if lenient else union_by_name([_text_scan(spark, files, h) for h, files in _header_groups(spark, p).items()])
    return out


def file_duplicates(spark: SparkSession, directory: str, glob: str = "*.csv") -> DataFrame:
    """(content_hash, kept, removed) for files with identical bytes: the first
    name in sort order is kept, the others reported (nothing is deleted)."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob).load(directory)
             .select(F.regexp_extract("path", r"([^/]+)$", 1).alias("name"),
                     F.sha2(F.col("content"), 256).alias("content_hash")))
    kept = files.groupBy("content_hash").agg(F.min("name").alias("kept"))
    return (files.join(kept, on="content_hash").where(F.col("name") != F.col("kept"))
            .select("content_hash", "kept", F.col("name").alias("removed")).orderBy("kept", "removed"))


def dataset_fingerprint(df: DataFrame, name: str) -> DataFrame:
    """Order-insensitive content fingerprint of a table too large to hash as
    one file: row count and the sum of 64-bit row hashes (as a decimal, so it
    cannot overflow).  Equal tables give equal fingerprints."""
    # xxhash64 skips nulls, so each column goes in with its null flag.
    h = F.xxhash64(*[x for c in df.columns for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]).cast("decimal(38,0)")
    return df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("rows"),
                  F.sum(h).cast("string").alias("fingerprint"))


_SLICES = ((1, 15), (17, 15))


def _row_digest(cols: list[str]):
    """MD5 of a row: each column's null flag, or its text's length and text, so that no two rows read alike."""
    parts = []
    for c in cols:
        text = F.col(f"`{c}`").cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.md5(F.concat_ws("|", *parts).cast("binary"))


def fingerprint_parts(df: DataFrame, name: str, column_sets: dict[str, list[str]] | None = None, by: str | None = None) -> DataFrame:
    """``(dataset, columns, part, rows, low, high)``: mergeable fingerprints of a table, of one or more sets of its columns (default:
    ``all``) and of the parts that the values of ``by`` name (null without it).

    Two 60-bit slices of each row's MD5 are added up, so equal multisets of rows have equal fingerprints whatever their order or
    partitioning, repeated rows count each, and parts add up to the whole (:func:`merge_fingerprints`).  One scan serves all
    column sets.  Values enter as text: null and empty text differ, types with equal texts do not."""
    sets = column_sets or {"all": df.columns}
    digests = F.array(*[F.struct(F.lit(k).alias("columns"), _row_digest(list(c)).alias("digest")) for k, c in sets.items()])
    part = F.col(f"`{by}`").cast("string") if by else F.lit(None).cast("string")
    rows = df.select(part.alias("part"), F.explode(digests).alias("x"))
    number = [F.sum(F.conv(F.substring("x.digest", a, n), 16, 10).cast("decimal(38,0)")) for a, n in _SLICES]
    return rows.groupBy(F.col("x.columns").alias("columns"), "part").agg(F.count("*").alias("rows"), number[0].alias("low"), number[1].alias("high")).select(
        F.lit(name).alias("dataset"), "columns", "part", "rows", "low", "high")


def merge_fingerprints(*parts: DataFrame) -> DataFrame:
    """``(dataset, columns, rows, fingerprint)`` of whole tables from fingerprints of their parts, each part given once.  A table
    without rows has no row here."""
    every = union_by_name(list(parts))
    return every.groupBy("dataset", "columns").agg(F.sum("rows").alias("rows"), F.concat_ws(":", F.sum("low").cast("string"), F.sum("high").cast("string")).alias("fingerprint"))
