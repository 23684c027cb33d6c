"""Reading raw on-time CSV files."""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac import schema
from tarmac.functions import cells
from tarmac.operators.cleaning import conform, normalise_names


def _files(spark: SparkSession, path: str) -> list[str]:
    """The data files of one input (a file, folder or glob), as the readers would list them."""
    conf = spark._jsc.hadoopConfiguration()
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(conf)
    # Without a match of that very name there is no status at all.
    waiting, found = list(system.globStatus(root) or []), []
    while waiting:
        status = waiting.pop()
        if status.isDirectory():
            waiting += [s for s in system.listStatus(status.getPath()) if not s.getPath().getName().startswith(("_", "."))]
        elif status.getLen():
            found.append(status.getPath().toString())
    return sorted(found)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Column names of one file; its first line is read, by whatever file system and codec the name says."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    name = jvm.org.apache.hadoop.fs.Path(path)
    stream = name.getFileSystem(conf).open(name)
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(name)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(codec.createInputStream(stream) if codec else stream, "UTF-8"))
    try:
        line = reader.readLine()
    finally:
        reader.close()
    return tuple(next(csv.reader(io.StringIO((line or "").lstrip("\ufeff"))), ()))


def _headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, tuple[str, ...]]:
    """Headers of all files of all inputs. A line per file, no Spark job; the reads overlap."""
    with ThreadPoolExecutor(max_workers=16) as pool:
        listed = dict(zip(paths, pool.map(lambda p: _files(spark, p), paths)))
        for path, files in listed.items():
            if not files:
                raise ValueError(f"{path} is empty")
        files = list(dict.fromkeys(f for found in listed.values() for f in found))
        return dict(zip(files, pool.map(lambda f: _header(spark, f), files)))


def _text_schema(header: Sequence[str]) -> T.StructType:
    """All columns as text. Blank or repeated header cells get a position name instead."""
    names, seen = [], set()
    for i, cell in enumerate(header):
        key = cell.strip().upper()
        if not key or key in seen:
            cell = f"UNNAMED_{i}"
        seen.add(key)
        names.append(cell)
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


def _united(spark: SparkSession, headers: dict[str, tuple[str, ...]]) -> DataFrame:
    """One scan per layout; every file of a scan has just that header, so columns go by position safely."""
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for path, header in headers.items():
        groups[header].append(path)
    parts = [normalise_names(spark.read.schema(_text_schema(header)).option("header", True).csv(members))
             for header, members in groups.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def _without_tokens(df: DataFrame, tokens: Sequence[str], skip: frozenset[str] = frozenset()) -> DataFrame:
    return df.select(*[F.col(c) if c in skip else cells.blank_to_null(F.col(c), tokens).alias(c) for c in df.columns])


def read_csv(spark: SparkSession, paths: Sequence[str], na_tokens: Sequence[str] = schema.NA_TOKENS) -> DataFrame:
    """All inputs as text columns with missing-value tokens as NULL.

    Each input is a file, folder or glob. Every file's own header says what its columns
    are: files with equal headers are one scan; differing layouts are united by name
    and the absent columns are NULL.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    if not paths:
        raise ValueError("no input files")
    return _without_tokens(_united(spark, _headers(spark, paths)), na_tokens)


def read_records(spark: SparkSession, paths: Sequence[str], target: str = schema.TARGET,
                 na_tokens: Sequence[str] = schema.NA_TOKENS) -> DataFrame:
    """Conformed records, after checking that every file has the required columns."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    if target not in schema.TARGETS:
        raise ValueError(f"target must be one of {schema.TARGETS}")
    if not paths:
        raise ValueError("no input files")
    headers = _headers(spark, paths)
    for path, header in headers.items():
        present = {c.strip().upper() for c in header}
        missing = [c for c in (*schema.REQUIRED, target) if c not in present]
        if missing:
            raise ValueError(f"required columns missing from {path}: {', '.join(missing)}")
    # No missing-value token is a number, so the cast of a numeric column drops them anyway.
    numbers = frozenset(f.name for f in schema.RAW_SCHEMA if isinstance(f.dataType, T.NumericType))
    return conform(_without_tokens(_united(spark, headers), na_tokens, numbers))

