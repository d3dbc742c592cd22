"""CSV files by header name: headers read alone, and files that are broken inside kept apart from the others.

Two ways, because two things are wanted. `read_by_layout` is for tables of any size: the first line of each file is taken by a job that stops
there, files with the same header are read together by Spark's CSV reader, which splits them and reads the wanted columns only. No row is
read twice and nothing is joined. `read_whole` is for result files of many runs, any of which may be damaged: a file comes whole to one task,
is tested to its end, and gives either all of its rows or one row with the reason why not. Files too large for that go by the first way, after
a pass that looks for what is wrong with them.
"""

from __future__ import annotations

import bz2
import codecs
import csv
import gzip
import io
import lzma
import re
import sys
import zlib
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from gleanwork import lexicons as lx

#: Files up to this size come whole to one task.
WHOLE_BYTES = 128 << 20
#: Jobs for single files that run at once.
AT_ONCE = 16
NO_HEADER, NO_COLUMN = "no header", "no known column"


def listed(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(path, length) of the files; nothing of them is read."""
    return spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path)).select("path", "length")


def _quoted(path: str) -> str:
    """A file's path for a reader, which would take some characters for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def split_header(line: str) -> list[str]:
    return [name.strip() for name in next(csv.reader([line.removeprefix("﻿").rstrip("\r\n")]), [])]


def headers(spark: SparkSession, files: Sequence[str]) -> dict[str, list[str]]:
    """The names in the first line of each file that has one: one row read per file."""

    def first(file: str) -> list[str]:
        row = spark.read.text(_quoted(file)).head()
        return split_header(row["value"]) if row is not None else []

    with ThreadPoolExecutor(AT_ONCE) as pool:
        return {f: names for f, names in zip(files, pool.map(first, files)) if names}


def _typed(rows: DataFrame, schema: str, *more: str) -> DataFrame:
    """Empty cells and the written `N/A` as null; what does not fit its type too."""
    return rows.select(*[F.nullif(F.col(f"`{f.name}`"), F.lit("")).try_cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema).fields], *more)


def read_by_layout(spark: SparkSession, layouts: dict[str, list[str]], schema: str, multi_line: bool = False) -> DataFrame:
    """The schema's columns and `file_path` of files with known headers; a column that a file lacks is null. One scan per distinct header."""
    wanted = StructType.fromDDL(schema).names
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, names in layouts.items():
        groups.setdefault(tuple(names), []).append(_quoted(file))
    text = ", ".join(f"`{n}` STRING" for n in [*wanted, "file_path"])
    out = _typed(spark.createDataFrame([], text), schema, "file_path")
    for i, (names, files) in enumerate(sorted(groups.items())):
        cells = StructType([StructField(f"c{k}", StringType()) for k in range(len(names))])
        rows = (
            spark.read.schema(cells).option("header", True).option("nullValue", lx.NOT_AVAILABLE).option("emptyValue", "")
            .option("multiLine", multi_line).option("escape", '"').csv(files)
        )
        by_name = [F.col(f"c{names.index(n)}") if n in names else F.lit(None).cast("string") for n in wanted]
        one = _typed(rows.select(*[c.alias(n) for c, n in zip(by_name, wanted)], F.col("_metadata.file_path").alias("file_path")), schema, "file_path")
        out = one if i == 0 else out.unionByName(one)
    return out


# --- whole files ---------------------------------------------------------------------------------


def _opened(content: bytes) -> io.BufferedIOBase:
    """The text's bytes, unpacked if the first ones say so."""
    raw = io.BytesIO(content)
    if content[:2] == b"\x1f\x8b":
        return gzip.GzipFile(fileobj=raw)
    if content[:3] == b"BZh":
        return bz2.BZ2File(raw)
    if content[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMAFile(raw)
    return raw


def fault_of(content: bytes) -> str | None:
    """What is wrong with a file, read to its end; None if nothing."""
    decoder = codecs.getincrementaldecoder("utf-8")()
    try:
        with _opened(content) as stream:
            while chunk := stream.read(1 << 20):
                decoder.decode(chunk)
            decoder.decode(b"", final=True)
    except UnicodeDecodeError as e:
        return f"not UTF-8: {e.reason}"
    except (EOFError, OSError, zlib.error, lzma.LZMAError) as e:
        return f"damaged: {e}"
    return None


def _parsed(wanted: Sequence[str], rows_at_once: int = 10_000) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    names = [*wanted, "file_path", "names", "reason"]
    types = [*[pa.string()] * len(wanted), pa.string(), pa.list_(pa.string()), pa.string()]

    def batch_of(rows: list[list], path: str, header: list[str], reason: str | None) -> pa.RecordBatch:
        cells = [pa.array([r[i] for r in rows], pa.string()) for i in range(len(wanted))]
        same = [pa.array([x] * len(rows), t) for x, t in zip((path, header, reason), types[-3:])]
        return pa.RecordBatch.from_arrays([*cells, *same], schema=pa.schema(list(zip(names, types))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content")):
                path, content = path.as_py(), content.as_py()
                header, reason = [], fault_of(content)
                if reason is None:
                    lines = csv.reader(io.TextIOWrapper(_opened(content), encoding="utf-8-sig", newline=""))
                    header = [name.strip() for name in next(lines, [])]
                    reason = None if set(header) & set(wanted) else NO_COLUMN if header else NO_HEADER
                if reason is not None:
                    yield batch_of([[None] * len(wanted)], path, header, reason)
                    continue
                places = [header.index(n) if n in header else None for n in wanted]
                held: list[list] = []
                for cells in lines:
                    if not cells:
                        continue
                    row = [cells[p] if p is not None and p < len(cells) else None for p in places]
                    held.append([None if x in ("", lx.NOT_AVAILABLE) else x for x in row])
                    if len(held) >= rows_at_once:
                        yield batch_of(held, path, header, None)
                        held = []
                if held:
                    yield batch_of(held, path, header, None)

    return run


def _large_fault(spark: SparkSession, file: str) -> str | None:
    try:
        bad = spark.read.text(_quoted(file)).filter(~F.is_valid_utf8("value")).limit(1).count()
        return "not UTF-8" if bad else None
    except Exception as e:  # noqa: BLE001 - whatever ends the reading of a file is its fault
        return f"damaged: {str(e).splitlines()[0]}"


def read_whole(
    spark: SparkSession, path: str | Sequence[str], schema: str, multi_line: bool = False, whole_bytes: int = WHOLE_BYTES
) -> DataFrame:
    """The schema's columns, `file_path`, `names` (the header) and `reason`: the rows of every sound file, `reason` null, and one row for every
    other with the reason. Files above `whole_bytes` are looked through first, each by a job, and read by layout."""
    wanted = StructType.fromDDL(schema).names
    files = spark.read.format("binaryFile").load(path if isinstance(path, str) else list(path))
    text = ", ".join(f"`{n}` STRING" for n in [*wanted, "file_path"]) + ", names ARRAY<STRING>, reason STRING"
    small = files.filter(F.col("length") <= whole_bytes).select("path", "content")
    out = _typed(small.mapInArrow(_parsed(wanted), text), schema, "file_path", "names", "reason")
    large = [r["path"] for r in files.filter(F.col("length") > whole_bytes).select("path").collect()]
    if not large:
        return out
    with ThreadPoolExecutor(AT_ONCE) as pool:
        faults = dict(zip(large, pool.map(lambda f: _large_fault(spark, f), large)))
    layouts = headers(spark, [f for f, fault in faults.items() if fault is None])
    for f, fault in list(faults.items()):
        faults[f] = fault or (NO_HEADER if f not in layouts else None if set(layouts[f]) & set(wanted) else NO_COLUMN)
    sound = {f: names for f, names in layouts.items() if faults[f] is None}
    rows = read_by_layout(spark, sound, schema, multi_line).withColumns({"names": F.lit(None).cast("array<string>"), "reason": F.lit(None).cast("string")})
    told = spark.createDataFrame([(f, layouts.get(f, []), r) for f, r in faults.items() if r is not None], "file_path STRING, names ARRAY<STRING>, reason STRING")
    return out.unionByName(rows).unionByName(told, allowMissingColumns=True)
