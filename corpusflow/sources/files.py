"""JSON documents and zip archives."""

from __future__ import annotations

import bz2
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

MEMBER_SCHEMA = "archive string, member string, content binary"
_MEMBERS = pa.schema([("archive", pa.string()), ("member", pa.string()), ("content", pa.binary())])
_PACKED_SCHEMA = "archive string, member string, method int, crc long, size long, data binary"
_PACKED = pa.schema(
    [("archive", pa.string()), ("member", pa.string()), ("method", pa.int32()), ("crc", pa.int64()),
     ("size", pa.int64()), ("data", pa.binary())]
)
_BATCH_BYTES = 4 << 20
_LOCAL_HEADER = 30  # fixed value: bytes before a member's name


def read_json_docs(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType | str | None = None,
    multi_line: bool = True,
    mode: str = "FAILFAST",
) -> DataFrame:
    """Many JSON files in parallel: one document, or an array of rows, per file.

    Pass the schema on large inputs; inferring it reads every file once more. A broken file is
    an error; other modes of the reader keep it as nulls or drop it.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path, multiLine=multi_line, mode=mode)


def expand_archives(archives: DataFrame) -> DataFrame:
    """``(path, content)`` of zip files to one row per file member.

    The task that holds an archive reads its central directory and hands on each member as it is
    packed; members are then dealt to tasks by size and unpacked there, so a large archive is the
    work of many. Folder entries are dropped and the archives stay as they are. A damaged member
    (wrong size or checksum) and a folder that cannot be read are errors.
    """
    packed = archives.select("path", "content").mapInArrow(_listed, _PACKED_SCHEMA)
    return packed.hint("rebalance").mapInArrow(_unpacked, MEMBER_SCHEMA)


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The members of archives, still packed, in batches of a few megabytes."""
    rows, size = [], 0
    for batch in batches:
        for path, content in zip(batch.column("path"), batch.column("content")):
            path = path.as_py()
            data = memoryview(content.as_buffer())
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                for entry in archive.infolist():
                    if entry.is_dir():
                        continue
                    rows.append(_packed(path, archive, entry, data))
                    size += len(rows[-1]["data"])
                    if size >= _BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema=_PACKED)
                        rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, schema=_PACKED)


def _packed(path: str, archive: zipfile.ZipFile, entry: zipfile.ZipInfo, data: memoryview) -> dict:
    """A member's bytes as they lie in the archive; those of a rare method are unpacked at once."""
    method = entry.compress_type
    if entry.flag_bits & 0x1:
        raise ValueError(f"{path}: {entry.filename} is encrypted")
    if method in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2):
        at = entry.header_offset + _LOCAL_HEADER
        name, extra = (int.from_bytes(data[at - n : at - n + 2], "little") for n in (4, 2))
        begin = at + name + extra
        content = bytes(data[begin : begin + entry.compress_size])
    else:
        method, content = zipfile.ZIP_STORED, archive.read(entry)
    return {"archive": path, "member": entry.filename, "method": method, "crc": entry.CRC,
            "size": entry.file_size, "data": content}


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for batch in batches:
        for at in range(batch.num_rows):
            [row] = batch.slice(at, 1).to_pylist()
            content = row["data"]
            if row["method"] == zipfile.ZIP_DEFLATED:
                content = zlib.decompress(content, -zlib.MAX_WBITS)
            elif row["method"] == zipfile.ZIP_BZIP2:
                content = bz2.decompress(content)
            if len(content) != row["size"] or zlib.crc32(content) != row["crc"]:
                raise ValueError(f"{row['archive']}: {row['member']} is damaged")
            rows.append({"archive": row["archive"], "member": row["member"], "content": content})
            size += len(content)
            if size >= _BATCH_BYTES:
                yield pa.RecordBatch.from_pylist(rows, schema=_MEMBERS)
                rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, schema=_MEMBERS)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Members of every ``.zip`` file in a folder; other files are ignored.

    The reader packs archives into tasks by size (``spark.sql.files.maxPartitionBytes``); it takes
    files of up to 2 GB each.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path)
    return expand_archives(files)
