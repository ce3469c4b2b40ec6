"""Footers of Parquet files as rows: what a file holds, without opening its pages.

Types of a column differ between vintages of raw files. Finding out by merging schemas until a
job fails costs failed tasks, each tried four times on a cluster. Here one job opens the footers of
all files, side by side, and what it finds is data: a digest of the schema, the number of rows,
and whether there is a footer at all. Files are opened by Arrow in the tasks; where it
doesn't know the store, the rows say so.
"""

from __future__ import annotations

import hashlib
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# What runs in tasks travels with the task, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SCHEME = re.compile(r"^([A-Za-z][A-Za-z0-9+.-]*):(//[^/]*)?")
# Fixed value: where Spark keeps its own form of the schema in a footer.
_ROW_METADATA = b"org.apache.spark.sql.parquet.row.metadata"

FOOTER = "path string, input string, schema string, n_rows bigint, readable boolean, reached boolean"


def plain(path: str) -> str:
    """A path without scheme and authority."""
    return _SCHEME.sub("", path).rstrip("/")


def file_list(spark: SparkSession, *paths: str, sizes: bool = False) -> DataFrame:
    """``path``, and ``size`` if asked for, of all files below some paths but hidden ones; no file is opened.

    What Spark reads it reads whatever the suffix, so none is asked for. Tasks are cut by
    file size as if files were read. A session of its own lets one task list as many
    files as an even share, not one file each.
    """
    listing = spark.newSession()
    listing.conf.set("spark.sql.files.maxPartitionBytes", "1t")
    reader = listing.read.format("binaryFile").option("recursiveFileLookup", True)
    found = reader.load(list(paths))
    return found.selectExpr("path", "length AS size") if sizes else found.select("path")


def _footer(path: str) -> tuple[str | None, int | None, bool, bool]:
    """Digest of the schema, rows, whether it is readable, and whether the store was reached."""
    import pyarrow.parquet as pq
    from pyarrow import fs

    scheme = _SCHEME.match(path)
    name = scheme[1].lower() if scheme else "file"
    try:
        if name == "file":
            store, inside = fs.LocalFileSystem(), plain(path)
        else:
            store, inside = fs.FileSystem.from_uri(re.sub("^s3[an]:", "s3:", path))
        file = store.open_input_file(inside)
    except Exception:  # noqa: BLE001  a store, a library of it or a right that the task lacks
        return None, None, False, False
    try:
        with file:
            footer = pq.read_metadata(file)
    except Exception:  # noqa: BLE001  not Parquet, or cut off
        return None, None, False, True
    # The first line of the text is the address of an object.
    text = str(footer.schema).partition("\n")[2].encode()
    own = (footer.metadata or {}).get(_ROW_METADATA, b"")
    return hashlib.sha256(text + own).hexdigest(), footer.num_rows, True, True


def footers(spark: SparkSession, paths: list[str], by_directory: bool = False) -> DataFrame:
    """A row of :data:`FOOTER` for each file below some paths, files or directories.

    ``input`` is the one of ``paths`` that a file belongs to, or the directory it is in. A file
    that belongs to two is two rows.
    """
    roots = {plain(path): path for path in paths}

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path in batch["path"]:
                if by_directory:
                    inputs = [path.rpartition("/")[0]]
                else:
                    parts = plain(path).split("/")
                    above = ("/".join(parts[:n]) for n in range(len(parts), 0, -1))
                    inputs = [roots[name] for name in above if name in roots]
                footer = _footer(path)
                rows += [(path, name, *footer) for name in inputs]
            columns = ["path", "input", "schema", "n_rows", "readable", "reached"]
            made = pd.DataFrame(rows, columns=columns)
            yield made.astype({"n_rows": "Int64", "readable": bool, "reached": bool})

    return file_list(spark, *paths).mapInPandas(look, FOOTER)


def joined_schema(schemas: list[T.StructType]) -> T.StructType | None:
    """All columns of some schemas, whatever the case of names; None if a type differs."""
    fields: dict[str, T.StructField] = {}
    for schema in schemas:
        for field in schema:
            known = fields.setdefault(field.name.lower(), field)
            if known.dataType != field.dataType:
                return None
    return T.StructType(list(fields.values()))
