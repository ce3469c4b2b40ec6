"""Parquet readers that survive drifting file schemas without losing rows."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from urllib.parse import unquote, urlsplit

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameReader, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from farelake.operators.conform import conform
from farelake.schemas import BRONZE, DEFAULT_DATASET, GOLD, GOLD_TABLE, PARTITION, SILVER
from farelake.sources.footers import file_list, footers, joined_schema, plain

_MERGE_CONFLICTS = ("CANNOT_MERGE_SCHEMAS", "CANNOT_MERGE_INCOMPATIBLE_DATA_TYPE")
_UNDATED = "/year=None/month=None"
_NOTHING_THERE = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")
_LOOKS_AT_ONCE = 8

#: A schema, and the inputs whose files all have it.
Group = tuple[T.StructType, list[str]]


def _reader(
    spark: SparkSession, base_path: str | None = None, skip_corrupt: bool = False
) -> DataFrameReader:
    reader = (
        spark.read.option("int96RebaseMode", "CORRECTED")
        .option("datetimeRebaseMode", "CORRECTED")
        .option("ignoreCorruptFiles", skip_corrupt)
    )
    return reader.option("basePath", base_path) if base_path else reader


def read_raw(
    spark: SparkSession,
    *paths: str,
    schema: T.StructType | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Raw monthly files as they are; columns missing from some files read as null."""
    reader = _reader(spark, skip_corrupt=skip_corrupt)
    reader = reader.schema(schema) if schema else reader.option("mergeSchema", True)
    return reader.parquet(*paths)


def below(base: str, path: Column) -> Column:
    """The part of a file path under ``base``, with or without a scheme on either."""
    parts = urlsplit(base)
    root = parts.path.rstrip("/") or parts.netloc
    return F.regexp_replace(path, rf"^.*?\Q{root}\E/", "")


def scanned_path() -> Column:
    """Path of the file a row was read from, without the escapes of a URI."""
    return F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))


def raw_inputs(
    spark: SparkSession, raw_base: str, dataset: str = DEFAULT_DATASET
) -> list[str]:
    """The monthly inputs of one dataset in ``raw_base``, files or directories.

    Only their names reach the driver: one per month, however many files or rows.
    """
    name = F.regexp_extract(below(raw_base, F.col("path")), rf"^([^/]*\Q{dataset}\E[^/]*)", 1)
    found = file_list(spark, raw_base).select(name.alias("name")).where("name != ''").distinct()
    return sorted(f"{raw_base.rstrip('/')}/{row.name}" for row in found.collect())


def _merged_schema(
    spark: SparkSession, paths: list[str], base_path: str | None, skip_corrupt: bool
) -> T.StructType | None:
    """One schema for all files of some inputs, or None if types of a column differ."""
    try:
        reader = _reader(spark, base_path, skip_corrupt).option("mergeSchema", True)
        return reader.parquet(*paths).schema
    except Exception as error:
        if not any(name in str(error) for name in _MERGE_CONFLICTS):
            raise
        return None


def _groups_by_halves(
    spark: SparkSession, paths: list[str], base_path: str | None, skip_corrupt: bool
) -> list[Group]:
    """Groups found by merging schemas, for stores that tasks cannot look into.

    The list of inputs is halved until each part agrees, down to the files of an input.
    """
    schema = _merged_schema(spark, paths, base_path, skip_corrupt)
    if schema is not None:
        return [(schema, paths)]
    if len(paths) > 1:
        middle = len(paths) // 2
        parts = [paths[:middle], paths[middle:]]
    else:
        files = sorted(row.path for row in file_list(spark, paths[0]).collect())
        if files == paths:
            raise ValueError(f"the types of {paths[0]} cannot be told")
        parts = [files]
    groups: dict[frozenset, Group] = {}
    with ThreadPoolExecutor(len(parts)) as pool:
        found = list(
            pool.map(lambda part: _groups_by_halves(spark, part, base_path, skip_corrupt), parts)
        )
    for members in found:
        for native, inputs in members:
            key = frozenset((f.name.lower(), f.dataType.simpleString()) for f in native)
            groups.setdefault(key, (native, []))[1].extend(inputs)
    return list(groups.values())


def schema_groups(
    spark: SparkSession,
    paths: list[str],
    base_path: str | None = None,
    skip_corrupt: bool = False,
) -> list[Group]:
    """Split inputs into groups whose files agree on types, so a group is one scan.

    One job reads all footers (:mod:`farelake.sources.footers`); what reaches the driver is one row for
    each input and schema. The schema itself is Spark's own reading of one file that has it, so k
    vintages are k looks at one footer more, and no job fails. A group has the columns of all its
    inputs. An input whose own files disagree is split down to its files; the names of that
    input's files are all else that reaches the driver. Stores that tasks cannot look into
    are left to :func:`_groups_by_halves`.
    """
    if not paths:
        return []
    looked = footers(spark, paths)
    found = _by_input(looked)
    if not found:  # Spark's own error says what is missing
        return [(_reader(spark, base_path, skip_corrupt).parquet(*paths).schema, paths)]
    return _groups(spark, looked, found, paths, base_path, skip_corrupt)


def _by_input(looked: DataFrame) -> list[Row]:
    """One row for each input and schema: what of the footers reaches the driver."""
    keys = ["input", "schema", "readable", "reached"]
    return looked.groupBy(*keys).agg(F.min("path").alias("path")).collect()


def _groups(
    spark: SparkSession,
    looked: DataFrame,
    found: list[Row],
    paths: list[str],
    base_path: str | None,
    skip_corrupt: bool,
) -> list[Group]:
    """The groups of some inputs, from what is known of their footers."""
    wanted = set(paths)
    found = [row for row in found if row.input in wanted]
    if not all(row.reached for row in found):
        return _groups_by_halves(spark, paths, base_path, skip_corrupt)
    broken = sorted(row.path for row in found if not row.readable)
    if broken and not skip_corrupt:
        raise ValueError(f"not readable as Parquet: {', '.join(broken[:5])}")
    samples: dict[str, tuple[str, str]] = {}
    for row in sorted(found, key=lambda row: row.path):
        if row.readable:
            samples.setdefault(row.schema, (row.path, row.input))

    def schema_of(sample: tuple[str, str]) -> T.StructType:
        path, below_path = sample
        alone = plain(path) == plain(below_path)
        return _reader(spark, None if alone else base_path or below_path).parquet(path).schema

    with ThreadPoolExecutor(_LOOKS_AT_ONCE) as pool:
        native = dict(zip(samples, pool.map(schema_of, samples.values())))
    groups: list[tuple[T.StructType, set[str]]] = []
    for name, schema in native.items():
        for i, (fields, members) in enumerate(groups):
            joined = joined_schema([fields, schema])
            if joined is not None:
                groups[i] = (joined, members | {name})
                break
        else:
            groups.append((schema, {name}))
    number = {name: i for i, (_, members) in enumerate(groups) for name in members}
    of_input: dict[str, set[int]] = {}
    for row in found:
        if row.readable:
            of_input.setdefault(row.input, set()).add(number[row.schema])
    inputs: list[list[str]] = [[] for _ in groups]
    split = []
    for path in paths:
        numbers = of_input.get(path, set())
        if len(numbers) == 1:
            inputs[numbers.pop()].append(path)
        elif numbers:
            split.append(path)
    if split:
        files = looked.where(F.col("readable") & F.col("input").isin(split))
        for row in files.select("path", "schema").orderBy("path").collect():
            inputs[number[row.schema]].append(row.path)
    return [(schema, members) for (schema, _), members in zip(groups, inputs) if members]


def _widest(types: list[T.DataType]) -> T.DataType:
    """A type every one of ``types`` can be cast to without losing a row."""
    if all(kind == types[0] for kind in types):
        return types[0]
    if all(isinstance(kind, T.IntegralType) for kind in types):
        return T.LongType()
    if all(isinstance(kind, T.NumericType) for kind in types):
        return T.DoubleType()
    if all(isinstance(kind, T.DatetimeType) for kind in types):
        return T.TimestampType()
    return T.StringType()


def read_mixed(
    spark: SparkSession,
    groups: list[tuple[T.StructType, list[str]]],
    more: dict[str, Column] | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """Files of several schemas as one frame; each column has the widest of its types.

    ``more`` adds columns made where the files are read, from ``_metadata`` for one.
    """
    kinds: dict[str, tuple[str, list[T.DataType]]] = {}
    for schema, _ in groups:
        for field in schema:
            kinds.setdefault(field.name.lower(), (field.name, []))[1].append(field.dataType)
    wide = T.StructType([T.StructField(name, _widest(types)) for name, types in kinds.values()])
    more = more or {}
    scans = [
        read_raw(spark, *paths, schema=schema, skip_corrupt=skip_corrupt).withColumns(more)
        for schema, paths in groups
    ]
    return reduce(DataFrame.unionByName, [conform(scan, wide, keep=list(more)) for scan in scans])


def read_inputs(
    spark: SparkSession,
    inputs: list[str],
    skip_corrupt: bool = False,
    more: dict[str, Column] | None = None,
) -> dict[str, DataFrame]:
    """One frame for each raw input, from as few looks at footers as they have schemas.

    ``more`` as in :func:`read_mixed`.
    """
    found: dict[str, list[tuple[T.StructType, list[str]]]] = {path: [] for path in inputs}
    split: list[tuple[T.StructType, list[str]]] = []
    for schema, paths in schema_groups(spark, inputs, skip_corrupt=skip_corrupt):
        for path in paths:
            if path in found:
                found[path].append((schema, [path]))
        split.append((schema, [path for path in paths if path not in found]))
    frames = {}
    for path, groups in found.items():
        if not groups:
            root = urlsplit(path).path.rstrip("/")
            below_path = [
                (schema, [f for f in files if f"{root}/" in unquote(f)]) for schema, files in split
            ]
            groups = [(schema, files) for schema, files in below_path if files]
        if len(groups) > 1:
            frames[path] = read_mixed(spark, groups, more, skip_corrupt)
        else:
            schema, paths = groups[0]
            scan = read_raw(spark, *paths, schema=schema, skip_corrupt=skip_corrupt)
            frames[path] = scan.withColumns(more or {})
    return frames


def _native_scans(spark: SparkSession, root: str, skip_corrupt: bool) -> list[DataFrame]:
    """One scan per schema below ``root``, with ``year`` and ``month`` from the path.

    All footers are looked at in one job. A lake of one schema is one scan. A month directory
    named ``None`` is one without a month. Columns of the same names inside the files
    are ignored.
    """

    def scan(schema: T.StructType, paths: list[str], base_path: str | None) -> DataFrame:
        fields = [field for field in schema if field.name not in PARTITION.names]
        reader = _reader(spark, base_path, skip_corrupt)
        if base_path:
            return reader.schema(T.StructType(fields + PARTITION.fields)).parquet(*paths)
        nulls = {field.name: F.lit(None).cast(field.dataType) for field in PARTITION}
        return reader.schema(T.StructType(fields)).parquet(*paths).withColumns(nulls)

    looked = footers(spark, [root], by_directory=True)
    known = _by_input(looked)
    months = sorted({row.input for row in known})
    undated = [path for path in months if path.endswith(_UNDATED)]
    dated = [path for path in months if path not in undated]
    found = [
        (schema, members, base_path)
        for paths, base_path in ((dated, root), (undated, None))
        if paths
        for schema, members in _groups(spark, looked, known, paths, base_path, skip_corrupt)
    ]
    if len(found) == 1 and found[0][1] == months and not undated:
        return [scan(found[0][0], [root], root)]
    return [scan(*group) for group in found]


def read_bronze(
    spark: SparkSession,
    bronze_base: str,
    dataset: str = DEFAULT_DATASET,
    rename: dict[str, str] | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """All of Bronze in one contract, with ``year`` and ``month`` from the path.

    ``rename`` maps names of other datasets to those of the contract.

    Files are read with their own types by the vectorized reader and cast
    afterwards. Reading an INT64 file directly as double would fail, and with
    corrupt files skipped its rows would be missing without a word.
    """
    scans = _native_scans(spark, f"{bronze_base}/{dataset}", skip_corrupt)
    if not scans:
        return spark.createDataFrame([], T.StructType(BRONZE.fields + PARTITION.fields))
    conformed = [
        conform(scan.withColumnsRenamed(rename or {}), BRONZE, keep=PARTITION.names)
        for scan in scans
    ]
    return reduce(DataFrame.unionByName, conformed)


def read_bronze_month(
    spark: SparkSession,
    leaf: str,
    rename: dict[str, str] | None = None,
    skip_corrupt: bool = False,
) -> DataFrame:
    """One month of Bronze in its contract, from its directory alone."""
    rows = read_inputs(spark, [leaf], skip_corrupt)[leaf]
    return conform(rows.withColumnsRenamed(rename or {}), BRONZE)


def skipped_files(
    spark: SparkSession, bronze_base: str, dataset: str = DEFAULT_DATASET
) -> DataFrame:
    """Bronze files that give fewer rows than their footer says when corrupt ones are
    skipped, and those without rows or a footer.

    Pages that cannot be read show only when they are read: this reads every column again.
    """
    root = f"{bronze_base}/{dataset}"
    path = scanned_path().alias("path")
    files = footers(spark, [root]).select("path", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
    for scan in _native_scans(spark, root, skip_corrupt=True):
        some_value = F.coalesce(*[F.col(name).cast("string") for name in scan.columns])
        # The value is asked for, so that columns are read, and rows of nulls count too.
        read = scan.groupBy(path).agg(F.count("*").alias("n"), F.count(some_value).alias("some"))
        whole = files.join(read.where("some >= 0"), "path").where("n >= n_rows AND n > 0")
        files = files.join(whole.select("path"), "path", "left_anti")
    return files.select("path")


def file_sizes(spark: SparkSession, root: str) -> DataFrame:
    """``path``, ``size``, ``year`` and ``month`` of all files of a table; none is opened."""

    def part(name: str) -> Column:
        text = F.regexp_extract(below(root, F.col("path")), rf"(?:^|/){name}=(\d+)/", 1)
        return text.try_cast("int").alias(name)

    return file_list(spark, root, sizes=True).select("path", "size", part("year"), part("month"))


def read_silver(
    spark: SparkSession, silver_base: str, dataset: str = DEFAULT_DATASET
) -> DataFrame:
    """Silver under its contract; a directory without files reads as no rows."""
    root = f"{silver_base}/{dataset}"
    return _reader(spark, root).schema(SILVER).parquet(root)


def read_gold(spark: SparkSession, gold_base: str) -> DataFrame:
    """Gold under its contract; an error where it was never written."""
    root = f"{gold_base}/{GOLD_TABLE}"
    return _reader(spark, root).schema(GOLD).parquet(root)


def read_gold_or_empty(spark: SparkSession, gold_base: str) -> DataFrame:
    """Gold under its contract, or no rows where it was never written."""
    try:
        return read_gold(spark, gold_base)
    except AnalysisException as error:
        if error.getCondition() not in _NOTHING_THERE:
            raise
        return spark.createDataFrame([], GOLD)


def first_rows(df: DataFrame, limit: int | None) -> DataFrame:
    """The first ``limit`` rows of a Parquet scan, in the order of its files; all without one.

    A plain ``limit`` sends up to ``limit`` rows of every task to one task. Here
    the cut is found from row counts, which the footers hold: every file has at
    least one row, so no more than ``limit`` counts are ever put in order. Rows
    are then kept by their position in their own file, and files behind the cut
    are not opened.
    """
    if not limit:
        return df
    path, position = F.col("_metadata.file_path"), F.col("_metadata.row_index")
    counts = (
        df.groupBy(path.alias("path")).agg(F.count("*").alias("n")).orderBy("path").limit(limit)
    )
    before = F.sum("n").over(Window.orderBy("path")) - F.col("n")
    cut = (
        counts.select("path", (F.lit(limit) - before).alias("room"))
        .where("room > 0")
        .orderBy(F.desc("path"))
        .first()
    )
    if cut is None:
        return df
    return df.where((path <= cut.path) & ((path < cut.path) | (position < cut.room)))
