"""Reading tables under a profile, and writing them."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oddrow.errors import ArtifactWriteError, DataLoadError, SchemaValidationError
from oddrow.functions import cells
from oddrow.profiles import Profile
from oddrow.sources.storage import escape_glob, exists, first_line, holds_files

# Count of unreadable numbers in a row of text; present on tables read from CSV only.
BAD_CELLS = "_bad_cells"
# The text of a row with too many or too few fields, else null.
MALFORMED = "_malformed"
# Files whose heads are read at the same time.
HEADS_AT_ONCE = 16


def _load_error(path: str, exc: Exception) -> DataLoadError:
    text = str(exc)
    if "PATH_NOT_FOUND" in text or "FileNotFoundException" in text:
        return DataLoadError(f"dataset not found: {path}")
    if "AccessControlException" in text or "Permission denied" in text:
        return DataLoadError(f"permission denied when reading dataset: {path}")
    return DataLoadError(f"dataset cannot be read: {path} ({type(exc).__name__})")


def _csv(
    spark: SparkSession, paths: str | list[str], header: bool, multi_line: bool
) -> DataFrame:
    # Doubled quotes inside quoted text, as CSV writers other than Spark produce them.
    reader = spark.read.option("header", header).option("quote", '"').option("escape", '"')
    reader = reader.option("multiLine", multi_line)
    width = len(reader.csv(paths).columns)
    if not width:
        raise DataLoadError(f"dataset contains no parseable data: {paths}")
    # Names by position: real headers may repeat or differ in case only. Without pruning every
    # row is checked for its number of fields.
    names = [f"_c{i}" for i in range(width)]
    schema = ", ".join(f"{n} string" for n in [*names, MALFORMED])
    reader = reader.option("columnNameOfCorruptRecord", MALFORMED).option("columnPruning", False)
    return reader.schema(schema).csv(paths)


def _readable(spark: SparkSession, path: str) -> str:
    return escape_glob(path) if exists(spark, path) else path


def _header(first: Sequence[str | None]) -> list[str]:
    """Header names with repeats numbered ``name.1``, ``name.2``; numbers that a column of the
    file already bears are passed over."""
    raw = [name if name is not None else f"Unnamed: {i}" for i, name in enumerate(first)]
    used: set[str] = set()
    names = []
    for name in raw:
        made, number = name, 0
        while made in used or (number and made in raw):
            number += 1
            made = f"{name}.{number}"
        used.add(made)
        names.append(made)
    return names


def _files_by_header(spark: SparkSession, path: str) -> list[list[str]]:
    """The files of a CSV table, grouped by the text of their first line.

    One file needs no look. Of several, only the head of each is read, some files at a time.
    """
    files = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    if len(files) < 2:
        return [files]
    with ThreadPoolExecutor(HEADS_AT_ONCE) as pool:
        headers = list(pool.map(lambda file: first_line(spark, file), files))
    groups: dict[bytes, list[str]] = {}
    for header, file in zip(headers, files, strict=True):
        if header:
            groups.setdefault(header, []).append(file)
    return sorted(groups.values()) or [files]


def read_csv_text(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """A CSV table with headers as string columns, named as in its files.

    Every file is read under its own header, so files may order their columns differently; files
    that lack a column of others are an error.
    """
    try:
        readable = _readable(spark, path)
        groups = _files_by_header(spark, readable)
        parts: list[DataFrame] = []
        names: dict[frozenset[str], str] = {}
        for files in groups:
            paths = [escape_glob(f) for f in files] if len(groups) > 1 else readable
            parts.append(_under_own_header(spark, paths, multi_line))
            names.setdefault(frozenset(parts[-1].columns), files[0] if files else path)
            if len(names) > 1:
                differ = sorted(frozenset.symmetric_difference(*names))
                raise SchemaValidationError(
                    f"files of '{path}' have different columns: {differ} are in only one of "
                    f"{sorted(names.values())}"
                )
        rows = parts[0]
        for part in parts[1:]:
            rows = rows.unionByName(part)
        if rows.isEmpty():
            raise DataLoadError(f"dataset is empty (no records after the header): {path}")
    except (PySparkException, Py4JJavaError) as exc:
        raise _load_error(path, exc) from exc
    return rows


def _under_own_header(
    spark: SparkSession, paths: str | list[str], multi_line: bool
) -> DataFrame:
    first = _csv(spark, paths, False, multi_line).drop(MALFORMED).first()
    return _csv(spark, paths, True, multi_line).toDF(*_header(first), MALFORMED)


def read_headerless_csv(
    spark: SparkSession, path: str, header: Sequence[str], multi_line: bool = False
) -> DataFrame:
    """A CSV file without a header as string columns under a declared header."""
    try:
        rows = _csv(spark, _readable(spark, path), False, multi_line)
    except (PySparkException, Py4JJavaError) as exc:
        raise _load_error(path, exc) from exc
    if len(rows.columns) - 1 != len(header):
        raise SchemaValidationError(
            f"'{path}' has {len(rows.columns) - 1} columns, expected {len(header)}"
        )
    return rows.toDF(*header, MALFORMED)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    try:
        rows = spark.read.parquet(escape_glob(path) if exists(spark, path) else path)
        if rows.isEmpty():
            raise DataLoadError(f"dataset is empty (no records): {path}")
    except (PySparkException, Py4JJavaError) as exc:
        raise _load_error(path, exc) from exc
    return rows


def check_columns(
    columns: Iterable[str], profile: Profile, source: str = "table", label_required: bool = True
) -> None:
    """Every required column must be there, in exactly this spelling; all missing ones are named."""
    present = set(columns)
    wanted = profile.required if label_required else profile.features
    missing = [c for c in wanted if c not in present and c not in profile.sources]
    if missing:
        raise SchemaValidationError(
            f"schema validation failed for '{source}': missing columns ({len(missing)}): {missing}"
        )


def _source(profile: Profile, name: str, positions: dict[str, str]) -> Column:
    expression = profile.sources.get(name)
    return F.expr(expression) if expression else F.col(positions[name])


def project(
    df: DataFrame,
    profile: Profile,
    extras: Sequence[str] | None = None,
    from_text: bool = False,
    source: str = "table",
    label_required: bool = True,
) -> DataFrame:
    """Required columns in profile order and type, then ``extras`` (default: all others).

    Columns are picked by exact name. With ``from_text`` missing spellings become null, and
    unreadable numbers and a wrong number of fields are counted per row in ``_bad_cells``.
    """
    check_columns(df.columns, profile, source, label_required)
    has_label = profile.label in df.columns or profile.label in profile.sources
    required = profile.required if has_label else profile.features
    if profile.sources:
        positions = {c: cells.quoted(c) for c in df.columns}
        safe = df
    else:
        # Spark resolves names without regard to case; unique position names do not clash.
        positions = {c: f"_p{i}" for i, c in enumerate(df.columns)}
        safe = df.toDF(*positions.values())

    out: list[Column] = []
    for name in required:
        raw = _source(profile, name, positions)
        if name in profile.numeric:
            typed = cells.number(raw)
        elif name == profile.label and isinstance(profile.normal, int):
            typed = cells.whole_number(raw)
        else:
            typed = cells.text_cell(raw) if from_text else raw.cast("string")
        out.append(typed.alias(name))

    folded = {c.lower() for c in required}
    if extras is None:
        extras = [c for c in df.columns if c not in (*required, BAD_CELLS, MALFORMED)]
    for name in extras:
        if name not in positions:
            raise SchemaValidationError(f"'{source}' lacks the column '{name}'")
        index = list(positions).index(name)
        clash = name.lower() in folded
        out.append(F.col(positions[name]).alias(f"{name}_{index}" if clash else name))
    if from_text:
        bad = F.lit(0)
        if MALFORMED in df.columns:
            bad = F.when(F.col(positions[MALFORMED]).isNotNull(), 1).otherwise(0)
        for name in profile.numeric:
            bad = bad + cells.bad_number(_source(profile, name, positions))
        out.append(bad.alias(BAD_CELLS))
    return safe.select(*out)


def load_table(
    spark: SparkSession,
    path: str,
    profile: Profile,
    extras: Sequence[str] | None = None,
    label_required: bool = True,
    multi_line: bool = False,
) -> DataFrame:
    """Read a table under a profile: Parquet if its files say so, else CSV with a header."""
    is_parquet = path.rstrip("/").endswith(".parquet") or holds_files(spark, path, ".parquet")
    rows = read_parquet(spark, path) if is_parquet else read_csv_text(spark, path, multi_line)
    return project(rows, profile, extras, not is_parquet, path, label_required)


def write_table(
    df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()
) -> None:
    """Write a table as Parquet, or as CSV with a header and no index."""
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    try:
        if fmt == "csv":
            writer.option("header", True).option("escape", '"').csv(path)
        else:
            writer.format(fmt).save(path)
    except (PySparkException, Py4JJavaError) as exc:
        raise ArtifactWriteError(f"cannot write '{path}': {type(exc).__name__}: {exc}") from exc
