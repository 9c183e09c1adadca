"""Yearly raw files.

``{prefix}/{name}_{year}.parquet`` per source.  Before anything is loaded all
five files must exist and carry every declared column: an explicit schema
would otherwise read a missing file as an error halfway through the load and
a missing column silently as NULLs.  The checks only read parquet footers.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from millpulse.sources.schemas import SOURCE_NAMES, schema


class SourceError(FileNotFoundError):
    pass


def year_path(prefix: str, name: str, year: int | str) -> str:
    return f"{prefix.rstrip('/')}/{name}_{year}.parquet"


_NO_DATA = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def file_schema(spark: SparkSession, path: str) -> StructType | None:
    """Schema stored in the file (footer read), or None when there is no data file.

    Epoch columns may be plain INT64 or INT64 annotated as TIMESTAMP(NANOS); the
    session settings (``session.SQL_REQUIRED``) have both read as BIGINT.
    """
    try:
        return spark.read.parquet(path).schema
    except AnalysisException as exc:
        # missing path, or a folder without data files (e.g. left by an aborted write)
        if exc.getCondition() in _NO_DATA:
            return None
        raise


# Stored types a declared type can be read from (parquet reads widen these).
_READABLE_AS = {
    "bigint": {"bigint", "int", "smallint", "tinyint"},
    "double": {"double", "float"},
}


def _compatible(stored: str, declared: str) -> bool:
    return stored == declared or stored in _READABLE_AS.get(declared, ())


def check_sources(
    spark: SparkSession, prefix: str, year: int | str, names: list[str] = SOURCE_NAMES
) -> None:
    """Raise listing every missing file, every declared column a file lacks and
    every column stored in a type the declared read cannot widen from."""
    problems = []
    for name in names:
        path = year_path(prefix, name, year)
        found = file_schema(spark, path)
        if found is None:
            problems.append(f"missing file: {path}")
            continue
        have = {f.name.lower(): f.dataType.simpleString() for f in found.fields}
        declared = schema(name).fields
        lacking = [f.name for f in declared if f.name.lower() not in have]
        if lacking:
            problems.append(f"{path} lacks columns: {', '.join(lacking)}")
        wrong = [
            f"{f.name} is {have[f.name.lower()]}, declared {f.dataType.simpleString()}"
            for f in declared
            if f.name.lower() in have and not _compatible(have[f.name.lower()], f.dataType.simpleString())
        ]
        if wrong:
            problems.append(f"{path} has columns of another type: {'; '.join(wrong)}")
    if problems:
        raise SourceError("sources incomplete:\n  " + "\n  ".join(problems))


def read_raw(spark: SparkSession, prefix: str, name: str, year: int | str) -> DataFrame:
    """Declared-schema read of one yearly file (no inference, epochs as BIGINT)."""
    return spark.read.schema(schema(name)).parquet(year_path(prefix, name, year))

