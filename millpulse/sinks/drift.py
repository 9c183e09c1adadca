"""K4: what a batch's schema does to a stored table's.

``schema_diff`` compares column by column.  A new column is taken (older batches read as
null); a type that the stored one widens to without loss widens the table (older
files are read in the wider type, which parquet readers do); a narrower one is cast to
the stored type.  A lost column or any other change of type is refused before a
file is written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Stored type -> types it widens to.
WIDENS = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


class DriftError(ValueError):
    """A batch that the stored table cannot take."""


def schema_diff(stored: StructType, new: StructType) -> dict[str, list[str]]:
    """Columns ``added``, ``lost``, ``widened``, ``narrowed`` and ``changed`` (any other type)."""
    have = {f.name: f.dataType.simpleString() for f in stored.fields}
    want = {f.name: f.dataType.simpleString() for f in new.fields}
    out: dict[str, list[str]] = {"added": [], "lost": [c for c in have if c not in want], "widened": [], "narrowed": [], "changed": []}
    for c, kind in want.items():
        if c not in have:
            out["added"].append(c)
        elif kind in WIDENS.get(have[c], ()):
            out["widened"].append(c)
        elif have[c] in WIDENS.get(kind, ()):
            out["narrowed"].append(c)
        elif kind != have[c]:
            out["changed"].append(c)
    return out


def fitted(df: DataFrame, stored: StructType) -> DataFrame:
    """``df`` as the stored table takes it, its columns in stored order and new ones last; ``DriftError`` if it cannot."""
    diff = schema_diff(stored, df.schema)
    if diff["lost"] or diff["changed"]:
        said = [f"lost {c}" for c in diff["lost"]]
        said += [f"{c} is {df.schema[c].dataType.simpleString()}, stored as {stored[c].dataType.simpleString()}" for c in diff["changed"]]
        raise DriftError("the batch does not fit the stored table: " + "; ".join(said))
    narrow = set(diff["narrowed"])
    kept = [F.col(f.name).cast(f.dataType).alias(f.name) if f.name in narrow else F.col(f.name) for f in stored.fields]
    return df.select(*kept, *diff["added"])
