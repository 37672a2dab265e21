"""What a table's schema may become: columns are added, types widened, NOT NULL lifted; all else is refused."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql.types import DataType, StructType

#: Types that a Parquet file of the first is read as without loss.
WIDER = {
    "tinyint": ("smallint", "int", "bigint"),
    "smallint": ("int", "bigint"),
    "int": ("bigint", "double"),
    "float": ("double",),
}


class SchemaRefused(ValueError):
    """The catalogue asks for what stored files cannot be read as."""


def _widens(old: DataType, new: DataType) -> bool:
    return new.simpleString() in WIDER.get(old.simpleString(), ())


def changes(table: str, stored: StructType, wanted: StructType, fixed: Collection[str], nullable_known: bool = True) -> list[str]:
    """What leads from one schema to the other, in words; ``SchemaRefused`` names all that cannot be.

    ``fixed`` columns (keys and partition) never change.  Where ``nullable_known`` is
    false the stored schema comes from files, which do not tell whether NULLs were allowed.
    """
    before, done, refused = {f.name: f for f in stored}, [], []
    for field in wanted:
        old = before.pop(field.name, None)
        what = f"{field.name} {field.dataType.simpleString()}"
        if old is None:
            if field.name in fixed or not field.nullable:
                refused.append(f"new column {what} would be NULL in stored rows")
            else:
                done.append(f"add {what}")
            continue
        if old.dataType != field.dataType:
            if field.name in fixed or not _widens(old.dataType, field.dataType):
                refused.append(f"{field.name} is {old.dataType.simpleString()}, not {field.dataType.simpleString()}")
            else:
                done.append(f"widen {field.name} from {old.dataType.simpleString()} to {field.dataType.simpleString()}")
        if nullable_known and old.nullable != field.nullable:
            if field.nullable:
                done.append(f"allow NULL in {field.name}")
            else:
                refused.append(f"{field.name} may hold NULLs")
    refused += [f"{name} would be lost" for name in before]
    if refused:
        raise SchemaRefused(f"{table}: {'; '.join(refused)}")
    return done
