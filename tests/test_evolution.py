"""Catalogues change: what a table takes up, and what it refuses."""

import pytest
from pyspark.sql.types import StructType

from pitlake.sources.catalog import TableSpec
from pitlake.sources.evolution import SchemaRefused, changes
from pitlake.sources.store import Store


def spec(ddl):
    return {"t": TableSpec("t", ("k",), "season", ("k",), None, ddl)}


FIRST = "k string not null, season int not null, a int, b smallint not null"


def test_changes(spark):
    of = lambda a, b, **more: changes("t", StructType.fromDDL(a), StructType.fromDDL(b), {"k"}, **more)
    assert of(FIRST, FIRST) == []
    assert of("k string, a int", "k string, a bigint, c date") == ["widen a from int to bigint", "add c date"]
    assert of("k string, a int not null", "a double, k string") == ["widen a from int to double", "allow NULL in a"]
    for bad in ("k string", "k string, a smallint", "k string, a string", "k string, a int not null", "k int, a int", "k string, a int, c int not null"):
        with pytest.raises(SchemaRefused):
            of("k string, a int", bad)
    assert of("k string, a int", "k string, a int not null", nullable_known=False) == []
    with pytest.raises(SchemaRefused, match="a is int, not string; b would be lost"):
        of("k string, a int, b int", "k string, a string")


def test_a_table_takes_up_columns_and_wider_types(spark, tmp_path):
    root = str(tmp_path / "s")
    first = Store(spark, root, spec(FIRST))
    assert first.migrate() == {}
    first.upsert("t", spark.createDataFrame([("x", 1, 5, 7), ("y", 1, None, 8), ("z", 2, 6, 9)], FIRST))
    assert first.stored_schema("t") == (1, first.tables["t"].schema) and first.migrate() == {}
    later = "k string not null, season int not null, a bigint, b int not null, c double"
    second = Store(spark, root, spec(later))
    before = second.version("t").files
    assert sorted(tuple(r) for r in second.read("t").collect()) == [("x", 1, 5, 7, None), ("y", 1, None, 8, None), ("z", 2, 6, 9, None)]
    assert second.migrate() == {"t": ["widen a from int to bigint", "widen b from smallint to int", "add c double"]} and second.version("t").files == before
    second.upsert("t", spark.createDataFrame([("x", 1, 1 << 40, 70000, 0.5)], later))
    assert sorted(tuple(r) for r in second.read("t").collect()) == [("x", 1, 1 << 40, 70000, 0.5), ("y", 1, None, 8, None), ("z", 2, 6, 9, None)]
    old = Store(spark, root, spec(FIRST))
    with pytest.raises(SchemaRefused, match="a is bigint, not int"):
        old.read("t")
    with pytest.raises(SchemaRefused):
        old.upsert("t", spark.createDataFrame([("x", 1, 5, 7)], FIRST))
    assert second.stored_schema("t")[0] == 2 and second.read("t").count() == 3


def test_a_folder_of_plain_files_has_the_schema_of_its_files(spark, tmp_path):
    spark.createDataFrame([("x", 1, 5)], "k string, season int, a int").write.partitionBy("season").parquet(f"{tmp_path}/t")
    wider = Store(spark, str(tmp_path), spec("k string not null, season int not null, a bigint, c string"))
    assert wider.migrate() == {"t": ["first schema", "widen a from int to bigint", "add c string"]} and wider.migrate() == {}
    assert [tuple(r) for r in wider.read("t").collect()] == [("x", 1, 5, None)]
    with pytest.raises(SchemaRefused):
        Store(spark, str(tmp_path), spec("k string not null, season int not null")).read("t")
