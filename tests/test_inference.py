from __future__ import annotations

import datetime
from decimal import Decimal

import pytest

from tidelake.sources.files import read_csv
from tidelake.sources.inference import infer_types, read_csv_typed, typed

KINDS = [
    (["1", "-20", None, "0"], "bigint"),
    (["9" * 18], "bigint"),
    (["9" * 19], "decimal(19,0)"),
    (["9" * 39], "string"),
    (["1", "2.50", "-300.1"], "decimal(5,2)"),
    (["0.5", "0.25"], "decimal(2,2)"),
    (["-0.5"], "decimal(1,1)"),
    (["0.0"], "decimal(1,1)"),
    (["1.5", "2e5"], "double"),
    (["1234567890123456", "2e5"], "string"),  # a double would not give the number back
    (["007", "8"], "string"),
    (["01.5"], "string"),
    (["-0"], "string"),
    (["-0.0"], "string"),
    (["+5"], "string"),
    ([" 5"], "string"),
    (["5\n"], "string"),
    (["1.", ".5"], "string"),
    (["NaN"], "string"),
    (["", "1"], "string"),
    (["2024-02-29", None], "date"),
    (["2023-02-29"], "string"),
    (["2024-01-01", "2024-01-01T10:00:00.5"], "timestamp_ntz"),
    (["2024-01-01 25:00:00"], "string"),
    (["2024-01-01 10:00:00.1234567"], "string"),
    (["2024-01-01", "5"], "string"),
    (["true", "false"], "boolean"),
    (["true", "1"], "string"),
    ([None, None], "string"),
    (["٣"], "string"),
]


def test_each_column_has_the_least_type_that_holds_it(spark):
    longest = max(len(values) for values, _ in KINDS)
    rows = [tuple(values[i] if i < len(values) else None for values, _ in KINDS) for i in range(longest)]
    # Names that would clash or break a plain reference.
    names = [f"c{i}" if i % 2 else f"a.`{i}`" for i in range(len(KINDS))]
    df = spark.createDataFrame(rows, ", ".join(f"`{n.replace('`', '``')}` string" for n in names))
    found = {r["column"]: (r["type"], r["filled"]) for r in infer_types(df).collect()}
    assert found == {
        name: (kind, sum(v is not None for v in values)) for name, (values, kind) in zip(names, KINDS, strict=True)
    }
    back = typed(df)
    assert [f.dataType.simpleString() for f in back.schema] == [kind for _, kind in KINDS]
    for name, (values, kind) in zip(names, KINDS, strict=True):
        got = [row[name] for row in back.collect()][: len(values)]
        assert [g is None for g in got] == [v is None for v in values]
        if kind == "bigint" or kind.startswith("decimal"):
            assert got == [None if v is None else type(g)(v) for v, g in zip(values, got, strict=True)]
        if kind == "string":
            assert got == values


def test_one_scan_and_one_shuffle_of_single_rows(spark, tmp_path):
    spark.sql("select 1 a, '02' b").write.option("header", True).csv(str(tmp_path / "x"))
    plan = infer_types(read_csv(spark, str(tmp_path / "x")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.count("Exchange") == 1 and "Python" not in plan


def test_a_csv_file_in_types(spark, tmp_path):
    file = tmp_path / "people.csv"
    file.write_text('id,zip,paid,born,seen\n1,01234,3.50,1988-03-02,2024-01-01T00:00:11.172425\n2,,10.00,,\n')
    df = read_csv_typed(spark, str(file))
    assert [r.asDict() for r in df.orderBy("id").limit(1).collect()] == [{
        "id": 1, "zip": "01234", "paid": Decimal("3.50"), "born": datetime.date(1988, 3, 2),
        "seen": datetime.datetime(2024, 1, 1, 0, 0, 11, 172425),
    }]


def test_empty_and_other_types(spark):
    df = spark.createDataFrame([], "a string, n int")
    assert sorted(map(tuple, infer_types(df).collect())) == [("a", "string", 0), ("n", "int", 0)]
    assert typed(df).dtypes == [("a", "string"), ("n", "int")]
    with pytest.raises(ValueError):
        infer_types(df.select())
