"""Normalise, derive and conform on hand-made edge inputs."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmark.contracts import BUNDLED, Contract, bundled_contracts, load_contracts
from shelfmark.functions import double_to_text, refresh_text_at, time_of_day_from_interval
from shelfmark.operators import (
    Profile,
    conform,
    kept_columns,
    normalize,
    profile,
    profile_frame,
    with_audit,
    with_partition_keys,
)
from shelfmark.plans import conform_dataset, refresh_rows


def column(spark, values, kind):
    return spark.createDataFrame([(value,) for value in values], f"c {kind}")


def conformed(spark, values, kind, declared):
    contract = Contract({"c": declared} if declared else {"other": "string"})
    out = conform_dataset(normalize(column(spark, values, kind)), contract)
    return dict(out.dtypes)["c"], [row.c for row in out.collect()]


@pytest.mark.parametrize(
    "values, kind, declared, expected",
    [
        ([1.0, None], "double", None, ("bigint", [1, None])),
        ([None, None], "double", None, ("bigint", [None, None])),
        ([1.0, math.nan], "double", None, ("bigint", [1, None])),
        ([1.0, 2.5], "double", None, ("double", [1.0, 2.5])),
        ([1.0, math.inf], "double", None, ("double", [1.0, math.inf])),
        ([1.0, 1e300], "double", None, ("double", [1.0, 1e300])),
        ([2.0**63], "double", None, ("double", [2.0**63])),
        ([-(2.0**63)], "double", None, ("bigint", [-(2**63)])),
        ([7], "bigint", "date", ("bigint", [7])),
        ([7.0], "double", "date", ("bigint", [7])),
        ([7.5], "double", "date", ("double", [7.5])),
        (["1", "x"], "string", "int64", ("string", ["1", "x"])),
        (["1", None], "string", "int64", ("bigint", [1, None])),
        (["1.0"], "string", "int64", ("string", ["1.0"])),
        ([1.9, -1.9], "double", "int64", ("bigint", [1, -1])),
        ([1.5, math.inf], "double", "int64", ("double", [1.5, math.inf])),
        ([3.0], "double", "float64", ("double", [3.0])),
        ([3], "int", "float64", ("double", [3.0])),
        (["1.5", " 2 "], "string", "float64", ("double", [1.5, 2.0])),
        (["1d"], "string", "float64", ("string", ["1d"])),
        (["0x1p3"], "string", "float64", ("string", ["0x1p3"])),
        (["inf"], "string", "float64", ("double", [math.inf])),
        ([None, "a"], "string", "string", ("string", [None, "a"])),
        ([Decimal("12.50"), Decimal("3.00")], "decimal(10,2)", "string", ("string", ["12.5", "3.0"])),
        ([Decimal("12.00")], "decimal(10,2)", "string", ("string", ["12"])),
        ([12345678.5], "double", "string", ("string", ["12345678.5"])),
        ([123.0, None], "double", "string", ("string", ["123", None])),
        ([5, None], "int", None, ("bigint", [5, None])),
        ([True, None], "boolean", "int64", ("bigint", [1, None])),
        ([True], "boolean", "string", ("string", ["true"])),
        ([True], "boolean", "date", ("boolean", [True])),
        (["2024-01-05"], "string", "date", ("date", [date(2024, 1, 5)])),
        (["2024-01-05", "soon"], "string", "date", ("string", ["2024-01-05", "soon"])),
        ([date(2024, 1, 5)], "date", "string", ("string", ["2024-01-05"])),
        ([date(2024, 1, 5)], "date", "int64", ("date", [date(2024, 1, 5)])),
        (
            [datetime(2024, 1, 5, 1, 2, 3, 456789)], "timestamp_ntz", "timestamp",
            ("timestamp_ntz", [datetime(2024, 1, 5, 1, 2, 3, 456000)]),
        ),
        (
            [datetime(2024, 1, 5, 1, 2, 3, 456789)], "timestamp_ntz", "datetime",
            ("timestamp_ntz", [datetime(2024, 1, 5, 1, 2, 3, 456789)]),
        ),
        ([b"ok"], "binary", "string", ("string", ["ok"])),
        ([None], "void", None, ("string", [None])),
        ([1.0], "double", "weird", ("bigint", [1])),
        ([["a"]], "array<string>", "string", ("array<string>", [["a"]])),
    ],
)
def test_one_column(spark, values, kind, declared, expected):
    assert conformed(spark, values, kind, declared) == expected


def test_invalid_utf8_is_not_text(spark):
    kind, values = conformed(spark, [b"\xff\xfe"], "binary", "string")
    assert kind == "binary" and bytes(values[0]) == b"\xff\xfe"


def test_without_contract_nothing_changes(spark):
    for contract in (None, Contract({})):
        out = conform_dataset(column(spark, [1.0], "double"), contract)
        assert out.dtypes == [("c", "double")]


def test_missing_columns_get_typed_defaults_in_contract_order(spark):
    contract = Contract(
        {"t": "timestamp", "c": "int64", "s": "string", "i": "int64", "f": "float64", "d": "date", "w": "datetime",
         "q": "weird"}
    )
    out = conform_dataset(column(spark, [1], "bigint"), contract)
    epoch = datetime(1970, 1, 1)
    assert out.columns == ["c", "t", "s", "i", "f", "d", "w", "q"]
    assert tuple(out.first()) == (1, epoch, "", 0, 0.0, date(1970, 1, 1), epoch, "")


def test_names_are_case_exact(spark, case_sensitive):
    source = spark.createDataFrame([("a",)], "datavenda string")
    out = conform_dataset(source, Contract({"DataVenda": "string"}))
    assert out.columns == ["datavenda", "DataVenda"]
    assert tuple(out.first()) == ("a", "")
    audited = with_audit(spark.createDataFrame([("x",)], "idempresa string"), "T1")
    assert audited.columns == ["idempresa", "DataHoraAtualizacao", "idEmpresa", "idEmp"]


def test_odd_column_names(spark):
    source = spark.createDataFrame([(1.0, "x")], "`a.b` double, `c``d` string")
    out = conform_dataset(normalize(source), Contract({"c`d": "string"}))
    assert out.dtypes == [("a.b", "bigint"), ("c`d", "string")]


def test_kept_columns_are_noted(spark):
    source = spark.createDataFrame([(7, "x")], "a bigint, b string")
    contract = Contract({"a": "date", "b": "int64", "z": "string"})
    facts = profile(source, contract)
    assert facts == Profile(1, {}, {"b": 1})
    assert kept_columns(source, contract, facts) == {
        "a": "bigint cannot become date", "b": "1 values are no int64",
    }


def test_profile_only_asks_what_is_open(spark):
    source = spark.createDataFrame([(1.0, 2.0, 3, "x")], "a double, b double, c bigint, d string")
    contract = Contract({"a": "float64", "b": "string", "c": "string", "d": "string"})
    assert [row.column for row in profile_frame(source, contract).collect()] == ["b"]
    assert profile_frame(source.select("c", "d"), contract).collect() == []


def test_a_fraction_after_the_profile_fails_the_write(spark):
    facts = Profile(1, whole={"c": True})
    frame = conform(column(spark, [1.5], "double"), Contract({"x": "string"}), facts)
    with pytest.raises(Exception, match="changed between profile and write"):
        frame.collect()


def test_audit_overwrites_in_place(spark):
    source = spark.createDataFrame([("mine", 1)], "idEmpresa string, v int")
    out = with_audit(source, "T1", datetime(2024, 1, 15, 12))
    assert out.columns == ["idEmpresa", "v", "DataHoraAtualizacao", "idEmp"]
    assert tuple(out.first()) == ("T1", 1, "15/01/2024 09:00:00", "T1")
    assert refresh_text_at(datetime(2018, 12, 1, 12)) == "01/12/2018 10:00:00"


@pytest.mark.parametrize(
    "value, kind, expected",
    [
        ("2024-01-05", "string", ("2024-01-05", "2024", "01")),
        ("05/01/2024", "string", ("05/01/2024", "05/0", "/2")),
        ("2024", "string", ("2024", "2024", "")),
        (None, "string", (None, None, None)),
        (date(2024, 3, 9), "date", ("2024-03-09", "2024", "03")),
        (datetime(2024, 3, 9, 1), "timestamp_ntz", ("2024-03-09 01:00:00", "2024", "03")),
        (20240309, "int", ("20240309", "2024", "30")),
    ],
)
def test_positional_keys(spark, value, kind, expected):
    out = with_partition_keys(column(spark, [value], kind), "c").first()
    assert (out.c, out.Ano, out.Mes) == expected


def test_parsed_keys(spark):
    texts = column(spark, ["2024-01-05", "05/01/2024", None], "string")
    keys = [tuple(row)[1:] for row in with_partition_keys(texts, "c", mode="parse").collect()]
    assert keys == [("2024", "01"), (None, None), (None, None)]
    slashed = with_partition_keys(texts, "c", mode="parse", date_format="dd/MM/yyyy").collect()
    assert [tuple(row)[1:] for row in slashed] == [(None, None), ("2024", "01"), (None, None)]
    with pytest.raises(ValueError):
        with_partition_keys(texts, "c", mode="guess")
    assert with_partition_keys(texts, "absent").columns == ["c"]


@pytest.mark.parametrize(
    "value, kind, expected",
    [
        ("x 10:20:30.55", "string", "10:20:30"),
        ("abc", "string", "00:00:00"),
        ("9:05:00", "string", "00:00:00"),
        (None, "string", "00:00:00"),
        (date(2024, 1, 5), "date", "00:00:00"),
        (datetime(2024, 1, 5, 6, 7, 8), "timestamp_ntz", "06:07:08"),
        (None, "timestamp_ntz", "00:00:00"),
        (12.5, "double", 12.5),
    ],
)
def test_time_column(spark, value, kind, expected):
    source = spark.createDataFrame([(value,)], f"HoraVenda {kind}")
    assert normalize(source).first()[0] == expected


def test_no_daylight_saving_gap_shifts_a_text(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        gap = datetime(2024, 3, 10, 2, 30)
        source = spark.createDataFrame([(gap, gap)], "DataVenda timestamp_ntz, HoraVenda timestamp_ntz")
        row = with_partition_keys(normalize(source), "DataVenda").first()
        assert (row.DataVenda, row.HoraVenda) == ("2024-03-10 02:30:00", "02:30:00")
        rows = spark.createDataFrame([("T", gap)], "tenant string, refreshed_at timestamp_ntz")
        assert refresh_rows(rows).first().DataHoraAtualizacao == "09/03/2024 23:30:00"
        hour = spark.sql("SELECT INTERVAL '02:30:00' HOUR TO SECOND AS HoraVenda")
        assert normalize(hour).first()[0] == "02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_time_column_kept_as_timestamp_on_request(spark):
    source = spark.createDataFrame([(datetime(2024, 1, 5, 6),)], "HoraVenda timestamp_ntz")
    assert normalize(source, timestamps_too=False).dtypes == [("HoraVenda", "timestamp_ntz")]


def test_time_of_day_of_sql_time(spark):
    assert normalize(spark.sql("SELECT TIME'10:20:30.5' AS HoraVenda")).first()[0] == "10:20:30"


@pytest.mark.parametrize(
    "interval, expected",
    [
        ("INTERVAL '1 01:02:03' DAY TO SECOND", "01:02:03"),
        ("INTERVAL '25:02:03' HOUR TO SECOND", "01:02:03"),
        ("INTERVAL '0 10:20:30.5' DAY TO SECOND", "10:20:30.500000"),
        ("INTERVAL '-1' HOUR", "+23:00:00"),
        ("INTERVAL '-1' DAY", "+00:00:00"),
        ("CAST(NULL AS INTERVAL DAY TO SECOND)", "00:00:00"),
    ],
)
def test_time_of_day_of_durations(spark, interval, expected):
    out = spark.sql(f"SELECT {interval} AS i").select(time_of_day_from_interval(F.col("i")))
    assert out.first()[0] == expected
    assert normalize(spark.sql(f"SELECT {interval} AS HoraVenda")).first()[0] == expected


@pytest.mark.parametrize(
    "value, expected",
    [
        (0.1, "0.1"), (-0.0, "-0.0"), (100.0, "100.0"), (12345678.5, "12345678.5"), (1e15, "1000000000000000.0"),
        (1e16, "1e16"), (1.5e-7, "1.5e-7"), (1e-5, "0.00001"), (1e300, "1e300"), (math.inf, "inf"),
        (-math.inf, "-inf"), (None, None),
    ],
)
def test_double_to_text(spark, value, expected):
    assert column(spark, [value], "double").select(double_to_text(F.col("c"))).first()[0] == expected


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=True, allow_infinity=True) | st.none(), min_size=1, max_size=30))
def test_text_of_doubles_reads_back(spark, values):
    frame = column(spark, values, "double").filter("not isnan(c) or c is null")
    back = frame.select("c", double_to_text(F.col("c")).cast("double").alias("d"))
    assert back.filter("not (c <=> d)").count() == 0


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.tuples(
            st.floats(allow_nan=False) | st.none() | st.integers(-5, 5).map(float),
            st.sampled_from(["1", "2", "x", "1.5", None]),
        ),
        min_size=1, max_size=20,
    )
)
def test_conform_is_idempotent(spark, rows):
    contract = Contract({"b": "int64", "a": "string", "new": "float64"})
    source = normalize(spark.createDataFrame(rows, "a double, b string"))
    once = conform_dataset(source, contract)
    twice = conform_dataset(once, contract)
    assert once.dtypes == twice.dtypes
    assert once.collect() == twice.collect()


def test_bundled_contracts():
    contracts = bundled_contracts()
    assert {name: len(contract.columns) for name, contract in contracts.items()} == {
        "Atualizacao": 3, "Clientes": 19, "CodigoBarras": 5, "Compras": 23, "Estoque": 11, "Fornecedores": 7,
        "Funcionarios": 9, "Produtos": 19, "Vendas": 34,
    }
    kinds = [kind for contract in contracts.values() for kind in contract.columns.values()]
    assert {kind: kinds.count(kind) for kind in set(kinds)} == {"string": 111, "int64": 3, "float64": 16}
    assert contracts["Vendas"].schema().fieldNames()[-2:] == ["Ano", "Mes"]
    assert set(BUNDLED) == set(contracts)


def test_contracts_from_json(spark, tmp_path):
    file = tmp_path / "types.json"
    file.write_text('{"X": {"b": "int64", "a": "string"}, "Y": {}}', encoding="utf-8")
    contracts = load_contracts(spark, str(file))
    assert list(contracts["X"].columns.items()) == [("b", "int64"), ("a", "string")]
    assert not contracts["Y"] and contracts["X"].type_of("c") is None


def test_conform_takes_every_numeric_type(spark):
    source = spark.sql("SELECT 1 AS i, 2.50BD AS d, CAST(1.5 AS FLOAT) AS f, CAST('12' AS DECIMAL(20,0)) AS k")
    kinds = {"i": "int64", "d": "float64", "f": "string", "k": "int64"}
    out = conform_dataset(source, Contract(kinds))
    assert out.dtypes == [("i", "bigint"), ("d", "double"), ("f", "string"), ("k", "bigint")]
    assert tuple(out.first()) == (1, 2.5, "1.5", 12)
    wide = conform_dataset(spark.sql("SELECT CAST('99999999999999999999' AS DECIMAL(20,0)) AS k"), Contract({"k": "int64"}))
    assert wide.dtypes == [("k", "decimal(20,0)")]
