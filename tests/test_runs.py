"""Dataset builds and full runs, failures included."""

from __future__ import annotations

import json
import time
from datetime import datetime
from decimal import Decimal
from pathlib import Path

import pytest

from shelfmark.contracts import Contract, bundled_contracts
from shelfmark.plans import (
    DatasetSpec,
    build_dataset,
    extract,
    gate_status,
    publish_gate,
    run,
    run_from_documents,
    run_summary,
    union_parts,
    with_retry,
    written,
)
from shelfmark.operators import partition_inventory
from shelfmark.plans import conform_dataset, prepare, runner
from shelfmark.plans.dataset import MONTH_GROUPS, discard, fills_cores, is_connection_error
from shelfmark.plans.report import REPORT_SCHEMA
from shelfmark.session import scratch_path
from shelfmark.showcase.queries import QUERIES
from shelfmark.showcase.sources import SPECS, load_tables
from shelfmark.sources import CatalogSource, read_dataset
from shelfmark.storage import glob_paths, path_exists

AS_OF = datetime(2024, 1, 15, 12)


def statuses(report):
    return {row.dataset: row.status for row in report.collect()}


@pytest.fixture
def tables(spark, sf_dir):
    return load_tables(spark, sf_dir)


@pytest.fixture
def small(spark):
    rows = [("2024-01-05", 1.0, "a"), ("2024-02-05", 2.5, "b"), (None, None, None)]
    spark.createDataFrame(rows, "DataVenda string, Quantidade double, Extra string").createOrReplaceTempView("small")
    return "SELECT * FROM small"


def staged_folders(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    return {path for path in glob_paths(spark, f"{base}/shelfmark/*") if "/stage-" in path}


@pytest.fixture(autouse=True)
def nothing_staged_is_left(spark):
    before = staged_folders(spark)
    yield
    assert staged_folders(spark) <= before


def test_eight_datasets_open_the_gate(spark, tables):
    roots = [scratch_path(spark, "a"), scratch_path(spark, "b")]
    report = run(spark, SPECS, "0012", roots, as_of=AS_OF, workers=3)
    assert set(statuses(report).values()) == {"written"} and report.count() == 9
    for root in roots:
        refresh = read_dataset(spark, f"{root}/Atualizacao").collect()
        assert [tuple(row) for row in refresh] == [("15/01/2024 09:00:00", "0012", "0012")]
        sales = read_dataset(spark, f"{root}/Vendas")
        assert sales.count() == tables["lineitem"].count()
        assert sales.select("idEmpresa").distinct().first()[0] == "0012"
    assert written(report).count() == 9
    assert spark.conf.get("spark.sql.caseSensitive") == "false"


def test_a_second_run_replaces_the_first(spark, tables):
    root = scratch_path(spark, "again")
    specs = [spec for spec in SPECS if spec.dataset in ("Vendas", "Fornecedores")]
    for _ in range(2):
        run(spark, specs, "T1", [root], as_of=AS_OF)
    run(spark, specs, "T2", [root], as_of=AS_OF)
    assert read_dataset(spark, f"{root}/Vendas").count() == 2 * tables["lineitem"].count()
    assert read_dataset(spark, f"{root}/Fornecedores").count() == 2 * tables["supplier"].count()
    assert not path_exists(spark, f"{root}/Atualizacao")


def test_one_failed_extraction_closes_the_gate(spark, tables):
    broken = DatasetSpec("Quebrada", "SELECT nope FROM orders")
    root = scratch_path(spark, "broken")
    report = run(spark, [broken, *SPECS], "T1", [root], as_of=AS_OF)
    found = statuses(report)
    assert found.pop("Quebrada") == "failed" and found.pop("Atualizacao") == "skipped"
    assert set(found.values()) == {"written"}
    error = report.filter("dataset = 'Quebrada'").first()
    assert "nope" in error.error and error.delivered is None
    assert tuple(run_summary(report).first()) == (8, 1, 0, 0)

    published = run(spark, [broken, *SPECS], "T1", [root], as_of=AS_OF, gate="delivered")
    assert statuses(published)["Atualizacao"] == "written"


def test_seven_datasets_do_not_open_the_gate(spark, tables):
    report = run(spark, SPECS[:7], "T1", [scratch_path(spark, "seven")], as_of=AS_OF)
    assert statuses(report)["Atualizacao"] == "skipped"
    assert run_summary(report).first().succeeded == 7
    lower = run(spark, SPECS[5:7], "T1", [scratch_path(spark, "two")], as_of=AS_OF, min_datasets=2)
    assert statuses(lower)["Atualizacao"] == "written"


def test_failure_at_one_of_two_roots_fails_the_dataset(spark, small, tmp_path):
    blocked = tmp_path / "file"
    blocked.write_text("")
    good = scratch_path(spark, "good")
    report = run(spark, [DatasetSpec("Vendas", small)], "T1", [str(blocked), good], as_of=AS_OF, min_datasets=1)
    row = report.filter("dataset = 'Vendas'").first()
    assert (row.status, row.delivered, row.rows) == ("failed", False, 3) and str(blocked) in row.error
    assert read_dataset(spark, f"{good}/Vendas").count() == 3
    assert statuses(report)["Atualizacao"] == "skipped"


@pytest.mark.parametrize("roots", [1, 2])
@pytest.mark.parametrize("name", ["Vendas", "Plain"])
def test_empty_result_is_skipped(spark, small, roots, name):
    paths = [scratch_path(spark, "empty") for _ in range(roots)]
    run(spark, [DatasetSpec(name, small)], "T1", paths, as_of=AS_OF)
    report = run(spark, [DatasetSpec(name, f"{small} WHERE 1 = 0")], "T1", paths, as_of=AS_OF)
    row = report.first()
    assert (row.status, row.rows, row.delivered, row.error) == ("empty", 0, None, None)
    for path in paths:
        assert read_dataset(spark, f"{path}/{name}").count() == 3


def test_dataset_without_open_checks_is_counted_by_its_write(spark, small):
    contract = {"Plain": Contract({"DataVenda": "string"})}
    root = scratch_path(spark, "direct")
    query = f"SELECT DataVenda FROM ({small})"
    built = build_dataset(spark, [DatasetSpec("Plain", query)], CatalogSource(), contract["Plain"], "T1", staging="auto")
    assert built.rows is None
    report = run(spark, [DatasetSpec("Plain", query)], "T1", [root], contract, as_of=AS_OF, staging="auto")
    assert (report.first().status, report.first().rows) == ("written", 3)


@pytest.mark.parametrize("staging", ["auto", "always"])
def test_staging_does_not_change_the_result(spark, small, staging):
    spec = DatasetSpec("Vendas", small)
    contract = bundled_contracts()["Vendas"]
    built = build_dataset(spark, [spec], CatalogSource(), contract, "T1", AS_OF, staging=staging)
    assert built.rows == (3 if staging == "always" else None) and built.cols == ["idEmpresa", "Ano", "Mes"]
    assert dict(built.frame.dtypes)["Quantidade"] == "double"
    columns = built.frame.columns
    assert columns[:6] == ["DataVenda", "Quantidade", "Extra", "DataHoraAtualizacao", "idEmpresa", "idEmp"]
    assert columns[6:9] == ["Ano", "Mes", "CodigoLoja"] and len(columns) == 35
    assert {(row.Ano, row.Mes) for row in built.frame.collect()} == {("2024", "01"), ("2024", "02"), (None, None)}
    discard(spark, built.staged)


def test_a_random_query_is_staged(spark):
    query = "SELECT IF(rand() < 0.5, 1.0D, 1.5D) AS c FROM range(30)"
    contract = Contract({"other": "string"})
    built = build_dataset(spark, [DatasetSpec("X", query)], CatalogSource(), contract, "T1", staging="auto")
    assert len(built.staged) == 1 and built.rows == 30
    assert built.frame.select("c").collect() == built.frame.select("c").collect()
    discard(spark, built.staged)
    plain = build_dataset(spark, [DatasetSpec("X", "SELECT 1.5D AS c")], CatalogSource(), contract, "T1", staging="auto")
    assert plain.staged == []


def test_a_table_that_changes_between_passes_fails_the_dataset(spark, monkeypatch):
    """The profile is told the doubles are whole; the write finds a fraction."""
    from shelfmark.operators import Profile

    monkeypatch.setattr("shelfmark.plans.dataset.profile", lambda df, contract: Profile(1, {"c": True}))
    contract = {"X": Contract({"other": "string"})}
    root = scratch_path(spark, "changing")
    spec = DatasetSpec("X", "SELECT id + 0.5D AS c FROM range(3)")
    row = run(spark, [spec], "T1", [root], contract, staging="auto").first()
    assert row.status == "failed" and not path_exists(spark, f"{root}/X/idEmpresa=T1")


def test_names_that_clash_by_case_are_refused_unless_the_session_tells_them_apart(spark):
    spark.createDataFrame([("2024-01-05",)], "datavenda string").createOrReplaceTempView("lower")
    spec = DatasetSpec("Vendas", "SELECT DATAVENDA AS datavenda FROM lower")
    report = run(spark, [spec], "T1", [scratch_path(spark, "case")], as_of=AS_OF)
    assert "differ only by case" in report.first().error
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        root = scratch_path(spark, "case")
        exact = DatasetSpec("Vendas", "SELECT datavenda FROM lower")
        assert run(spark, [exact], "T1", [root], as_of=AS_OF).first().status == "written"
        back = read_dataset(spark, f"{root}/Vendas").first()
        assert (back["datavenda"], back["DataVenda"]) == ("2024-01-05", "")
    finally:
        spark.conf.set("spark.sql.caseSensitive", "false")


def test_a_query_without_a_name_fails_alone(spark, small):
    root = scratch_path(spark, "nameless")
    report = run(spark, [DatasetSpec(" ", small), DatasetSpec("Vendas", small)], "T1", [root], as_of=AS_OF)
    assert statuses(report) == {"": "failed", "Vendas": "written", "Atualizacao": "skipped"}


def test_extract_keeps_going_past_a_bad_query(spark, small):
    frames, errors = extract(spark, [DatasetSpec("a", "SELECT nope FROM small"), DatasetSpec("b c", small)])
    assert list(frames) == ["bc"] and frames["bc"][0].count() == 3
    assert list(errors) == ["a"] and "nope" in errors["a"]


EVERY_TYPE = """
    SELECT TIME'10:20:30.5' AS t, INTERVAL '1 02:03:04' DAY TO SECOND AS i, INTERVAL '2' MONTH AS m, X'0a' AS b,
           NULL AS v, array(1, 2) AS a, map('k', 1) AS mp, named_struct('z', 1.5D) AS st,
           CAST('x' AS CHAR(3)) AS ch, CAST('y' AS VARCHAR(4)) AS vc, TIMESTAMP'2024-01-05 10:00:00' AS ts,
           DATE'2024-01-05' AS d, CAST(1.5 AS FLOAT) AS f, CAST(3 AS TINYINT) AS ti,
           CAST(2.50 AS DECIMAL(5, 2)) AS de, true AS bo
"""


@pytest.mark.parametrize("staging", ["auto", "always"])
def test_every_source_type_can_be_delivered(spark, staging):
    root = scratch_path(spark, "types")
    contract = {"X": Contract({"t": "string", "ch": "int64", "bo": "string"})}
    report = run(spark, [DatasetSpec("X", EVERY_TYPE)], "T1", [root], contract, staging=staging)
    assert report.first().status == "written" and report.first().notes == "ch: 1 values are no int64"
    back = read_dataset(spark, f"{root}/X")
    kinds = {name: kind for name, kind in back.dtypes if name not in ("idEmp", "idEmpresa", "DataHoraAtualizacao")}
    assert kinds == {
        "t": "string", "i": "interval day to second", "m": "interval month", "b": "binary", "v": "string",
        "a": "array<int>", "mp": "map<string,int>", "st": "struct<z:double>", "ch": "string", "vc": "string",
        "ts": "timestamp", "d": "date", "f": "double", "ti": "bigint", "de": "double", "bo": "string",
    }
    row = back.select("t", "v", "f", "de", "bo").first()
    assert (row.t, row.v, row.f, row.de, row.bo) == ("10:20:30.5", None, 1.5, 2.5, "true")


def test_same_named_queries_add_up(spark, small):
    root = scratch_path(spark, "sum")
    run(spark, [DatasetSpec("Ven das", small), DatasetSpec("Vendas", small)], "T1", [root], as_of=AS_OF)
    assert read_dataset(spark, f"{root}/Vendas").count() == 6


def test_same_named_queries_must_agree_on_the_date(spark, small):
    specs = [DatasetSpec("Vendas", small), DatasetSpec("Vendas", "SELECT 1 AS CodigoLoja")]
    report = run(spark, specs, "T1", [scratch_path(spark, "x")], as_of=AS_OF)
    assert "disagree on the date column" in report.first().error


def test_union_of_parts_widens_types(spark):
    parts = [
        spark.createDataFrame([(1, 5, "x")], "a bigint, b bigint, c string"),
        spark.createDataFrame([(1.5, "y", 12345678.5)], "a double, b string, c double"),
        spark.createDataFrame([(2, 9)], "a bigint, d int"),
    ]
    out = union_parts(parts)
    assert out.dtypes == [("a", "double"), ("b", "string"), ("c", "string"), ("d", "int")]
    assert sorted((tuple(row) for row in out.collect()), key=str) == [
        (1.0, "5", "x", None), (1.5, "y", "12345678.5", None), (2.0, None, None, 9),
    ]


def test_undated_sales_over_months_are_refused(spark, small):
    root = scratch_path(spark, "history")
    run(spark, [DatasetSpec("Vendas", small)], "T1", [root], as_of=AS_OF)
    undated = DatasetSpec("Vendas", "SELECT Quantidade FROM small")
    refused = run(spark, [undated], "T1", [root], as_of=AS_OF)
    assert refused.first().status == "failed" and "LayoutChange" in refused.first().error
    assert read_dataset(spark, f"{root}/Vendas").filter("Ano = '2024'").count() == 2
    replaced = run(spark, [undated], "T1", [root], as_of=AS_OF, on_layout_change="replace")
    assert replaced.first().status == "written"
    back = read_dataset(spark, f"{root}/Vendas")
    assert back.count() == 3 and {row.Ano for row in back.select("Ano").collect()} == {""}


def test_an_empty_reload_in_another_layout_is_empty(spark, small):
    root = scratch_path(spark, "empty-layout")
    run(spark, [DatasetSpec("Vendas", small)], "T1", [root], as_of=AS_OF)
    for staging in ("auto", "always"):
        undated = DatasetSpec("Vendas", "SELECT Quantidade FROM small WHERE 1 = 0")
        row = run(spark, [undated], "T1", [root], as_of=AS_OF, staging=staging).first()
        assert (row.status, row.rows, row.error) == ("empty", 0, None)
    assert read_dataset(spark, f"{root}/Vendas").count() == 3


@pytest.mark.parametrize("name", ["gl[ob]", "a{b}", "a*", "q?", "b\\c"])
def test_layout_change_is_seen_below_any_root(spark, small, name):
    root = f"{scratch_path(spark, 'odd')}/{name}"
    run(spark, [DatasetSpec("Vendas", small)], "T1", [root], as_of=AS_OF)
    refused = run(spark, [DatasetSpec("Vendas", "SELECT Quantidade FROM small")], "T1", [root], as_of=AS_OF).first()
    assert refused.status == "failed" and "LayoutChange" in refused.error
    assert read_dataset(spark, f"{root}/Vendas").count() == 3
    assert partition_inventory(spark, f"{root}/Vendas").count() == 3


def month(number, value):
    return DatasetSpec("Vendas", f"SELECT '2024-0{number}-05' AS DataVenda, {value} AS Extra")


def test_a_delivered_double_stays_double(spark):
    root = scratch_path(spark, "types")
    for number, value in ((1, "1.5D"), (2, "2.0D")):
        assert run(spark, [month(number, value)], "T1", [root], as_of=AS_OF).first().status == "written"
    back = read_dataset(spark, f"{root}/Vendas")
    assert dict(back.dtypes)["Extra"] == "double" and {row.Extra for row in back.collect()} == {1.5, 2.0}


@pytest.mark.parametrize("column, first, second", [("Extra", "1.0D", "1.5D"), ("Extra", "1", "'x'")])
def test_another_type_than_delivered_is_an_error(spark, column, first, second):
    root = scratch_path(spark, "types")
    run(spark, [month(1, first)], "T1", [root], as_of=AS_OF)
    for staging in ("auto", "always"):
        row = run(spark, [month(2, second)], "T1", [root], as_of=AS_OF, staging=staging).first()
        assert row.status == "failed" and "TypeChange" in row.error and column in row.error
    assert read_dataset(spark, f"{root}/Vendas").count() == 1
    assert run(spark, [month(2, second)], "T1", [root], as_of=AS_OF, on_type_change="allow").first().status == "written"


def test_a_declared_column_that_stops_casting_is_an_error(spark):
    root = scratch_path(spark, "purchase")
    specs = [DatasetSpec("Compras", f"SELECT '2024-0{n}-05' AS DataEmissaoNF, '{kind}' AS TipoCompra")
             for n, kind in ((1, "1"), (2, "x"))]
    found = [run(spark, [spec], "T1", [root], as_of=AS_OF).first() for spec in specs]
    assert [row.status for row in found] == ["written", "failed"] and "TipoCompra" in found[1].error


def test_union_of_parts_does_not_round_integers(spark):
    whole = [9007199254740993, 9223372036854775807, -9223372036854775808, 0, None]
    parts = [spark.createDataFrame([(n, 1) for n in whole], "n bigint, m bigint"), spark.sql("SELECT 1.5D AS n, 2L AS m UNION ALL SELECT 0.1D, 3L")]
    both = union_parts(parts)
    assert dict(both.dtypes)["n"] == "decimal(38,19)" and dict(both.dtypes)["m"] == "bigint"
    assert {row.n for row in both.collect()} == {*map(Decimal, whole[:4]), None, Decimal("1.5"), Decimal("0.1")}
    mixed = [*parts, spark.sql("SELECT 'x' AS n, 1L AS m")]  # text beside them: text takes all
    assert {"9007199254740993", "1.5", "x"} <= {row.n for row in union_parts(mixed).collect()}
    with pytest.raises(Exception, match="NUMERIC_VALUE_OUT_OF_RANGE"):
        union_parts([parts[0], spark.sql("SELECT 1e30D AS n, 1L AS m")]).collect()
    exact = [spark.sql("SELECT 9007199254740992 AS n"), spark.sql("SELECT 1.5D AS n")]
    assert sorted(row.n for row in union_parts(exact).collect()) == [1.5, 9007199254740992.0]


def test_keys_of_unsigned_columns_stay_exact(spark):
    query = "SELECT CAST('9007199254740993' AS DECIMAL(20,0)) AS k, CAST('9007199254740993' AS DECIMAL(20,0)) AS n, " \
            "CAST('18446744073709551615' AS DECIMAL(20,0)) AS big"
    contract = Contract({"k": "string", "n": "int64", "big": "string"})
    built = build_dataset(spark, [DatasetSpec("X", query)], CatalogSource(), contract, "T1", AS_OF)
    row = built.frame.first()
    assert (row.k, row.n, row.big) == ("9007199254740993", 9007199254740993, "18446744073709551615")
    discard(spark, built.staged)


def test_a_failure_while_the_query_runs_is_retried(spark):
    """The query opens; its first execution loses the connection."""

    class Flaky:
        opened = 0

        def read(self, session, query, split=None):
            self.opened += 1
            bad = "raise_error('java.net.SocketException: reset')" if self.opened == 1 else "'x'"
            return session.sql(f"SELECT IF(id >= 0, {bad}, 'y') AS c FROM range(3)")

    source = Flaky()
    built = build_dataset(spark, [DatasetSpec("X", "q")], source, Contract({"c": "string"}), "T1", delay=0)
    assert source.opened == 2 and built.rows == 3
    discard(spark, built.staged)


def test_notes_name_columns_left_alone(spark):
    spec = DatasetSpec("X", "SELECT 'abc' AS n, 1 AS id")
    report = run(spark, [spec], "T1", [scratch_path(spark, "x")], {"X": Contract({"n": "int64"})})
    assert report.first().notes == "n: 1 values are no int64"


def test_retry_only_on_connection_errors():
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise RuntimeError("caused by: java.sql.SQLTransientConnectionException: gone")
        return "ok"

    assert with_retry(flaky, attempts=5, delay=0) == "ok" and len(calls) == 3

    def never():
        calls.append(1)
        raise ConnectionRefusedError("no")

    calls.clear()
    with pytest.raises(ConnectionRefusedError):
        with_retry(never, attempts=5, delay=0)
    assert len(calls) == 5

    def wrong():
        calls.append(1)
        raise ValueError("bad query")

    calls.clear()
    with pytest.raises(ValueError):
        with_retry(wrong, attempts=5, delay=0)
    assert len(calls) == 1


def test_run_retries_a_flaky_source(spark, small):
    class Flaky:
        failures = 2

        def read(self, session, query, split=None):
            if self.failures:
                self.failures -= 1
                raise ConnectionResetError("lost")
            return session.sql(query)

    root = scratch_path(spark, "flaky")
    report = run(spark, [DatasetSpec("Vendas", small)], "T1", [root], source=Flaky(), delay=0)
    assert report.first().status == "written"
    assert not is_connection_error(ValueError("x"))


def test_gate(spark):
    def publish(rows, k=2, gate="configured"):
        report = spark.createDataFrame(rows, REPORT_SCHEMA)
        return publish_gate(gate_status(report, gate), k).first().publish

    ok = ("a", "written", 1, True, None, None, 0.0), ("b", "written", 1, True, None, None, 0.0)
    empty = ("c", "empty", 0, None, None, None, 0.0)
    broken = ("d", "failed", None, None, "x", None, 0.0)
    undelivered = ("e", "failed", 1, False, "x", None, 0.0)
    assert publish([*ok]) and publish([*ok, empty])
    assert not publish([*ok], 3) and not publish([*ok, broken]) and not publish([*ok, undelivered])
    assert publish([*ok, broken], gate="delivered") and not publish([*ok, undelivered], gate="delivered")
    assert not publish([], 0)
    with pytest.raises(ValueError):
        publish([*ok], gate="other")


def test_nothing_configured_is_an_error(spark):
    with pytest.raises(ValueError, match="no queries"):
        run(spark, [], "T1", ["x"])
    with pytest.raises(ValueError, match="roots"):
        run(spark, [DatasetSpec("a", "select 1")], "T1", [])


def test_run_from_documents(spark, small, tmp_path, monkeypatch):
    tenant = {
        "_id": "T1", "TipoDestino": "s3", "portal": "shop",
        "parametrizacaoIntegracao": {
            "workers": 2,
            "consultas": [{"name": "Ven das", "query": small}, {"name": "Extra", "query": "SELECT 1 AS a"}],
        },
    }
    (tmp_path / "t.json").write_text(json.dumps([tenant]))
    (tmp_path / "c.json").write_text(json.dumps([{"destino": {"s3": {"bucket": "s3://bucket"}}}]))
    local = scratch_path(spark, "bucket")
    monkeypatch.setattr("shelfmark.sources.clouds._s3", lambda found, portal: _local(local, portal))
    report = run_from_documents(
        spark, "T1", str(tmp_path / "t.json"), str(tmp_path / "c.json"), source=CatalogSource(), as_of=AS_OF
    )
    assert statuses(report) == {"Vendas": "written", "Extra": "written", "Atualizacao": "skipped"}
    assert read_dataset(spark, f"{local}/shop/Vendas").count() == 3
    only = run_from_documents(
        spark, "T1", str(tmp_path / "t.json"), str(tmp_path / "c.json"), "Extra", CatalogSource(), as_of=AS_OF
    )
    assert set(statuses(only)) == {"Extra", "Atualizacao"}


def _local(root, portal):
    from shelfmark.sources import Destination

    return Destination("s3", f"{root}/{portal}")


def test_library_has_no_python_udfs_or_rdds():
    package = Path(__file__).resolve().parents[1] / "shelfmark"
    text = "\n".join(file.read_text() for file in package.rglob("*.py"))
    for word in ("pandas_udf", "F.udf", ".rdd", "localCheckpoint", "crossJoin", "toPandas"):
        assert word not in text


@pytest.fixture
def all_large(spark):
    """Any file fills all cores."""
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.openCostInBytes")


def shuffle_files(spark):
    dirs = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {file for folder in dirs for file in Path(folder).rglob("shuffle_*")}


def test_shuffle_files_go_with_their_query(spark, tables):
    before = shuffle_files(spark)
    report = run(spark, SPECS, "0012", [scratch_path(spark, "shuffled")], as_of=AS_OF)
    until = time.monotonic() + 10
    while shuffle_files(spark) - before and time.monotonic() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert set(statuses(report).values()) == {"written"}
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


@pytest.mark.parametrize("filled, most", [("1b", 1), ("1g", 2)])
def test_datasets_that_fill_all_cores_take_turns(spark, tables, monkeypatch, filled, most):
    at_work, seen = set(), []

    def deliver(prepared, paths, *rest):
        at_work.add(paths[0])
        seen.append(len(at_work))
        time.sleep(3)
        at_work.discard(paths[0])
        return inner(prepared, paths, *rest)

    inner = runner._deliver
    monkeypatch.setattr(runner, "_deliver", deliver)
    specs = [DatasetSpec(name, "SELECT p_partkey AS CodigoProduto FROM part") for name in ("Produtos", "Outros")]
    spark.conf.set("spark.sql.files.openCostInBytes", filled)
    try:
        report = run(spark, specs, "0012", [scratch_path(spark, "turns")], workers=2, min_datasets=3, as_of=AS_OF)
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert statuses(report) == {"Produtos": "written", "Outros": "written", "Atualizacao": "skipped"}
    assert max(seen) == most


def test_rows_made_in_the_driver_fill_no_cores(spark, small, all_large):
    assert not fills_cores(spark.sql(small))


def test_a_failed_dataset_gives_its_turn_back(spark, tables, all_large):
    specs = [
        DatasetSpec("Produtos", "SELECT CAST(concat('x', p_partkey) AS BIGINT) AS CodigoProduto FROM part"),
        DatasetSpec("Clientes", "SELECT c_custkey AS CodigoCliente FROM customer"),
    ]
    report = run(spark, specs, "0012", [scratch_path(spark, "failed-turn")], workers=1, as_of=AS_OF)
    assert statuses(report) == {"Produtos": "failed", "Clientes": "written", "Atualizacao": "skipped"}


def test_a_large_dataset_lands_a_group_of_months_at_a_time(spark, all_large, tmp_path):
    rows = [(i % 9 + 1995, i % 13, i) for i in range(3000)]
    made = spark.createDataFrame(rows, "year int, month int, id bigint").selectExpr(
        "CASE WHEN month > 0 THEN make_date(year, month, 1) END AS DataVenda",
        "CAST(id % 50 AS DOUBLE) AS Peso", "id / 7D AS VlrBruto", "CASE WHEN id % 5 > 0 THEN id END AS Extra",
    )
    made.union(made.limit(100)).write.parquet(f"{tmp_path}/sales")
    spark.read.parquet(f"{tmp_path}/sales").createOrReplaceTempView("months")
    spec = DatasetSpec("Vendas", "SELECT * FROM months")
    turns = []
    prepared = build_dataset(
        spark, [spec], CatalogSource(), bundled_contracts()["Vendas"], "0012", AS_OF, take_turn=lambda: turns.append(1)
    )
    try:
        assert turns and prepared.rows == 3100
        landed = spark.read.parquet(prepared.parts[0].path).selectExpr(
            "_metadata.file_path AS file", f"pmod(hash(Ano, Mes), {MONTH_GROUPS}) AS months"
        )
        per_file = landed.groupBy("file").agg({"months": "min"}).join(landed.groupBy("file").agg({"months": "max"}), "file")
        assert all(row[1] == row[2] for row in per_file.collect())
        assert landed.select("months").distinct().count() == MONTH_GROUPS
        # All rows once, as the query has them.
        plain = conform_dataset(prepare(spark.sql(spec.query), spec, "0012", AS_OF, bundled_contracts()["Vendas"]), bundled_contracts()["Vendas"])
        assert dict(prepared.frame.dtypes) == dict(plain.dtypes) and dict(plain.dtypes)["Peso"] == "bigint"
        same = plain.select(prepared.frame.columns)
        assert prepared.frame.exceptAll(same).isEmpty() and same.exceptAll(prepared.frame).isEmpty()
        # What landed as it came is gone already.
        assert [path for path in prepared.staged if path_exists(spark, path)] == [prepared.parts[0].path]
    finally:
        discard(spark, prepared.staged)


def test_a_large_dataset_without_rows_is_empty(spark, tables, all_large):
    text = "SELECT o_orderdate AS DataVenda FROM orders WHERE o_totalprice < 0"
    report = run(spark, [DatasetSpec("Vendas", text)], "0012", [scratch_path(spark, "nothing")], as_of=AS_OF)
    assert statuses(report)["Vendas"] == "empty"


def test_a_large_run_equals_a_small_one(spark, tables):
    roots = {}
    for filled in ("1b", "1g"):
        roots[filled] = scratch_path(spark, "sized")
        spark.conf.set("spark.sql.files.openCostInBytes", filled)
        try:
            run(spark, SPECS, "0012", [roots[filled]], as_of=AS_OF)
        finally:
            spark.conf.unset("spark.sql.files.openCostInBytes")
    for spec in SPECS:
        large, small_run = (read_dataset(spark, f"{root}/{spec.dataset}") for root in roots.values())
        assert large.schema == small_run.schema
        assert large.exceptAll(small_run).isEmpty() and small_run.exceptAll(large).isEmpty()


@pytest.mark.parametrize("name", ["run_report", "run_totals", "publish_gate_modes", "full_run"])
def test_a_registered_run_leaves_nothing_delivered_behind(spark, sf_dir, name):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(glob_paths(spark, f"{base}/shelfmark/*"))
    assert QUERIES[name](spark, sf_dir).count() > 0
    assert set(glob_paths(spark, f"{base}/shelfmark/*")) <= before
