"""ANSI SQL with the result each registered query must give."""

from __future__ import annotations

from .expected import EXPECTED, EXPECTED_TYPES
from .queries import SCAN_SQL
from .sources import DATASET_SQL

REFRESHED = "15/01/2024 09:00:00"
TENANT_ID = "T0001"

_CLOCK = r"(\d{2}:\d{2}:\d{2})"


def _dataset(name: str) -> str:
    return f"SELECT {EXPECTED[name]} FROM ({DATASET_SQL[name]}) AS source"


def _count(name: str) -> str:
    return f"SELECT '{name}' AS dataset, count(*) AS rows FROM ({DATASET_SQL[name]}) AS source"


def _contract_columns() -> str:
    parts = []
    for name, types in EXPECTED_TYPES.items():
        values = ", ".join(f"('{pair.split()[0]}', '{pair.split()[1]}')" for pair in types.split(","))
        parts.append(
            f'SELECT n.dataset, c."column", c."type", n.rows '
            f'FROM (VALUES {values}) AS c("column", "type") CROSS JOIN ({_count(name)}) AS n'
        )
    return " UNION ALL ".join(parts)


_COUNTS = " UNION ALL ".join(_count(name) for name in DATASET_SQL)

_DOCUMENTS = """
    SELECT CAST(c_custkey AS VARCHAR) AS tenant, c_mktsegment || ' ' || s.suffix AS name,
           c_mktsegment || s.flat AS dataset, 'SELECT ' || c_custkey AS query
    FROM customer, (VALUES ('A', 'A'), ('B 1', 'B1')) AS s(suffix, flat)
"""

_MONTHLY = """
    SELECT o_orderkey, o_totalprice, o_orderstatus AS idEmpresa,
           strftime(o_orderdate, '%Y') AS Ano, strftime(o_orderdate, '%m') AS Mes
    FROM orders
"""
_PATH = "'idEmpresa=' || idEmpresa || '/Ano=' || Ano || '/Mes=' || Mes"
_INVENTORY = f"SELECT DISTINCT {_PATH} AS path, idEmpresa, Ano, Mes FROM ({_MONTHLY}) AS m"
_PLAN_CTE = f"""
    monthly AS ({_MONTHLY}),
    old AS (SELECT DISTINCT idEmpresa, {_PATH} AS path FROM monthly),
    reload AS (
        SELECT idEmpresa, Ano, Mes FROM monthly WHERE idEmpresa = 'F' AND Ano = '1996' OR idEmpresa = 'O'
        UNION ALL
        SELECT idEmpresa, '2030', Mes FROM monthly WHERE idEmpresa = 'F' AND Ano = '2000'
    ),
    new AS (SELECT DISTINCT idEmpresa, {_PATH} AS path FROM reload),
    actions AS (
        SELECT 'idEmpresa=' || coalesce(o.idEmpresa, n.idEmpresa) AS tenant, coalesce(o.path, n.path) AS path,
               CASE WHEN o.path IS NULL THEN 'add' WHEN n.path IS NULL THEN 'keep' ELSE 'replace' END AS action
        FROM old o FULL OUTER JOIN new n ON o.path = n.path
        WHERE coalesce(o.idEmpresa, n.idEmpresa) IN (SELECT idEmpresa FROM new)
    ),
    plan AS (
        SELECT tenant, path, action,
               bool_and(action <> 'keep') OVER (PARTITION BY tenant)
               AND bool_or(action = 'replace') OVER (PARTITION BY tenant) AS whole_tenant
        FROM actions
    ),
    levels AS (
        SELECT 'Mes' AS level, path FROM plan WHERE action <> 'keep'
        UNION
        SELECT 'Ano', tenant FROM plan GROUP BY tenant HAVING bool_and(action = 'replace')
        UNION
        SELECT 'idEmpresa', tenant FROM plan WHERE whole_tenant
    )
"""

_GATE = """
    WITH status AS (SELECT event_type, min(value) >= 0.02 AS ok FROM events GROUP BY event_type),
    cases AS (
        SELECT 'all' AS datasets_from, count(*) AS datasets, bool_and(ok) AS ok FROM status
        UNION ALL
        SELECT 'passing', count(*), bool_and(ok) FROM status WHERE ok
    )
    SELECT datasets_from, wanted, datasets, coalesce(ok, false) AND datasets >= wanted AS publish
    FROM cases, (VALUES (3), (5), (8)) AS w(wanted)
"""

ORACLE: dict[str, str] = {f"dataset_{name.lower()}": _dataset(name) for name in DATASET_SQL} | {
    "scan_sql": SCAN_SQL,
    "batch_extract": _COUNTS,
    "contract_columns": _contract_columns(),
    "registry_explode": _DOCUMENTS,
    "registry_filter": f"""
        SELECT 'known' AS asked, tenant, dataset FROM ({_DOCUMENTS}) AS d WHERE name = 'BUILDING B 1'
        UNION ALL
        SELECT 'unknown', tenant, dataset FROM ({_DOCUMENTS}) AS d
    """,
    "document_faults": """
        SELECT CAST(c_custkey AS VARCHAR) AS tenant, c_custkey % 10 = 3 AS cut_off FROM customer
        WHERE c_custkey % 10 IN (3, 7)
    """,
    # Ranges begin where an eighth of the sorted keys begins; equal keys stay together.
    "quantile_ranges": """
        WITH k AS (SELECT l_orderkey AS chave FROM lineitem WHERE l_quantity < 30),
        shares AS (SELECT chave, ntile(8) OVER (ORDER BY chave) AS share FROM k),
        bounds AS (SELECT DISTINCT min(chave) AS bound FROM shares GROUP BY share),
        placed AS (SELECT chave, (SELECT max(bound) FROM bounds WHERE bound <= chave) AS bound FROM k)
        SELECT count(*) AS rows, min(chave) AS "first", max(chave) AS "last" FROM placed GROUP BY bound
    """,
    "conn_defaults": """
        SELECT CASE WHEN c_mktsegment <> 'BUILDING' THEN c_name ELSE 'db.invalid' END AS host,
               CAST(CASE WHEN c_acctbal >= 0 AND c_acctbal < 5000 THEN c_custkey ELSE 3307 END AS INTEGER) AS port,
               lower(c_mktsegment) AS "database", 'reader' AS "user", CAST(NULL AS VARCHAR) AS password
        FROM customer
    """,
    "audit_columns": f"""
        SELECT c_custkey, '{TENANT_ID}' AS idEmpresa, '{REFRESHED}' AS DataHoraAtualizacao,
               '{TENANT_ID}' AS idEmp
        FROM customer
    """,
    "partition_keys": """
        SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS o_orderdate,
               strftime(o_orderdate, '%Y') AS Ano, strftime(o_orderdate, '%m') AS Mes
        FROM orders
    """,
    "decimal_to_double": """
        SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS DOUBLE) AS price,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS gaps,
               CAST(o_orderkey + 9007199254740992 AS VARCHAR) AS wide_key
        FROM orders
    """,
    "time_of_day": f"""
        SELECT event_id,
               coalesce(nullif(regexp_extract(CAST(ts AS VARCHAR), '{_CLOCK}', 1), ''), '00:00:00') AS of_ts,
               coalesce(nullif(regexp_extract(event_type, '{_CLOCK}', 1), ''), '00:00:00') AS of_type
        FROM events
    """,
    "time_of_day_interval": """
        SELECT event_id, replace(strftime(ts, '%H:%M:%S.%f'), '.000000', '') AS since,
               '+' || replace(
                   strftime(TIMESTAMP '2024-03-01' - (ts - TIMESTAMP '2024-01-01'), '%H:%M:%S.%f'), '.000000', ''
               ) AS until
        FROM events
    """,
    "number_to_text": "SELECT o_orderkey, CAST(o_totalprice * 1000 AS VARCHAR) AS text FROM orders",
    "scalar_strings": """
        SELECT page_id, replace(url, '.', '') AS no_spaces, rtrim(url || '//', '/') AS no_slashes,
               split_part(replace(url, 'https://', ''), '/', 1) AS "first",
               regexp_replace(url, '/?[^/]*$', '') AS parent,
               CASE WHEN starts_with(url, 'https://') THEN substring(url, 9) ELSE url END AS below,
               split_part(replace(url, 'https://', ''), '/', 1) AS bucket,
               'portal/pages/' || page_id AS object
        FROM pages
    """,
    "destination_alias": """
        SELECT CASE event_type WHEN 'view' THEN 's3' WHEN 'click' THEN 's3' WHEN 'signup' THEN 's3'
                               WHEN 'error' THEN 'azure' ELSE 'ambos' END AS kind, count(*) AS events
        FROM events GROUP BY 1
    """,
    "document_lookup": r"""
        SELECT event_id, CAST(regexp_extract(props, '(\d+)', 1) AS INTEGER) AS k, 'none' AS deep,
               CAST(3306 AS INTEGER) AS port
        FROM events
    """,
    "profile": """
        SELECT 'l_quantity' AS "column", bool_and(trunc(l_quantity) = l_quantity) AS whole,
               CAST(NULL AS BIGINT) AS bad, count(*) AS rows FROM lineitem
        UNION ALL SELECT 'l_extendedprice', NULL, 0, count(*) FROM lineitem
        UNION ALL SELECT 'l_returnflag', NULL, count(l_returnflag), count(*) FROM lineitem
        UNION ALL SELECT 'l_linestatus', NULL, count(l_linestatus), count(*) FROM lineitem
        UNION ALL SELECT 'line_text', NULL, 0, count(*) FROM lineitem
        UNION ALL SELECT 'l_discount', bool_and(trunc(l_discount) = l_discount), NULL, count(*) FROM lineitem
        UNION ALL SELECT 'l_tax', bool_and(trunc(l_tax) = l_tax), NULL, count(*) FROM lineitem
    """,
    "demote_whole": "SELECT l_orderkey, CAST(l_quantity AS BIGINT) AS l_quantity, l_extendedprice FROM lineitem",
    "conform_cast": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CAST(trunc(c_acctbal) AS BIGINT) AS c_acctbal, c_name
        FROM customer
    """,
    "conform_missing": """
        SELECT c_custkey, '' AS new_text, CAST(0 AS BIGINT) AS new_int, CAST(0 AS DOUBLE) AS new_float,
               DATE '1970-01-01' AS new_date, TIMESTAMP '1970-01-01 00:00:00' AS new_timestamp,
               TIMESTAMP '1970-01-01 00:00:00' AS new_datetime
        FROM customer
    """,
    "conform_open": """
        SELECT l_orderkey, l_returnflag, l_tax, CAST(l_quantity AS BIGINT) AS l_quantity FROM lineitem
    """,
    "conform_without_contract": "SELECT l_orderkey, l_quantity FROM lineitem",
    "union_same_name": """
        SELECT CAST(o_orderkey AS VARCHAR) AS CodigoVenda, CAST(o_custkey AS VARCHAR) AS CodigoCliente,
               CAST(o_orderdate AS VARCHAR) AS DataVenda, o_totalprice AS VlrBruto, '' AS CodigoLoja,
               o_orderkey + 9007199254740992 AS Longo,
               strftime(o_orderdate, '%Y') AS Ano, strftime(o_orderdate, '%m') AS Mes
        FROM orders
    """,
    "partitions_reloaded": f"""
        SELECT DISTINCT '{TENANT_ID}' AS idEmpresa, strftime(o_orderdate, '%Y') AS Ano,
               strftime(o_orderdate, '%m') AS Mes,
               'idEmpresa={TENANT_ID}/Ano=' || strftime(o_orderdate, '%Y') || '/Mes='
               || strftime(o_orderdate, '%m') AS path
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
    """,
    "partition_inventory": f"SELECT *, 'portal/orders/' || path AS object FROM ({_INVENTORY}) AS i",
    "partition_semi_join": f"""
        WITH old AS ({_INVENTORY}),
        wanted AS (SELECT 'idEmpresa=F' AS r UNION ALL SELECT 'idEmpresa=O/Ano=1996')
        SELECT path FROM old
        WHERE EXISTS (SELECT 1 FROM wanted WHERE path = r OR starts_with(path, r || '/'))
    """,
    "partition_plan": f"WITH {_PLAN_CTE} SELECT tenant, path, action, whole_tenant FROM plan",
    "partition_plan_levels": f"WITH {_PLAN_CTE} SELECT level, path FROM levels",
    "partition_plan_summary": f"""
        WITH {_PLAN_CTE},
        ends AS (
            SELECT level, min(path) AS a, max(path) AS z, count(*) AS n FROM levels GROUP BY level
        )
        SELECT level, a AS "first", z AS "last", n AS partitions,
               CASE WHEN n = 1 THEN level || ': ' || a || ' (1 partição)'
                    ELSE level || ': ' || a || ' ... ' || z || ' (' || n || ' partições)' END AS label
        FROM ends
    """,
    "write_roundtrip": _dataset("Compras"),
    "overwrite_partitions": f"""
        SELECT o_orderkey, CASE WHEN Ano = '1996' AND Mes = '03' THEN o_totalprice * 2 ELSE o_totalprice END
               AS o_totalprice, idEmpresa, Ano, Mes
        FROM ({_MONTHLY}) AS m
    """,
    "overwrite_tenant": """
        SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 0.0::DOUBLE ELSE c_acctbal END AS c_acctbal,
               c_mktsegment AS idEmpresa
        FROM customer
    """,
    "skip_empty": _MONTHLY,
    "skip_empty_other_layout": _MONTHLY,
    "rows_reported_landed": """
        SELECT dataset, 'written' AS status, n > 0 AS agree
        FROM (SELECT count(*) AS n FROM orders) AS o, (VALUES ('Pedidos'), ('Momento'), ('Alguns')) AS d(dataset)
    """,
    "read_after_two_months": """
        SELECT CAST(o_orderkey AS VARCHAR) AS CodigoVenda,
               CASE WHEN o_orderdate < TIMESTAMP '1998-01-01' THEN o_totalprice ELSE floor(o_totalprice) END AS Preco,
               strftime(o_orderdate, '%Y') AS Ano, strftime(o_orderdate, '%m') AS Mes
        FROM orders
    """,
    "read_uneven_history": """
        SELECT CAST(o_orderkey AS VARCHAR) AS CodigoVenda,
               CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' THEN o_totalprice
                    WHEN o_orderdate >= TIMESTAMP '1998-01-01' THEN floor(o_totalprice) END AS Preco,
               strftime(o_orderdate, '%Y') AS Ano, strftime(o_orderdate, '%m') AS Mes
        FROM orders
    """,
    "read_mixed_history": f"""
        SELECT o_orderkey, CASE WHEN month(o_orderdate) = 5 THEN o_totalprice ELSE floor(o_totalprice) END AS price,
               CAST(o_custkey AS VARCHAR) AS customer, '{TENANT_ID}' AS idEmpresa,
               strftime(o_orderdate, '%Y') AS Ano, strftime(o_orderdate, '%m') AS Mes
        FROM orders
    """,
    "ledger_state": f"""
        SELECT 'idEmpresa={TENANT_ID}/Ano=' || strftime(o_orderdate, '%Y') || '/Mes=' || strftime(o_orderdate, '%m') AS path,
               'idEmpresa={TENANT_ID}' AS tenant, count(*) AS rows
        FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderkey % 2 = 0 GROUP BY 1
    """,
    "ledger_reconciled": f"""
        SELECT 'idEmpresa={TENANT_ID}/Ano=' || strftime(o_orderdate, '%Y') || '/Mes=' || strftime(o_orderdate, '%m') AS path,
               count(*) AS rows_entered, count(*) AS rows_found, 'agrees' AS verdict
        FROM orders WHERE year(o_orderdate) <> 1997 OR o_orderkey % 2 = 0 GROUP BY 1
    """,
    "resume_owed": """
        SELECT root, c_name AS NomeCliente, count(*) AS landed,
               CASE WHEN root = 'b' THEN (SELECT count(*) FROM customer) END AS later
        FROM customer, (VALUES ('a'), ('b')) AS r(root) GROUP BY root, c_name
    """,
    "run_plan": f"""
        SELECT DISTINCT 'Vendas' AS dataset,
               'idEmpresa={TENANT_ID}/Ano=' || strftime(o_orderdate, '%Y') || '/Mes=' || strftime(o_orderdate, '%m') AS path,
               CASE WHEN year(o_orderdate) = 1997 THEN 'replace' ELSE 'keep' END AS action, false AS whole_tenant
        FROM orders
        UNION ALL
        SELECT 'Produtos', 'idEmpresa={TENANT_ID}', 'add', false WHERE (SELECT count(*) FROM part) > 0
    """,
    "fan_out": """
        SELECT c_custkey, c_name, c_mktsegment AS idEmpresa, root
        FROM customer, (VALUES ('a'), ('b')) AS r(root)
    """,
    "refresh_table": """
        SELECT strftime(max(ts) - INTERVAL 3 HOUR, '%d/%m/%Y %H:%M:%S') AS DataHoraAtualizacao,
               event_type AS idEmp, event_type AS idEmpresa
        FROM events GROUP BY event_type
    """,
    "run_report": f"""
        SELECT dataset, 'written' AS status, rows, true AS delivered, false AS has_error FROM ({_COUNTS}) AS c
        UNION ALL SELECT 'Quebrada', 'failed', NULL, NULL, true
        UNION ALL SELECT 'Vazia', 'empty', 0, NULL, false
        UNION ALL SELECT 'Atualizacao', 'skipped', NULL, NULL, false
    """,
    "run_totals": f"""
        SELECT count(*) AS succeeded, CAST(1 AS BIGINT) AS failed, CAST(1 AS BIGINT) AS empty,
               CAST(0 AS BIGINT) AS failed_delivery
        FROM ({_COUNTS}) AS c
    """,
    "full_run": f"""
        SELECT root, dataset, rows
        FROM ({_COUNTS} UNION ALL SELECT 'Atualizacao', 1) AS c, (VALUES ('a'), ('b')) AS r(root)
    """,
    "publish_gate": _GATE,
    "publish_gate_modes": f"""
        SELECT 'configured' AS mode, count(*) + 1 AS datasets, false AS publish FROM ({_COUNTS}) AS c
        UNION ALL
        SELECT 'delivered', count(*), bool_and(rows > 0) FROM ({_COUNTS}) AS c
    """,
}
