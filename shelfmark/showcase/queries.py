"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..columns import MONTH, PARTITION_KEYS, TENANT, YEAR
from ..contracts import Contract, bundled_contracts
from ..functions import (
    bucket_of,
    destination_kind,
    first_segment,
    int_or_default,
    nested,
    object_path,
    parent_path,
    time_of_day_from_interval,
    time_of_day_from_text,
    without_prefix,
    without_spaces,
    without_trailing_slashes,
)
from ..operators import (
    cluster_for_write,
    normalize,
    overwrite_partitions,
    partition_inventory,
    partition_path,
    plan_levels,
    plan_summary,
    profile_frame,
    reloaded_partitions,
    retain_reloaded,
    with_audit,
    with_partition_keys,
    write_partitioned,
)
from ..plans import (
    DatasetSpec,
    build_dataset,
    conform_dataset,
    extract,
    fan_out,
    gate_status,
    ledger_entries,
    ledger_state,
    prepare,
    publish_gate,
    reconcile,
    refresh_rows,
    resume,
    row_counts,
    run,
    run_summary,
    written,
)
from ..session import scratch_path
from ..sources import (
    CatalogSource,
    QuantileSplit,
    connection_settings,
    dataset_queries,
    document_faults,
    read_dataset,
    read_tenants,
    select_dataset,
)
from ..sources.queries import MYSQL_QUOTE, quantile_query, range_predicates
from ..storage import delete_tree
from .sources import DATASET_SQL, SPECS, load_table, load_tables, tables_of

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = datetime(2024, 1, 15, 12)
SAMPLE_TENANT = "T0001"
#: From here on a double holds no odd number.
ABOVE_DOUBLES = 2**53
BROKEN = DatasetSpec("Quebrada", "SELECT no_such_column FROM orders")
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def _dataset(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        load_tables(spark, sf_dir, *tables_of(DATASET_SQL[name]))
        spec = DatasetSpec(name, DATASET_SQL[name])
        found = CatalogSource().read(spark, spec.query)
        return conform_dataset(prepare(found, spec, SAMPLE_TENANT, AS_OF), bundled_contracts()[name])

    return build


for _name in DATASET_SQL:
    QUERIES[f"dataset_{_name.lower()}"] = _dataset(_name)

flagship = QUERIES["dataset_vendas"]


# Sources


@query("scan_sql")
def scan_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    load_tables(spark, sf_dir, "orders", "customer", "nation")
    return CatalogSource().read(spark, SCAN_SQL)


SCAN_SQL = """
    SELECT n.n_name AS nation, o.o_orderpriority AS priority, count(*) AS orders,
           max(o.o_totalprice) AS largest
    FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                  JOIN nation n ON c.c_nationkey = n.n_nationkey
    WHERE o.o_orderdate >= TIMESTAMP '1996-01-01 00:00:00'
    GROUP BY n.n_name, o.o_orderpriority;
"""


@query("batch_extract")
def batch_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight queries and one that does not open."""
    load_tables(spark, sf_dir)
    frames, _ = extract(spark, [*SPECS, BROKEN])
    return row_counts(frames)


@query("contract_columns")
def contract_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, types and row count each dataset has once it meets its contract."""
    out = None
    for name, contract in bundled_contracts().items():
        if name not in DATASET_SQL:
            continue
        frame = QUERIES[f"dataset_{name.lower()}"](spark, sf_dir)
        fields = [
            F.struct(F.lit(column).alias("column"), F.lit(kind).alias("type"))
            for column, kind in frame.dtypes
            if contract.type_of(column)
        ]
        counted = frame.agg(F.count(F.lit(1)).alias("rows"))
        part = counted.select(F.lit(name).alias("dataset"), F.inline(F.array(*fields)), "rows")
        out = part if out is None else out.union(part)
    return out


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant documents made of the customers, written and read as JSON."""
    customer = load_table(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    queries = F.array(
        *[
            F.struct(
                F.concat_ws(" ", "c_mktsegment", F.lit(suffix)).alias("name"),
                F.concat(F.lit("SELECT "), key).alias("query"),
            )
            for suffix in ("A", "B 1")
        ]
    )
    connection = F.struct(
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name")).alias("host"),
        F.when(F.col("c_acctbal") < 0, "x").when(F.col("c_acctbal") < 5000, key.cast("string")).alias("porta"),
        F.lower("c_mktsegment").alias("nomeOuCaminhoBanco"),
    )
    documents = customer.select(
        key.cast("string").alias("_id"),
        F.struct(connection.alias("conexaoBanco"), queries.alias("consultas")).alias("parametrizacaoIntegracao"),
    )
    path = scratch_path(spark, "documents")
    documents.write.json(path)
    return read_tenants(spark, path, multi_line=False)


@query("registry_explode")
def registry_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_queries(_documents(spark, sf_dir))


@query("registry_filter")
def registry_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known name keeps its queries, an unknown one keeps them all."""
    queries = dataset_queries(_documents(spark, sf_dir))
    known = select_dataset(queries, "BUILDING B 1").select(F.lit("known").alias("asked"), "tenant", "dataset")
    return known.union(select_dataset(queries, "nowhere").select(F.lit("unknown"), "tenant", "dataset"))


@query("document_faults")
def broken_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant documents of which some are cut off, some hold a text in place of queries."""
    documents = _documents(spark, sf_dir).select(F.struct("_id", "parametrizacaoIntegracao").alias("document"))
    whole = F.to_json("document")
    key = F.col("document._id").cast("bigint")
    text = F.when(key % 10 == 3, F.substring(whole, 1, 60)).when(
        key % 10 == 7, F.concat(F.lit('{"_id":"'), key, F.lit('","parametrizacaoIntegracao":"none"}'))
    ).otherwise(whole)
    path = scratch_path(spark, "faults")
    documents.select(text.alias("value")).write.text(path)
    found = document_faults(spark, path, multi_line=False)
    return found.select(F.regexp_extract("text", '"_id":"([0-9]+)"', 1).alias("tenant"), (F.length("text") == 60).alias("cut_off"))


@query("quantile_ranges")
def quantile_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each range that a query without a date would be read by."""
    load_tables(spark, sf_dir, "lineitem")
    text = "SELECT l_orderkey AS chave, l_quantity FROM lineitem WHERE l_quantity < 30"
    asked = spark.sql(quantile_query(text, QuantileSplit(8, "chave"), MYSQL_QUOTE))
    predicates = range_predicates("chave", [row.bound for row in asked.collect()], MYSQL_QUOTE)
    parts = [
        CatalogSource().read(spark, f"SELECT * FROM ({text}) q WHERE {predicate}").agg(
            F.count(F.lit(1)).alias("rows"), F.min("chave").alias("first"), F.max("chave").alias("last")
        )
        for predicate in predicates
    ]
    return reduce(DataFrame.union, parts).filter("rows > 0")


@query("conn_defaults")
def conn_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return connection_settings(_documents(spark, sf_dir), host="db.invalid", port="3307", user="reader")


# Derived columns


@query("audit_columns")
def audit_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load_table(spark, sf_dir, "customer")
    source = customer.select("c_custkey", F.col("c_mktsegment").alias(TENANT))
    return with_audit(source, SAMPLE_TENANT, AS_OF)


@query("partition_keys")
def partition_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders")
    return with_partition_keys(orders.select("o_orderkey", "o_orderdate"), "o_orderdate")


@query("decimal_to_double")
def decimal_to_double(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load_table(spark, sf_dir, "orders")
    source = orders.select(
        "o_orderkey",
        F.col("o_totalprice").cast("decimal(12,2)").alias("price"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit(float("nan"))).otherwise(F.col("o_totalprice")).alias("gaps"),
        (F.col("o_orderkey").cast("decimal(19,0)") + F.lit(ABOVE_DOUBLES)).cast("decimal(20,0)").alias("wide_key"),
    )
    contract = Contract({"wide_key": "string"})
    return conform_dataset(normalize(source, exact={"wide_key"}), contract)


@query("time_of_day")
def time_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load_table(spark, sf_dir, "events")
    return events.select(
        "event_id",
        time_of_day_from_text(F.col("ts")).alias("of_ts"),
        time_of_day_from_text(F.col("event_type")).alias("of_type"),
    )


@query("time_of_day_interval")
def time_of_day_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Durations since New Year, and the same counted backwards."""
    events = load_table(spark, sf_dir, "events")
    start = F.lit("2024-01-01").cast("timestamp_ntz")
    return events.select(
        "event_id",
        time_of_day_from_interval(F.col("ts") - start).alias("since"),
        time_of_day_from_interval(start - F.col("ts")).alias("until"),
    )


@query("number_to_text")
def number_to_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Doubles that end up in text columns, through profile and conform."""
    orders = load_table(spark, sf_dir, "orders")
    source = orders.select("o_orderkey", (F.col("o_totalprice") * 1000).alias("text"))
    return conform_dataset(normalize(source), Contract({"text": "string"}))


@query("scalar_strings")
def scalar_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = load_table(spark, sf_dir, "pages")
    url = F.col("url")
    return pages.select(
        "page_id",
        without_spaces(F.replace(url, F.lit("."), F.lit(" "))).alias("no_spaces"),
        without_trailing_slashes(F.concat(url, F.lit("//"))).alias("no_slashes"),
        first_segment(F.replace(url, F.lit("https://"), F.lit(""))).alias("first"),
        parent_path(url).alias("parent"),
        without_prefix(url, F.lit("https:/")).alias("below"),
        bucket_of(url, "https://").alias("bucket"),
        object_path(F.lit("portal"), F.lit("pages"), F.col("page_id").cast("string")).alias("object"),
    )


@query("destination_alias")
def destination_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = load_table(spark, sf_dir, "events")
    name = (
        F.when(F.col("event_type") == "view", " AWS ")
        .when(F.col("event_type") == "click", "Amazon")
        .when(F.col("event_type") == "error", "AZURE")
        .when(F.col("event_type") == "signup", "s3")
        .otherwise(F.col("event_type"))
    )
    return events.groupBy(destination_kind(name).alias("kind")).agg(F.count(F.lit(1)).alias("events"))


@query("document_lookup")
def document_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested fields with defaults, and text parsed as an integer with a default."""
    events = load_table(spark, sf_dir, "events")
    props = F.from_json("props", "k string, absent struct<deep: string>")
    return events.select("event_id", "event_type", props.alias("props")).select(
        "event_id",
        int_or_default(nested(F.col("props"), "k"), -1).alias("k"),
        nested(F.col("props"), "absent", "deep", default="none").alias("deep"),
        int_or_default(F.col("event_type"), 3306).alias("port"),
    )


# Conformance


@query("profile")
def profile_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load_table(spark, sf_dir, "lineitem")
    source = lineitem.withColumn("line_text", F.col("l_linenumber").cast("string"))
    contract = Contract(
        {
            "l_quantity": "string",
            "l_extendedprice": "int64",
            "l_returnflag": "int64",
            "l_linestatus": "float64",
            "line_text": "int64",
        }
    )
    return profile_frame(normalize(source), contract)


@query("demote_whole")
def demote_whole(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = load_table(spark, sf_dir, "lineitem")
    source = normalize(lineitem.select("l_orderkey", "l_quantity", "l_extendedprice"))
    return conform_dataset(source, Contract({"l_orderkey": "int64"}))


@query("conform_cast")
def conform_cast(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load_table(spark, sf_dir, "customer")
    source = normalize(customer.select("c_custkey", "c_acctbal", "c_name"))
    return conform_dataset(source, Contract({"c_custkey": "string", "c_acctbal": "int64", "c_name": "int64"}))


@query("conform_missing")
def conform_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = load_table(spark, sf_dir, "customer")
    contract = Contract(
        {
            "c_custkey": "int64",
            "new_text": "string",
            "new_int": "int64",
            "new_float": "float64",
            "new_date": "date",
            "new_timestamp": "timestamp",
            "new_datetime": "datetime",
        }
    )
    return conform_dataset(normalize(customer.select("c_custkey")), contract)


@query("conform_open")
def conform_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Undeclared columns pass through, apart from whole doubles."""
    lineitem = load_table(spark, sf_dir, "lineitem")
    source = normalize(lineitem.select("l_orderkey", "l_returnflag", "l_tax", "l_quantity"))
    return conform_dataset(source, Contract({"l_returnflag": "string"}))


@query("conform_without_contract")
def conform_without_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """No contract: even whole doubles stay doubles."""
    lineitem = load_table(spark, sf_dir, "lineitem")
    return conform_dataset(normalize(lineitem.select("l_orderkey", "l_quantity")), None)


@query("union_same_name")
def union_same_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries whose names agree without spaces: their rows add up."""
    load_tables(spark, sf_dir, "orders")
    source = f"""
        SELECT o_orderkey AS CodigoVenda, o_custkey AS CodigoCliente, o_orderdate AS DataVenda,
               o_totalprice AS VlrBruto, o_orderkey + {ABOVE_DOUBLES} AS Longo
        FROM orders WHERE o_orderdate {{}} TIMESTAMP '1998-01-01 00:00:00'
    """
    specs = [DatasetSpec("Ven das", source.format("<")), DatasetSpec("Vendas", source.format(">="))]
    built = build_dataset(spark, specs, CatalogSource(), bundled_contracts()["Vendas"], SAMPLE_TENANT, AS_OF)
    return built.frame.select("CodigoVenda", "CodigoCliente", "DataVenda", "VlrBruto", "CodigoLoja", "Longo", YEAR, MONTH)


# Partitions


def _monthly_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their status standing in for the tenant."""
    orders = load_table(spark, sf_dir, "orders")
    dated = with_partition_keys(orders, "o_orderdate")
    return dated.select("o_orderkey", "o_totalprice", F.col("o_orderstatus").alias(TENANT), YEAR, MONTH)


def _delivered_orders(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    root = scratch_path(spark, "orders")
    orders = _monthly_orders(spark, sf_dir)
    write_partitioned(cluster_for_write(orders, PARTITION_KEYS), root, PARTITION_KEYS)
    return orders, root


def _reload(orders: DataFrame) -> DataFrame:
    """F: the months of 1996 and a new one; O: all its months; P: nothing."""
    tenant, year = F.col(TENANT), F.col(YEAR)
    in_1996 = (tenant == "F") & (year == "1996")
    moved = orders.filter((tenant == "F") & (year == "2000")).withColumn(YEAR, F.lit("2030"))
    return orders.filter(in_1996 | (tenant == "O")).unionByName(moved)


@query("partitions_reloaded")
def partitions_reloaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    load_tables(spark, sf_dir, "lineitem", "orders")
    spec = DatasetSpec("Vendas", DATASET_SQL["Vendas"])
    ready = prepare(CatalogSource().read(spark, spec.query), spec, SAMPLE_TENANT, AS_OF)
    return reloaded_partitions(ready, PARTITION_KEYS)


@query("partition_inventory")
def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, root = _delivered_orders(spark, sf_dir)
    target = object_path(F.lit("portal"), F.lit("orders"), F.col("path"))
    return partition_inventory(spark, root).withColumn("object", target)


@query("partition_semi_join")
def semi_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months below all of tenant F, or below 1996 of tenant O."""
    orders = _monthly_orders(spark, sf_dir)
    existing = reloaded_partitions(orders, PARTITION_KEYS)
    tenant = orders.filter(F.col(TENANT) == "F").select(partition_path([TENANT]).alias("path"))
    year = orders.filter((F.col(TENANT) == "O") & (F.col(YEAR) == "1996"))
    return retain_reloaded(existing, tenant.union(year.select(partition_path([TENANT, YEAR]))))


def _plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, root = _delivered_orders(spark, sf_dir)
    return overwrite_partitions(_reload(orders), root, PARTITION_KEYS, dry_run=True)


@query("partition_plan")
def plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dry run against delivered files."""
    return _plan(spark, sf_dir)


@query("partition_plan_levels")
def plan_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_levels(_plan(spark, sf_dir))


@query("partition_plan_summary")
def plan_drop_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plan_summary(plan_levels(_plan(spark, sf_dir)))


# Delivery


@query("write_roundtrip")
def write_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = QUERIES["dataset_compras"](spark, sf_dir)
    root = scratch_path(spark, "roundtrip")
    write_partitioned(cluster_for_write(frame, PARTITION_KEYS), root, PARTITION_KEYS)
    return read_dataset(spark, root, frame.schema)


@query("overwrite_partitions")
def replace_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All months delivered, then 1996-03 replaced by doubled prices."""
    orders, root = _delivered_orders(spark, sf_dir)
    march = orders.filter((F.col(YEAR) == "1996") & (F.col(MONTH) == "03"))
    doubled = march.withColumn("o_totalprice", F.col("o_totalprice") * 2)
    overwrite_partitions(cluster_for_write(doubled, PARTITION_KEYS), root, PARTITION_KEYS)
    return read_dataset(spark, root, orders.schema)


@query("overwrite_tenant")
def replace_tenant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tenant-only layout: one tenant replaced, the others kept."""
    customer = load_table(spark, sf_dir, "customer")
    frame = customer.select("c_custkey", "c_acctbal", F.col("c_mktsegment").alias(TENANT))
    root = scratch_path(spark, "customers")
    write_partitioned(cluster_for_write(frame, [TENANT]), root, [TENANT])
    building = frame.filter(F.col(TENANT) == "BUILDING").withColumn("c_acctbal", F.lit(0.0))
    overwrite_partitions(building, root, [TENANT])
    return read_dataset(spark, root, frame.schema)


@query("skip_empty")
def skip_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty reload leaves what is there."""
    orders, root = _delivered_orders(spark, sf_dir)
    overwrite_partitions(orders.filter("o_totalprice < 0"), root, PARTITION_KEYS)
    return read_dataset(spark, root, orders.schema)


@query("skip_empty_other_layout")
def skip_empty_undated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An empty reload without its date column leaves the months alone."""
    orders, root = _delivered_orders(spark, sf_dir)
    nothing = orders.filter("o_totalprice < 0").drop(YEAR, MONTH)
    overwrite_partitions(nothing, root, [TENANT], tenant="F")
    return read_dataset(spark, root, orders.schema)


@query("rows_reported_landed")
def reported_and_landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reported and landed rows, of queries whose rows may differ each time too."""
    load_tables(spark, sf_dir, "orders", "customer")
    share = "pmod(xxhash64(o_orderkey, current_timestamp()), 10) < 5"
    specs = [
        DatasetSpec("Pedidos", "SELECT o_orderkey, o_orderdate AS d FROM orders", date_col="d"),
        DatasetSpec("Momento", f"SELECT o_orderkey, o_totalprice FROM orders WHERE {share}"),
        DatasetSpec("Alguns", "SELECT c_custkey, c_acctbal FROM customer LIMIT 100"),
    ]
    root = scratch_path(spark, "landed")
    contracts = {spec.dataset: Contract({"other": "string"}) for spec in specs}
    report = run(spark, specs, SAMPLE_TENANT, [root], contracts, as_of=AS_OF).filter("dataset <> 'Atualizacao'")
    landed = None
    for spec in specs:
        count = read_dataset(spark, f"{root}/{spec.dataset}").agg(F.count(F.lit(1)).alias("landed"))
        part = count.select(F.lit(spec.dataset).alias("dataset"), "landed")
        landed = part if landed is None else landed.union(part)
    both = report.join(landed, "dataset")
    return both.select("dataset", "status", (F.col("rows") == F.col("landed")).alias("agree"))


@query("read_after_two_months")
def read_two_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with fractions in its first load and none in the second keeps its type."""
    load_tables(spark, sf_dir, "orders")
    root = scratch_path(spark, "two-loads")
    parts = {"<": "o_totalprice", ">=": "floor(o_totalprice)"}
    for when, price in parts.items():
        text = f"""
            SELECT o_orderkey AS CodigoVenda, o_orderdate AS DataVenda, CAST({price} AS DOUBLE) AS Preco
            FROM orders WHERE o_orderdate {when} TIMESTAMP '1998-01-01 00:00:00'
        """
        run(spark, [DatasetSpec("Vendas", text)], SAMPLE_TENANT, [root], as_of=AS_OF)
    return read_dataset(spark, f"{root}/Vendas").select("CodigoVenda", "Preco", YEAR, MONTH)


@query("read_uneven_history")
def read_uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column with fractions at first, absent for two years, and whole at last."""
    load_tables(spark, sf_dir, "orders")
    root = scratch_path(spark, "uneven")
    whole = ", CAST(floor(o_totalprice) AS DOUBLE) AS Preco"
    spans = [("1900", "1996", ", o_totalprice AS Preco"), ("1996", "1998", ""), ("1998", "2100", whole)]
    for first, last, price in spans:
        text = f"""
            SELECT o_orderkey AS CodigoVenda, o_orderdate AS DataVenda{price} FROM orders
            WHERE o_orderdate >= TIMESTAMP '{first}-01-01 00:00:00' AND o_orderdate < TIMESTAMP '{last}-01-01 00:00:00'
        """
        run(spark, [DatasetSpec("Vendas", text)], SAMPLE_TENANT, [root], as_of=AS_OF)
    return read_dataset(spark, f"{root}/Vendas").select("CodigoVenda", "Preco", YEAR, MONTH)


@query("read_mixed_history")
def read_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that were written with types of their own: bigint, double and text."""
    orders = load_table(spark, sf_dir, "orders")
    root = scratch_path(spark, "mixed")
    dated = with_partition_keys(orders, "o_orderdate").withColumn(TENANT, F.lit(SAMPLE_TENANT))
    price, month = F.col("o_totalprice"), F.col(MONTH)
    kinds = [
        (month < "05", F.floor(price), F.col("o_custkey").cast("string")),
        (month == "05", price, F.col("o_custkey")),
        (month > "05", F.floor(price), F.col("o_custkey")),
    ]
    for when, number, text in kinds:
        part = dated.filter(when).select("o_orderkey", number.alias("price"), text.alias("customer"), *PARTITION_KEYS)
        write_partitioned(cluster_for_write(part, PARTITION_KEYS), root, PARTITION_KEYS)
    return read_dataset(spark, root)


def _twice_by_ledger(spark: SparkSession, sf_dir: str, *roots: str) -> None:
    """Orders by month with a ledger, then the months of 1997 again with half the rows."""
    load_tables(spark, sf_dir, "orders")
    text = "SELECT o_orderkey AS CodigoVenda, o_orderdate AS DataVenda, o_totalprice AS VlrBruto FROM orders"
    half = f"{text} WHERE year(o_orderdate) = 1997 AND o_orderkey % 2 = 0"
    for query_text in (text, half):
        run(spark, [DatasetSpec("Vendas", query_text)], SAMPLE_TENANT, roots, as_of=AS_OF, ledger=True)


@query("ledger_state")
def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the ledger says of each partition, without a look at the folders."""
    root = scratch_path(spark, "ledger")
    _twice_by_ledger(spark, sf_dir, root)
    return ledger_state(ledger_entries(spark, f"{root}/Vendas")).select("path", "tenant", "rows")


@query("ledger_reconciled")
def ledger_reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows entered beside rows in the footers of the delivered files."""
    root = scratch_path(spark, "reconciled")
    _twice_by_ledger(spark, sf_dir, root)
    return reconcile(spark, f"{root}/Vendas").select("path", "rows_entered", "rows_found", "verdict")


@query("resume_owed")
def resume_owed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of two roots one refuses the second load and gets it later; both read back."""
    roots = {name: scratch_path(spark, f"owed-{name}") for name in ("a", "b")}
    load_tables(spark, sf_dir, "customer")
    undated = DatasetSpec("Clientes", "SELECT c_custkey AS CodigoCliente, c_name AS NomeCliente FROM customer")
    # Months in the way: an undated load is refused there until that is allowed.
    dated = with_partition_keys(load_table(spark, sf_dir, "orders"), "o_orderdate").withColumn(TENANT, F.lit(SAMPLE_TENANT))
    write_partitioned(dated, f"{roots['b']}/Clientes", PARTITION_KEYS)
    run(spark, [undated], SAMPLE_TENANT, list(roots.values()), as_of=AS_OF, ledger=True)
    delete_tree(spark, f"{roots['b']}/Clientes/{TENANT}={SAMPLE_TENANT}")
    delivered = resume(spark, list(roots.values())).filter("delivered")
    named = reduce(lambda c, item: c.when(F.col("path").startswith(item[1]), item[0]), roots.items(), F.when(F.lit(False), ""))
    later = delivered.groupBy(named.alias("root")).agg(F.sum("rows").alias("later"))
    back = [
        read_dataset(spark, f"{root}/Clientes").groupBy(F.lit(name).alias("root"), "NomeCliente").agg(F.count(F.lit(1)).alias("landed"))
        for name, root in roots.items()
    ]
    return back[0].union(back[1]).join(later, "root", "left")


@query("run_plan")
def run_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dry run of a whole run: months of 1997 over all months, and a dataset that is new."""
    load_tables(spark, sf_dir, "orders", "part")
    root = scratch_path(spark, "dry")
    text = "SELECT o_orderkey AS CodigoVenda, o_orderdate AS DataVenda FROM orders"
    run(spark, [DatasetSpec("Vendas", text)], SAMPLE_TENANT, [root], as_of=AS_OF)
    specs = [DatasetSpec("Vendas", f"{text} WHERE year(o_orderdate) = 1997"), DatasetSpec("Produtos", "SELECT p_partkey AS CodigoProduto FROM part")]
    plans = run(spark, specs, SAMPLE_TENANT, [root], as_of=AS_OF, dry_run=True)
    return plans.select(F.regexp_extract("root", "([^/]*)$", 1).alias("dataset"), "path", "action", "whole_tenant")


@query("fan_out")
def deliver_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset fanned out to two roots, both read back."""
    customer = load_table(spark, sf_dir, "customer")
    frame = customer.select("c_custkey", "c_name", F.col("c_mktsegment").alias(TENANT))
    roots = {name: scratch_path(spark, f"root-{name}") for name in ("a", "b")}
    errors = fan_out(frame, list(roots.values()), [TENANT])
    back = [
        read_dataset(spark, root, frame.schema).withColumn("root", F.lit(name))
        for name, root in roots.items()
        if errors[root] is None
    ]
    return back[0].unionByName(back[1])


@query("refresh_table")
def refresh_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Refresh rows per tenant (the event type), delivered and read back."""
    events = load_table(spark, sf_dir, "events")
    latest = events.groupBy(F.col("event_type").alias("tenant")).agg(F.max("ts").alias("refreshed_at"))
    table = refresh_rows(latest, bundled_contracts()["Atualizacao"])
    root = scratch_path(spark, "refresh")
    overwrite_partitions(table, root, [TENANT])
    return read_dataset(spark, root, table.schema)


# Runs


def _mixed_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The eight datasets, one broken query and one without rows; only the report stays."""
    load_tables(spark, sf_dir)
    empty = DatasetSpec("Vazia", "SELECT o_orderkey FROM orders WHERE o_totalprice < 0")
    root = scratch_path(spark, "run")
    report = run(spark, [*SPECS, BROKEN, empty], SAMPLE_TENANT, [root], as_of=AS_OF)
    delete_tree(spark, root)
    return report


@query("run_report")
def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = _mixed_run(spark, sf_dir)
    return report.select("dataset", "status", "rows", "delivered", F.col("error").isNotNull().alias("has_error"))


@query("run_totals")
def run_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_summary(_mixed_run(spark, sf_dir))


@query("full_run")
def full_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight datasets to two roots plus the refresh table, counted where they landed."""
    load_tables(spark, sf_dir)
    roots = {name: scratch_path(spark, f"run-{name}") for name in ("a", "b")}
    report = run(spark, SPECS, SAMPLE_TENANT, list(roots.values()), as_of=AS_OF)
    out = None
    for dataset in [row.dataset for row in written(report).select("dataset").collect()]:
        for name, root in roots.items():
            landed = read_dataset(spark, f"{root}/{dataset}").agg(F.count(F.lit(1)).alias("rows"))
            part = landed.select(F.lit(name).alias("root"), F.lit(dataset).alias("dataset"), "rows")
            out = part if out is None else out.union(part)
    counted = spark.createDataFrame(out.collect(), out.schema)
    for root in roots.values():
        delete_tree(spark, root)
    return counted


@query("publish_gate")
def gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dataset per event type, ok when its smallest value is large enough."""
    events = load_table(spark, sf_dir, "events")
    status = events.groupBy(F.col("event_type").alias("dataset")).agg((F.min("value") >= 0.02).alias("ok"))
    out = None
    for case, frame in (("all", status), ("passing", status.filter("ok"))):
        for wanted in (3, 5, 8):
            part = publish_gate(frame, wanted).select(
                F.lit(case).alias("datasets_from"), F.lit(wanted).alias("wanted"), "datasets", "publish"
            )
            out = part if out is None else out.union(part)
    return out


@query("publish_gate_modes")
def gate_modes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixed run at the gate: its failed extraction counts only as configured."""
    report = _mixed_run(spark, sf_dir).filter(F.col("dataset") != "Atualizacao")
    parts = [
        publish_gate(gate_status(report, mode)).select(F.lit(mode).alias("mode"), "datasets", "publish")
        for mode in ("configured", "delivered")
    ]
    return parts[0].union(parts[1])
