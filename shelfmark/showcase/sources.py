"""Source SQL that feeds the eight business datasets from the sample tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..plans import DatasetSpec

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "pages")

DATASET_SQL = {
    "Vendas": """
        SELECT l.l_suppkey AS CodigoLoja, o.o_orderkey AS CodigoVenda, l.l_linenumber AS NroNota,
               l.l_partkey AS CodigoProduto, l.l_linestatus AS LocalVenda, o.o_orderdate AS DataVenda,
               CAST(o.o_orderdate AS STRING) AS HoraVenda, l.l_quantity AS Quantidade,
               l.l_extendedprice / l.l_quantity AS VlrUnitario, l.l_extendedprice AS VlrBruto,
               l.l_extendedprice * l.l_discount AS VlrDesconto,
               l.l_extendedprice * (1 - l.l_discount) AS VlrLiquido, l.l_returnflag AS TipoVenda,
               o.o_custkey AS CodigoCliente, o.o_orderpriority AS FormaPagamento,
               l.l_tax AS Imposto, l.l_quantity AS QtdItens
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
    """,
    "Compras": """
        SELECT l.l_suppkey AS CodigoLoja, s.s_name AS NomeRazaoSocialFornecedor,
               l.l_orderkey AS CodigoCompra, l.l_partkey AS CodigoProduto,
               l.l_linenumber AS TipoCompra, l.l_shipdate AS DataEmissaoNF, l.l_quantity AS Quantidade,
               l.l_extendedprice AS VlrTotalLiquido, l.l_discount AS VlrDesconto
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
    """,
    "Clientes": """
        SELECT c.c_custkey AS CodigoCliente, c.c_name AS NomeCliente, n.n_name AS Estado,
               r.r_name AS Cidade, c.c_acctbal AS Saldo
        FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
                        JOIN region r ON n.n_regionkey = r.r_regionkey
    """,
    "Produtos": """
        SELECT p_partkey AS CodigoProduto, p_name AS NomeProduto, p_brand AS NomeLaboratorio,
               p_type AS NomeCategoria, p_size AS CodigoGrupo, CAST(p_partkey % 2 AS DOUBLE) AS Ativo
        FROM part
    """,
    "CodigoBarras": """
        SELECT p_partkey AS CodigoProduto, lpad(CAST(p_partkey AS STRING), 13, '0') AS CodigoBarras
        FROM part
    """,
    "Estoque": """
        SELECT l.l_partkey AS CodigoProduto, l.l_suppkey AS CodigoLoja, p.p_name AS NomeProduto,
               1 AS PermiteCompra, sum(l.l_quantity) AS QtdEstoque, max(p.p_retailprice) AS VlrPrecoVenda
        FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
        GROUP BY l.l_partkey, l.l_suppkey, p.p_name
    """,
    "Fornecedores": """
        SELECT s_suppkey AS CodigoFornecedor, s_name AS RazaoSocial, s_acctbal AS Saldo FROM supplier
    """,
    "Funcionarios": """
        SELECT DISTINCT user_id AS CodigoFuncionario, 'S' AS Ativo FROM events
    """,
}

SPECS = [DatasetSpec(name, query) for name, query in DATASET_SQL.items()]


def load_tables(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, DataFrame]:
    """Sample tables (all by default), also as temporary views for the source SQL."""
    tables = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in names or TABLES}
    for name, table in tables.items():
        table.createOrReplaceTempView(name)
    return tables


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load_tables(spark, sf_dir, name)[name]


def tables_of(sql: str) -> list[str]:
    """Sample tables a source query names."""
    words = set(sql.split())
    return [name for name in TABLES if name in words]
