"""Column contracts: which columns a delivered dataset must have, and their types."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Type names a contract may use, their Spark type and the default
# given to a declared column the source does not deliver.
TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int64": T.LongType(),
    "float64": T.DoubleType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "datetime": T.TimestampNTZType(),
}
DEFAULTS: dict[str, str] = {
    "string": "",
    "int64": "0",
    "float64": "0.0",
    "date": "1970-01-01",
    "timestamp": "1970-01-01 00:00:00",
    "datetime": "1970-01-01 00:00:00",
}

# The columns and types of each dataset, in delivery order.
BUNDLED = {
    "Atualizacao": """
        DataHoraAtualizacao string, idEmp string, idEmpresa string
    """,
    "Clientes": """
        CodigoCliente string, CodigoVisualNomeCliente string, CodigoClienteVisual string,
        NomeCliente string, CpfCnpj string, Telefone string, Celular string,
        DataNascimento string, Sexo string, EstadoCivil string, Cep string, Endereco string,
        Numero string, Bairro string, Cidade string, Estado string, idEmp string,
        idEmpresa string, DataHoraAtualizacao string
    """,
    "CodigoBarras": """
        CodigoProduto string, CodigoBarras string, idEmp string, idEmpresa string,
        DataHoraAtualizacao string
    """,
    "Compras": """
        CodigoLoja string, NomeRazaoSocialFornecedor string, CodigoCompra string, NroNF string,
        CodigoProduto string, TipoCompra int64, Cfop string, DataEmissaoNF string,
        Fracao float64, Quantidade float64, VlrUnitario float64, VlrDesconto float64,
        CodigoTransferencia string, OrigemTransferencia string, DataTransferencia string,
        DestinoTransfencia string, VlrTotalLiquido float64, NomeFornecedorFantasia string,
        idEmp string, idEmpresa string, DataHoraAtualizacao string, Ano string, Mes string
    """,
    "Estoque": """
        CodigoProduto string, CodigoLoja string, NomeProduto string, PermiteCompra int64,
        QtdEstoque float64, QtdEstoqueMinimo float64, VlrPrecoCompra float64,
        VlrPrecoVenda float64, idEmp string, idEmpresa string, DataHoraAtualizacao string
    """,
    "Fornecedores": """
        RazaoSocial string, NomeFantasia string, Cnpj string, CodigoFornecedor string,
        idEmp string, idEmpresa string, DataHoraAtualizacao string
    """,
    "Funcionarios": """
        CodigoFuncionario string, NomeFuncionario string, CodigoNomeFuncionario string,
        CodigoLoja string, Ativo string, Telefone string, idEmp string, idEmpresa string,
        DataHoraAtualizacao string
    """,
    "Produtos": """
        CodigoProduto string, NomeProduto string, CodigoNomeProduto string, CodigoBarras string,
        NomeGrupo string, CodigoGrupo string, NomeCategoria string, CodigoCategoria string,
        DataCadastro string, Ativo int64, CodigoLaboratorio string, NomeLaboratorio string,
        PrincipioAtivo string, CodigoNomeGrupo string, CodigoNomeCategoria string,
        CodigoNomeLaboratorio string, idEmp string, idEmpresa string, DataHoraAtualizacao string
    """,
    "Vendas": """
        CodigoLoja string, CodigoVenda string, CodigoVendaUnico string, NroNota string,
        CodigoCaixa string, CodigoProduto string, LocalVenda string, DataVenda string,
        HoraVenda string, Fracao float64, UnidadeFracao string, Quantidade float64,
        VlrUnitario float64, VlrLiquido float64, VlrDesconto float64, VlrBruto float64,
        TipoVenda string, VlrCMV float64, CodigoVendedor string, CodigoCliente string,
        FormaPagamento string, CodigoFormaPagamento string, CodigoNomeFormaPagamento string,
        NomeEntregador string, CodigoEntregador string, CodigoNomeEntregador string,
        CodigoPBM string, NomePBM string, CodigoNomePBM string, idEmp string, idEmpresa string,
        DataHoraAtualizacao string, Ano string, Mes string
    """,
}


@dataclass(frozen=True)
class Contract:
    """Declared columns in order. A type name outside ``TYPES`` is allowed: such
    a column is left as it comes, or added as empty text when missing. An empty
    contract counts as none."""

    columns: dict[str, str]

    def __bool__(self) -> bool:
        return bool(self.columns)

    def type_of(self, name: str) -> str | None:
        return self.columns.get(name)

    def missing_from(self, names: list[str]) -> dict[str, Column]:
        """Typed default for every declared column not among ``names``."""
        present = set(names)
        return {
            name: F.lit(DEFAULTS.get(kind, "")).cast(TYPES.get(kind, T.StringType()))
            for name, kind in self.columns.items()
            if name not in present
        }

    def schema(self) -> T.StructType:
        return T.StructType(
            [T.StructField(name, TYPES.get(kind, T.StringType())) for name, kind in self.columns.items()]
        )


def bundled_contracts() -> dict[str, Contract]:
    return {
        dataset: Contract(dict(pair.split() for pair in text.split(",")))
        for dataset, text in BUNDLED.items()
    }


def load_contracts(spark: SparkSession, path: str) -> dict[str, Contract]:
    """Contracts from a JSON dictionary ``{dataset: {column: type}}`` at any root."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return {dataset: Contract(columns) for dataset, columns in json.loads(text).items()}
