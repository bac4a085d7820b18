"""What conformed datasets must look like, written out column by column.

Nothing here is taken from the contracts, so an error in them shows.
"""

from __future__ import annotations

# Expressions over the columns that the source SQL delivers.
EXPECTED: dict[str, str] = {
    "Clientes": r"""
        CodigoCliente::VARCHAR AS CodigoCliente, '' AS CodigoVisualNomeCliente, '' AS CodigoClienteVisual,
        NomeCliente::VARCHAR AS NomeCliente, '' AS CpfCnpj, '' AS Telefone, '' AS Celular, '' AS
        DataNascimento, '' AS Sexo, '' AS EstadoCivil, '' AS Cep, '' AS Endereco, '' AS Numero, '' AS Bairro,
        Cidade::VARCHAR AS Cidade, Estado::VARCHAR AS Estado, 'T0001' AS idEmp, 'T0001' AS idEmpresa,
        '15/01/2024 09:00:00' AS DataHoraAtualizacao, Saldo
    """,
    "CodigoBarras": r"""
        CodigoProduto::VARCHAR AS CodigoProduto, CodigoBarras::VARCHAR AS CodigoBarras, 'T0001' AS idEmp,
        'T0001' AS idEmpresa, '15/01/2024 09:00:00' AS DataHoraAtualizacao
    """,
    "Compras": r"""
        CodigoLoja::VARCHAR AS CodigoLoja, NomeRazaoSocialFornecedor::VARCHAR AS NomeRazaoSocialFornecedor,
        CodigoCompra::VARCHAR AS CodigoCompra, '' AS NroNF, CodigoProduto::VARCHAR AS CodigoProduto,
        trunc(TipoCompra)::BIGINT AS TipoCompra, '' AS Cfop, DataEmissaoNF::VARCHAR AS DataEmissaoNF,
        0::DOUBLE AS Fracao, Quantidade::DOUBLE AS Quantidade, 0::DOUBLE AS VlrUnitario, VlrDesconto::DOUBLE
        AS VlrDesconto, '' AS CodigoTransferencia, '' AS OrigemTransferencia, '' AS DataTransferencia, '' AS
        DestinoTransfencia, VlrTotalLiquido::DOUBLE AS VlrTotalLiquido, '' AS NomeFornecedorFantasia, 'T0001'
        AS idEmp, 'T0001' AS idEmpresa, '15/01/2024 09:00:00' AS DataHoraAtualizacao,
        substring(CAST(DataEmissaoNF AS VARCHAR), 1, 4) AS Ano, substring(CAST(DataEmissaoNF AS VARCHAR), 6,
        2) AS Mes
    """,
    "Estoque": r"""
        CodigoProduto::VARCHAR AS CodigoProduto, CodigoLoja::VARCHAR AS CodigoLoja, NomeProduto::VARCHAR AS
        NomeProduto, trunc(PermiteCompra)::BIGINT AS PermiteCompra, QtdEstoque::DOUBLE AS QtdEstoque,
        0::DOUBLE AS QtdEstoqueMinimo, 0::DOUBLE AS VlrPrecoCompra, VlrPrecoVenda::DOUBLE AS VlrPrecoVenda,
        'T0001' AS idEmp, 'T0001' AS idEmpresa, '15/01/2024 09:00:00' AS DataHoraAtualizacao
    """,
    "Fornecedores": r"""
        RazaoSocial::VARCHAR AS RazaoSocial, '' AS NomeFantasia, '' AS Cnpj, CodigoFornecedor::VARCHAR AS
        CodigoFornecedor, 'T0001' AS idEmp, 'T0001' AS idEmpresa, '15/01/2024 09:00:00' AS
        DataHoraAtualizacao, Saldo
    """,
    "Funcionarios": r"""
        CodigoFuncionario::VARCHAR AS CodigoFuncionario, '' AS NomeFuncionario, '' AS CodigoNomeFuncionario,
        '' AS CodigoLoja, Ativo::VARCHAR AS Ativo, '' AS Telefone, 'T0001' AS idEmp, 'T0001' AS idEmpresa,
        '15/01/2024 09:00:00' AS DataHoraAtualizacao
    """,
    "Produtos": r"""
        CodigoProduto::VARCHAR AS CodigoProduto, NomeProduto::VARCHAR AS NomeProduto, '' AS CodigoNomeProduto,
        '' AS CodigoBarras, '' AS NomeGrupo, CodigoGrupo::VARCHAR AS CodigoGrupo, NomeCategoria::VARCHAR AS
        NomeCategoria, '' AS CodigoCategoria, '' AS DataCadastro, trunc(Ativo)::BIGINT AS Ativo, '' AS
        CodigoLaboratorio, NomeLaboratorio::VARCHAR AS NomeLaboratorio, '' AS PrincipioAtivo, '' AS
        CodigoNomeGrupo, '' AS CodigoNomeCategoria, '' AS CodigoNomeLaboratorio, 'T0001' AS idEmp, 'T0001' AS
        idEmpresa, '15/01/2024 09:00:00' AS DataHoraAtualizacao
    """,
    "Vendas": r"""
        CodigoLoja::VARCHAR AS CodigoLoja, CodigoVenda::VARCHAR AS CodigoVenda, '' AS CodigoVendaUnico,
        NroNota::VARCHAR AS NroNota, '' AS CodigoCaixa, CodigoProduto::VARCHAR AS CodigoProduto,
        LocalVenda::VARCHAR AS LocalVenda, DataVenda::VARCHAR AS DataVenda,
        coalesce(nullif(regexp_extract(HoraVenda, '(\d{2}:\d{2}:\d{2})', 1), ''), '00:00:00') AS HoraVenda,
        0::DOUBLE AS Fracao, '' AS UnidadeFracao, Quantidade::DOUBLE AS Quantidade, VlrUnitario::DOUBLE AS
        VlrUnitario, VlrLiquido::DOUBLE AS VlrLiquido, VlrDesconto::DOUBLE AS VlrDesconto, VlrBruto::DOUBLE AS
        VlrBruto, TipoVenda::VARCHAR AS TipoVenda, 0::DOUBLE AS VlrCMV, '' AS CodigoVendedor,
        CodigoCliente::VARCHAR AS CodigoCliente, FormaPagamento::VARCHAR AS FormaPagamento, '' AS
        CodigoFormaPagamento, '' AS CodigoNomeFormaPagamento, '' AS NomeEntregador, '' AS CodigoEntregador, ''
        AS CodigoNomeEntregador, '' AS CodigoPBM, '' AS NomePBM, '' AS CodigoNomePBM, 'T0001' AS idEmp,
        'T0001' AS idEmpresa, '15/01/2024 09:00:00' AS DataHoraAtualizacao, substring(CAST(DataVenda AS
        VARCHAR), 1, 4) AS Ano, substring(CAST(DataVenda AS VARCHAR), 6, 2) AS Mes, Imposto, CAST(QtdItens AS
        BIGINT) AS QtdItens
    """,
}

# Declared columns and the types they end up with.
EXPECTED_TYPES: dict[str, str] = {
    "Clientes": """
        CodigoCliente string, CodigoVisualNomeCliente string, CodigoClienteVisual string, NomeCliente string,
        CpfCnpj string, Telefone string, Celular string, DataNascimento string, Sexo string, EstadoCivil
        string, Cep string, Endereco string, Numero string, Bairro string, Cidade string, Estado string, idEmp
        string, idEmpresa string, DataHoraAtualizacao string
    """,
    "CodigoBarras": """
        CodigoProduto string, CodigoBarras string, idEmp string, idEmpresa string, DataHoraAtualizacao string
    """,
    "Compras": """
        CodigoLoja string, NomeRazaoSocialFornecedor string, CodigoCompra string, NroNF string, CodigoProduto
        string, TipoCompra bigint, Cfop string, DataEmissaoNF string, Fracao double, Quantidade double,
        VlrUnitario double, VlrDesconto double, CodigoTransferencia string, OrigemTransferencia string,
        DataTransferencia string, DestinoTransfencia string, VlrTotalLiquido double, NomeFornecedorFantasia
        string, idEmp string, idEmpresa string, DataHoraAtualizacao string, Ano string, Mes string
    """,
    "Estoque": """
        CodigoProduto string, CodigoLoja string, NomeProduto string, PermiteCompra bigint, QtdEstoque double,
        QtdEstoqueMinimo double, VlrPrecoCompra double, VlrPrecoVenda double, idEmp string, idEmpresa string,
        DataHoraAtualizacao string
    """,
    "Fornecedores": """
        RazaoSocial string, NomeFantasia string, Cnpj string, CodigoFornecedor string, idEmp string, idEmpresa
        string, DataHoraAtualizacao string
    """,
    "Funcionarios": """
        CodigoFuncionario string, NomeFuncionario string, CodigoNomeFuncionario string, CodigoLoja string,
        Ativo string, Telefone string, idEmp string, idEmpresa string, DataHoraAtualizacao string
    """,
    "Produtos": """
        CodigoProduto string, NomeProduto string, CodigoNomeProduto string, CodigoBarras string, NomeGrupo
        string, CodigoGrupo string, NomeCategoria string, CodigoCategoria string, DataCadastro string, Ativo
        bigint, CodigoLaboratorio string, NomeLaboratorio string, PrincipioAtivo string, CodigoNomeGrupo
        string, CodigoNomeCategoria string, CodigoNomeLaboratorio string, idEmp string, idEmpresa string,
        DataHoraAtualizacao string
    """,
    "Vendas": """
        CodigoLoja string, CodigoVenda string, CodigoVendaUnico string, NroNota string, CodigoCaixa string,
        CodigoProduto string, LocalVenda string, DataVenda string, HoraVenda string, Fracao double,
        UnidadeFracao string, Quantidade double, VlrUnitario double, VlrLiquido double, VlrDesconto double,
        VlrBruto double, TipoVenda string, VlrCMV double, CodigoVendedor string, CodigoCliente string,
        FormaPagamento string, CodigoFormaPagamento string, CodigoNomeFormaPagamento string, NomeEntregador
        string, CodigoEntregador string, CodigoNomeEntregador string, CodigoPBM string, NomePBM string,
        CodigoNomePBM string, idEmp string, idEmpresa string, DataHoraAtualizacao string, Ano string, Mes
        string
    """,
}
