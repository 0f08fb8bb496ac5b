"""Specs of the 10 company-register tables.

Fixed values: the files have no header, so the order of the columns here is their order in the
file. Descriptions are trimmed, codes are kept as they are.
"""

from __future__ import annotations

from aduana.operators.spec import ColumnRule, TableSpec, renamed, same_name


def _codes(*names: str):
    return same_name(*names)


def _labels(*names: str):
    return same_name(*names, trim=True)


def _dates(*names: str):
    return same_name(*names, type_name="date")


def _numbers(*names: str):
    return same_name(*names, type_name="int")


def _code_list(name: str, key: str, label: str) -> TableSpec:
    return TableSpec(name, [key], [*_codes(key), *_labels(label)])


REGISTER_TABLES = [
    _code_list("cnaes", "codigo_cnae", "descricao_cnae"),
    TableSpec("empresas", ["cnpj_basico"], [
        *_codes("cnpj_basico"),
        *_labels("razao_social"),
        *_codes("natureza_juridica", "qualificacao_responsavel"),
        ColumnRule("capital_social", "capital_social", "decimal(18,2)"),
        *_codes("porte_empresa"),
        *_labels("ente_federativo_responsavel"),
    ]),
    TableSpec("estabelecimentos", ["cnpj_basico", "cnpj_ordem", "cnpj_dv"], [
        *_codes("cnpj_basico", "cnpj_ordem", "cnpj_dv", "identificador_matriz_filial"),
        *_labels("nome_fantasia"),
        *_codes("situacao_cadastral"),
        *_dates("data_situacao_cadastral"),
        *_numbers("motivo_situacao_cadastral"),
        *_labels("nome_cidade_exterior"),
        *_numbers("pais"),
        *_dates("data_inicio_atividade"),
        *_codes("cnae_fiscal_principal", "cnae_fiscal_secundaria"),
        *_labels("tipo_logradouro", "logradouro", "numero", "complemento", "bairro"),
        *_codes("cep", "uf", "municipio"),
        *renamed({"ddd_1": "ddd1", "telefone_1": "telefone1", "ddd_2": "ddd2", "telefone_2": "telefone2"}),
        *_codes("ddd_fax", "fax"),
        *_labels("email", "situacao_especial"),
        *_dates("data_situacao_especial"),
    ], partition_by=["uf"]),
    _code_list("motivos", "codigo_motivo", "descricao_motivo"),
    _code_list("municipios", "codigo_municipio", "descricao_municipio"),
    _code_list("naturezas", "codigo_natureza_juridica", "descricao_natureza_juridica"),
    _code_list("paises", "codigo_pais", "descricao_pais"),
    _code_list("qualificacoes", "codigo_qualificacao", "descricao_qualificacao"),
    TableSpec("simples", ["cnpj_basico"], [
        *_codes("cnpj_basico", "opcao_simples"),
        *_dates("data_opcao_simples", "data_exclusao_simples"),
        *_codes("opcao_mei"),
        *_dates("data_opcao_mei", "data_exclusao_mei"),
    ]),
    TableSpec("socios", ["cnpj_basico", "cpf_cnpj_socio"], [
        *_codes("cnpj_basico", "identificador_socio"),
        *_labels("nome_socio_razao_social"),
        *_codes("cpf_cnpj_socio", "qualificacao_socio"),
        *_dates("data_entrada_sociedade"),
        *_codes("pais"),
        *_labels("cpf_representante_legal", "nome_representante_legal"),
        *_codes("qualificacao_representante_legal"),
        *_numbers("faixa_etaria"),
    ]),
]

POSITIONS = {spec.name: [rule.source for rule in spec.columns] for spec in REGISTER_TABLES}
