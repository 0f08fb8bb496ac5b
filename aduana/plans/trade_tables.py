"""Specs of the 22 trade tables.

Fixed values: the column names of the published files, in file order. A name in capitals keeps
itself in lower case; dimension columns are trimmed text, measures are whole numbers.
"""

from __future__ import annotations

from aduana.operators.spec import TableSpec, renamed, same_name


def _text(*sources: str):
    return same_name(*sources, trim=True)


def _dimension(name: str, keys: list[str], *columns: str) -> TableSpec:
    return TableSpec(name, keys, _text(*columns))


DIMENSIONS = [
    _dimension("pais", ["co_pais"], "CO_PAIS", "CO_PAIS_ISON3", "CO_PAIS_ISOA3", "NO_PAIS", "NO_PAIS_ING", "NO_PAIS_ESP"),
    _dimension("via", ["co_via"], "CO_VIA", "NO_VIA"),
    _dimension("urf", ["co_urf"], "CO_URF", "NO_URF"),
    _dimension("ncm_unidade", ["co_unid"], "CO_UNID", "NO_UNID", "SG_UNID"),
    _dimension("uf", ["sg_uf"], "CO_UF", "SG_UF", "NO_UF", "NO_REGIAO"),
    _dimension("uf_mun", ["co_mun_geo"], "CO_MUN_GEO", "NO_MUN", "NO_MUN_MIN", "SG_UF"),
    _dimension("isic_cuci", ["co_isic_secao", "co_cuci_grupo"], "CO_ISIC_SECAO", "NO_ISIC_SECAO", "CO_CUCI_GRUPO", "NO_CUCI_GRUPO"),
    _dimension("nbm", ["co_nbm"], "CO_NBM", "NO_NBM"),
    _dimension("ncm_ppe", ["co_ppe"], "CO_PPE", "NO_PPE", "NO_PPE_MIN", "NO_PPE_ING"),
    _dimension("ncm_ppi", ["co_ppi"], "CO_PPI", "NO_PPI", "NO_PPI_MIN", "NO_PPI_ING"),
    _dimension("ncm_fat_agreg", ["co_fat_agreg"], "CO_FAT_AGREG", "NO_FAT_AGREG", "NO_FAT_AGREG_GP"),
    # One key column although an old code may lead to several new ones: the latest pair is kept.
    _dimension("nbm_ncm", ["co_nbm"], "CO_NBM", "CO_NCM"),
    _dimension(
        "ncm_sh", ["co_sh6"],
        "CO_SH6", "NO_SH6_POR", "NO_SH6_ESP", "NO_SH6_ING",
        "CO_SH4", "NO_SH4_POR", "NO_SH4_ESP", "NO_SH4_ING",
        "CO_SH2", "NO_SH2_POR", "NO_SH2_ESP", "NO_SH2_ING",
        "CO_NCM_SECROM", "NO_SEC_POR", "NO_SEC_ESP", "NO_SEC_ING",
    ),
    _dimension(
        "ncm_cgce", ["co_cgce_n3"],
        "CO_CGCE_N3", "NO_CGCE_N3", "NO_CGCE_N3_ING", "NO_CGCE_N3_ESP",
        "CO_CGCE_N2", "NO_CGCE_N2", "NO_CGCE_N2_ING", "NO_CGCE_N2_ESP",
        "CO_CGCE_N1", "NO_CGCE_N1", "NO_CGCE_N1_ING", "NO_CGCE_N1_ESP",
    ),
    _dimension(
        "ncm_cuci", ["co_cuci_item"],
        "CO_CUCI_ITEM", "NO_CUCI_ITEM", "CO_CUCI_SUB", "NO_CUCI_SUB", "CO_CUCI_GRUPO", "NO_CUCI_GRUPO",
        "CO_CUCI_DIVISAO", "NO_CUCI_DIVISAO", "CO_CUCI_SEC", "NO_CUCI_SEC",
    ),
    _dimension(
        "ncm_isic", ["co_isic_classe"],
        "CO_ISIC_CLASSE", "NO_ISIC_CLASSE", "NO_ISIC_CLASSE_ING", "NO_ISIC_CLASSE_ESP",
        "CO_ISIC_GRUPO", "NO_ISIC_GRUPO", "NO_ISIC_GRUPO_ING", "NO_ISIC_GRUPO_ESP",
        "CO_ISIC_DIVISAO", "NO_ISIC_DIVISAO", "NO_ISIC_DIVISAO_ING", "NO_ISIC_DIVISAO_ESP",
        "CO_ISIC_SECAO", "NO_ISIC_SECAO", "NO_ISIC_SECAO_ING", "NO_ISIC_SECAO_ESP",
    ),
    _dimension(
        "ncm", ["co_ncm"],
        "CO_NCM", "NO_NCM_POR", "NO_NCM_ESP", "NO_NCM_ING", "CO_UNID", "CO_SH6", "CO_PPE", "CO_PPI",
        "CO_FAT_AGREG", "CO_CUCI_ITEM", "CO_CGCE_N3", "CO_SIIT", "CO_ISIC_CLASSE", "CO_EXP_SUBSET",
    ),
    _dimension("pais_bloco", ["co_pais", "co_bloco"], "CO_PAIS", "CO_BLOCO", "NO_BLOCO", "NO_BLOCO_ING", "NO_BLOCO_ESP"),
]

MONTH = renamed({"CO_ANO": "ano", "CO_MES": "mes"}, "int")


def _measures(*sources: str):
    return same_name(*sources, type_name="bigint")


def _national(name: str, *measures: str) -> TableSpec:
    return TableSpec(
        name,
        ["ano", "mes", "co_ncm", "co_pais", "sigla_uf_ncm", "co_via", "co_urf"],
        [
            *MONTH,
            *_text("CO_NCM", "CO_UNID", "CO_PAIS"),
            *renamed({"SG_UF_NCM": "sigla_uf_ncm"}, trim=True),
            *_text("CO_VIA", "CO_URF"),
            *_measures("QT_ESTAT", "KG_LIQUIDO", "VL_FOB", *measures),
        ],
        partition_by=["ano", "mes"],
    )


def _municipal(name: str) -> TableSpec:
    return TableSpec(
        name,
        ["ano", "mes", "co_sh4", "co_pais", "sigla_uf_mun", "co_mun"],
        [
            *MONTH,
            *renamed({"SH4": "co_sh4"}, trim=True),
            *_text("CO_PAIS"),
            *renamed({"SG_UF_MUN": "sigla_uf_mun"}, trim=True),
            *_text("CO_MUN"),
            *_measures("KG_LIQUIDO", "VL_FOB"),
        ],
        partition_by=["ano", "mes"],
    )


FACTS = [
    _national("exp"),
    _national("imp", "VL_FRETE", "VL_SEGURO"),
    _municipal("exp_mun"),
    _municipal("imp_mun"),
]

TRADE_TABLES = DIMENSIONS + FACTS
