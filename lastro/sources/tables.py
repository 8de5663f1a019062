"""The tables the operators read, and how a raw ERP table becomes one of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Source column -> column used by the operators, per table.
ERP_COLUMNS: dict[str, dict[str, str]] = {
    "Vendas": {
        "Empresa_ven": "empresa",
        "Obra_ven": "obra",
        "Num_Ven": "num_venda",
        "Data_Ven": "data_venda",
        "DataCad_Ven": "data_cadastro",
        "Status_ven": "status",
        "Cliente_Ven": "cliente",
        "ValorTot_Ven": "valor_total",
        "Acrescimo_Ven": "acrescimo",
        "Desconto_Ven": "desconto",
        "DataCessao_Ven": "data_cessao",
    },
    "VendasRecebidas": {
        "Empresa_vrec": "empresa",
        "Obra_VRec": "obra",
        "Num_VRec": "num_venda",
        "Data_VRec": "data_venda",
        "DataCad_Vrec": "data_cadastro",
        "Status_Vrec": "status",
        "Cliente_VRec": "cliente",
        "ValorTot_VRec": "valor_total",
        "Acrescimo_VRec": "acrescimo",
        "Desconto_VRec": "desconto",
    },
    "Obras": {
        "Empresa_obr": "empresa",
        "cod_obr": "obra",
        "cid_obr": "cidade_obra",
        "descr_obr": "obra_nome",
        "CodGrupo_obr": "grupo",
    },
    "Empresas": {"Codigo_emp": "empresa", "Desc_emp": "empresa_nome"},
    "GruposDeObra": {"Codigo_cger": "codigo", "desc_cger": "descricao"},
    "ItensVenda": {
        "Empresa_itv": "empresa",
        "Obra_itv": "obra",
        "NumVend_Itv": "num_venda",
        "Produto_itv": "produto",
        "CodPerson_itv": "unidade",
    },
    "ItensRecebidas": {
        "Empresa_itr": "empresa",
        "Obra_itr": "obra",
        "NumVend_itr": "num_venda",
        "Produto_itr": "produto",
        "CodPerson_itr": "unidade",
    },
    "UnidadePer": {
        "Empresa_unid": "empresa",
        "Obra_unid": "obra",
        "Prod_unid": "produto",
        "NumPer_unid": "unidade",
        "identificador_unid": "identificador",
        "Vendido_unid": "vendido",
    },
    "PrdSrv": {"NumProd_psc": "produto", "Descricao_psc": "produto_nome", "Status_psc": "status"},
    "Pessoas": {"cod_pes": "cliente", "Nome_pes": "nome", "cpf_pes": "cpf", "Email_pes": "email"},
    "PesTel": {"pes_tel": "cliente", "ddd_tel": "ddd", "fone_tel": "fone"},
    "OcorrenciaVinculo": {
        "Empresa_ocv": "empresa",
        "NumDoc_ocv": "documento",
        "NumOco_ocv": "ocorrencia",
        "Status_ocv": "status",
    },
    "VendaHist": {
        "Empresa_vhist": "empresa",
        "Obra_vhist": "obra",
        "NumVend_vhist": "num_venda",
        "Num_vhist": "num_hist",
        "TipoMnt_vhist": "tipo_mnt",
        "DataMnt_vhist": "data_mnt",
        "DataAprovacao_vhist": "data_aprovacao",
        "NumNovaVend_vhist": "num_nova",
    },
    "VendaDistrato": {
        "Empresa_vdd": "empresa",
        "Obra_vdd": "obra",
        "NumVend_vdd": "num_venda",
        "Num_vdd": "num_distrato",
        "TipoAditivo_vdd": "tipo_aditivo",
        "StatusAprov_vdd": "status_aprov",
        "TipoDistrato_vdd": "tipo_distrato",
        "CategDistrato_vdd": "categoria",
        "DataCad_vdd": "data_cad",
        "DataAprov_vdd": "data_aprov",
    },
    "CategoriasDeDistrato": {"Codigo_cd": "categoria", "Desc_cd": "descricao"},
    "ContasReceber": {
        "Empresa_prc": "empresa",
        "Obra_Prc": "obra",
        "NumVend_prc": "num_venda",
        "NumParc_Prc": "num_parcela",
        "NumParcGer_Prc": "num_parcela_geral",
        "Tipo_Prc": "tipo",
        "Data_Prc": "vencimento",
    },
    "ContasReceberCalc": {
        "Empresa_crc": "empresa",
        "Obra_crc": "obra",
        "NumVend_crc": "num_venda",
        "NumParc_crc": "num_parcela",
        "NumParcGer_crc": "num_parcela_geral",
        "Tipo_crc": "tipo",
        "ValParcela_crc": "val_parcela",
        "ValPrincipal_crc": "val_principal",
        "ValJurosComp_crc": "val_juros",
        "ValCorrecao_crc": "val_correcao",
        "ValJuroAtraso_crc": "val_juro_atraso",
        "ValMultaAtraso_crc": "val_multa_atraso",
    },
    "Recebidas": {
        "Empresa_rec": "empresa",
        "Obra_rec": "obra",
        "NumVend_rec": "num_venda",
        "NumParc_Rec": "num_parcela",
        "NumParcGer_Rec": "num_parcela_geral",
        "Tipo_rec": "tipo",
        "Data_Rec": "pago_em",
        "DataVenci_Rec": "vencimento",
        "DataCad_Rec": "cadastrado_em",
        "ValorConf_Rec": "principal",
        "VlJurosParcConf_Rec": "juros_parcela",
        "VlCorrecaoConf_Rec": "correcao",
        "VlAcresConf_Rec": "acrescimo",
        "VlTaxaBolConf_Rec": "taxa_boleto",
        "VlMultaConf_Rec": "multa",
        "VlJurosConf_Rec": "juros_atraso",
        "VlCorrecaoAtrConf_Rec": "correcao_atraso",
        "VlDescontoConf_Rec": "desconto",
        "ValDescontoCustaConf_Rec": "desconto_custa",
        "ValDescontoImpostoConf_Rec": "desconto_imposto",
        "ValDescontoCondicionalConf_rec": "desconto_condicional",
    },
}

_DATES = {
    "data_venda", "data_cadastro", "data_cessao", "data_mnt", "data_aprovacao",
    "data_cad", "data_aprov", "vencimento", "pago_em", "cadastrado_em",
}


_TABLE_OF_FIELD = {
    "sales_live": "Vendas",
    "sales_archived": "VendasRecebidas",
    "developments": "Obras",
    "companies": "Empresas",
    "groups": "GruposDeObra",
    "items_live": "ItensVenda",
    "items_archived": "ItensRecebidas",
    "units": "UnidadePer",
    "products": "PrdSrv",
    "people": "Pessoas",
    "phones": "PesTel",
    "occurrences": "OcorrenciaVinculo",
    "history": "VendaHist",
    "cancellations": "VendaDistrato",
    "categories": "CategoriasDeDistrato",
    "receivables": "ContasReceber",
    "valuations": "ContasReceberCalc",
    "receipts": "Recebidas",
}


class Erp:
    """The source tables as attributes, columns as in ``ERP_COLUMNS``.

    A table is opened when it is first asked for, so a query lists and opens only
    the tables it reads.
    """

    def __init__(self, **readers: Callable[[], DataFrame]) -> None:
        unknown = set(readers) - set(_TABLE_OF_FIELD)
        if unknown:
            raise ValueError(f"not source tables: {sorted(unknown)}")
        self._readers = readers
        self._frames: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        readers = self.__dict__.get("_readers", {})
        if name not in readers:
            raise AttributeError(name)
        if name not in self._frames:
            self._frames[name] = readers[name]()
        return self._frames[name]

    def replace(self, **frames: DataFrame) -> Erp:
        """The same tables with some of them exchanged."""
        return Erp(**{**self._readers, **{name: (lambda df=df: df) for name, df in frames.items()}})


def rename_erp(df: DataFrame, table: str) -> DataFrame:
    """Raw source columns to operator names; date-times keep their day only."""
    by_lower = {c.lower(): c for c in df.columns}
    wanted = ERP_COLUMNS[table]
    return df.select(
        *(
            (F.col(by_lower[src.lower()]).cast("date") if name in _DATES else F.col(by_lower[src.lower()])).alias(name)
            for src, name in wanted.items()
            if src.lower() in by_lower
        )
    )


def read_erp(spark: SparkSession, root: str) -> Erp:
    """Parquet directories named after the source tables."""

    def reader(table: str) -> Callable[[], DataFrame]:
        return lambda: rename_erp(spark.read.parquet(f"{root.rstrip('/')}/{table}"), table)

    return Erp(**{field: reader(table) for field, table in _TABLE_OF_FIELD.items()})
