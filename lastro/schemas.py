"""Keys, and the contract every normalised snapshot is cast to."""

from __future__ import annotations

from pyspark.sql import types as T

SALE_KEY = ["empresa", "obra", "num_venda"]
INSTALMENT_KEY = SALE_KEY + ["num_parcela", "num_parcela_geral", "tipo"]
#: The same keys, to group and join by. Spark sorts by the first bytes of a key and compares whole rows only
#: where these are equal, so the columns with the most values stand first.
SALE_ORDER = ["num_venda", "empresa", "obra"]
INSTALMENT_ORDER = SALE_ORDER + INSTALMENT_KEY[3:]
GRAIN_KEY = SALE_KEY + ["cpf_titular", "mes_referencia"]

MONEY = T.DecimalType(18, 4)

# Column names and types of the consumption contract.
CONTRACT = T.StructType(
    [
        T.StructField("empresa", T.StringType()),
        T.StructField("obra", T.StringType()),
        T.StructField("cidade", T.StringType()),
        T.StructField("produto", T.StringType()),
        T.StructField("num_venda", T.StringType()),
        T.StructField("cpf_titular", T.StringType()),
        T.StructField("nome_cliente", T.StringType()),
        T.StructField("telefone", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("titular_principal", T.BooleanType()),
        T.StructField("qtd_compradores", T.LongType()),
        T.StructField("data_recebimento", T.DateType()),
        T.StructField("mes_referencia", T.StringType()),
        T.StructField("valor_principal", MONEY),
        T.StructField("valor_multa", MONEY),
        T.StructField("valor_juros", MONEY),
        T.StructField("valor_custas", MONEY),
        T.StructField("valor_total_recebido", MONEY),
        T.StructField("tipo_parcela", T.StringType()),
        T.StructField("origem_pagamento", T.StringType()),
        T.StructField("flag_antecipacao", T.BooleanType()),
        T.StructField("flag_negociacao", T.BooleanType()),
        T.StructField("flag_vencido", T.BooleanType()),
        T.StructField("qtd_parcelas_pagas", T.LongType()),
        T.StructField("status_cadastro", T.StringType()),
        T.StructField("status_elegibilidade", T.StringType()),
        T.StructField("status_elegibilidade_casas", T.StringType()),
        T.StructField("cupons_casas", T.LongType()),
        T.StructField("flag_cessao", T.BooleanType()),
        T.StructField("flag_contrato_quitado", T.BooleanType()),
        T.StructField("flag_contrato_cedido", T.BooleanType()),
        T.StructField("motivo_bloqueio", T.StringType()),
        T.StructField("cupons_oficiais", T.LongType()),
        T.StructField("flag_contemplado_casa", T.BooleanType()),
        T.StructField("participa_proximos_sorteios", T.BooleanType()),
        T.StructField("data_ultima_atualizacao", T.TimestampNTZType()),
        T.StructField("status_inadimplencia_antes", T.StringType()),
        T.StructField("dias_atraso", T.LongType()),
        T.StructField("qtd_parcelas_vencidas", T.LongType()),
        T.StructField("valor_vencido_antes", MONEY),
        T.StructField("valor_recuperado", MONEY),
        T.StructField("status_apos_pagamento", T.StringType()),
        T.StructField("classificacao_recebimento", T.StringType()),
    ]
)

# Contract columns no snapshot may lack.
MANDATORY = [
    "empresa",
    "obra",
    "num_venda",
    "cpf_titular",
    "mes_referencia",
    "valor_principal",
    "valor_multa",
    "valor_juros",
    "valor_custas",
    "valor_total_recebido",
    "status_cadastro",
    "status_elegibilidade",
]
