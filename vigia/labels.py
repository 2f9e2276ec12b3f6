"""Fixed text values that must equal the source system's for right results.

FIXED VALUES — these literals are data, not logic: the warehouse, its views and
the dashboards compare against them byte for byte (accents and case matter).
"""

# Final classification labels.
CONFIRMED = "Confirmado Laboratorial"
DISCARDED = "Descartado"
SUSPECTED = "Suspeito"

# Outcome label counted as a death.
DEATH = "Óbito"

# Constant fills for missing categorical values.
SEX_DEFAULT = "IGNORADO"
RACE_DEFAULT = "NAO INFORMADO"
OUTCOME_DEFAULT = "EM ABERTO"

# Yes / no flag spellings.
YES = "Sim"
NO = "Não"

# Columns dropped on read.
DROPPED_COLUMNS = [
    "source_id", "excluido", "validado",
    "outroBuscaAtivaAssintomatico", "outroTriagemPopulacaoEspecifica", "outroLocalRealizacaoTestagem",
]

# Separator of multi-valued cells.
MULTI_SEPARATOR = ", "

# Vaccination status labels (in CASE order).
VAX_NOT_VACCINATED = "Não Vacinado"
VAX_NOT_INFORMED = "Não Informado/Sem Doses"
VAX_TWO_OR_MORE = "2 ou Mais Doses"
VAX_ONE_OR_OTHER = "1 Dose / Outros"
VAX_NOT_VACCINATED_CODE = 2

# Age bands: (label, low inclusive, high inclusive); None = open end.
AGE_BANDS = [
    ("0-9 anos", None, 9),
    ("10-19 anos", 10, 19),
    ("20-39 anos", 20, 39),
    ("40-59 anos", 40, 59),
    ("60+ anos", 60, None),
]
AGE_UNKNOWN = "Não Informado"

# Laboratory view fallbacks and fixed source id.
TEST_TYPE_FALLBACK = "Tipo Não Informado"
MAKER_FALLBACK = "Fabricante Não Informado"
LAB_SOURCE_ID = 1

# Laboratory names by source id, and the default for unknown ids.
LAB_NAMES = {
    1: "Laboratório Central de Saúde Pública (LACEN)",
    2: "Instituto Adolfo Lutz",
    3: "Fiocruz",
}
LAB_OTHER = "Laboratório Externo/Outro"
LAB_UNAVAILABLE = "Dados Indisponíveis"

# Sentinel meaning "no filter" in the dashboard filters.
ALL = "Todos"

# Repeated test column groups: metric prefixes, slot count.
TEST_METRICS = ["codigoEstadoTeste", "codigoTipoTeste", "codigoFabricanteTeste", "dataColetaTeste"]
TEST_SLOTS = 4
# Result code per slot (declared in the warehouse, used by the positivity table).
TEST_RESULT_METRIC = "codigoResultadoTeste"
POSITIVE_RESULT_CODE = 1

# Column renames from raw names to warehouse names.
TEST_RENAMES = {
    "codigoEstadoTeste": "codigo_estado_teste",
    "codigoTipoTeste": "fk_tipo_teste",
    "codigoFabricanteTeste": "fk_fabricante",
    "dataColetaTeste": "data_coleta",
    "codigoResultadoTeste": "fk_resultado_teste",
}
FACT_RENAMES = {
    "dataNotificacao": "data_notificacao",
    "codigoLaboratorioPrimeiraDose": "nome_fabricante_vacina",
    "dataInicioSintomas": "data_inicio_sintomas",
    "dataEncerramento": "data_encerramento",
    "classificacaoFinal": "classificacao_final",
    "codigoRecebeuVacina": "codigo_recebeu_vacina",
    "codigoDosesVacina": "codigo_doses_vacina",
    "dataPrimeiraDose": "data_primeira_dose",
    "dataSegundaDose": "data_segunda_dose",
    "profissionalSaude": "profissional_saude",
    "profissionalSeguranca": "profissional_seguranca",
    "cbo": "codigo_cbo",
    "codigoEstrategiaCovid": "codigo_estrategia_covid",
}
FACT_COLUMNS = [
    "nome_fabricante_vacina", "id_notificacao", "sexo", "idade", "profissional_saude", "profissional_seguranca",
    "codigo_cbo", "fk_raca_cor", "fk_localidade_residencia",
    "fk_localidade_notificacao", "fk_evolucao_caso", "data_notificacao",
    "data_inicio_sintomas", "data_encerramento", "classificacao_final",
    "codigo_recebeu_vacina", "codigo_doses_vacina", "data_primeira_dose",
    "data_segunda_dose", "codigo_estrategia_covid",
]

# Locality columns: residence group, notification group, warehouse names.
RESIDENCE_PLACE = ["estado", "estadoIBGE", "municipio", "municipioIBGE"]
NOTIFICATION_PLACE = ["estadoNotificacao", "estadoNotificacaoIBGE", "municipioNotificacao", "municipioNotificacaoIBGE"]
PLACE_COLUMNS = ["estado_nome", "estado_uf", "municipio_nome", "codigo_ibge_municipio"]

# Null tokens a pandas CSV read treats as missing by default.
NULL_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
