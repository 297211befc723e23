"""Column names, input schema and fixed domain values."""

from __future__ import annotations

from pyspark.sql import types as T

ID = "id_ocorrencia"
TIME = "data_ocorrencia"
LABEL = "risco_alto"
PLACE = "bairro"
CRIME = "tipo_crime"
WEAPON = "arma_utilizada"
SHIFT = "turno"
MODUS = "descricao_modus_operandi"

RAW_SCHEMA = T.StructType(
    [
        T.StructField(ID, T.LongType()),
        T.StructField(TIME, T.TimestampNTZType()),
        T.StructField(PLACE, T.StringType()),
        T.StructField(CRIME, T.StringType()),
        T.StructField(WEAPON, T.StringType()),
        T.StructField("quantidade_suspeitos", T.DoubleType()),
        T.StructField("quantidade_vitimas", T.DoubleType()),
        T.StructField("idade_suspeito", T.DoubleType()),
        T.StructField("sexo_suspeito", T.StringType()),
        T.StructField("latitude", T.DoubleType()),
        T.StructField("longitude", T.DoubleType()),
        T.StructField("orgao_responsavel", T.StringType()),
        T.StructField("status_investigacao", T.StringType()),
        T.StructField(MODUS, T.StringType()),
    ]
)
REQUIRED = [TIME, PLACE, CRIME, WEAPON]

# Text columns that get a label in place of null (the weapon column is left alone).
FILLED_TEXT = [
    PLACE,
    CRIME,
    "sexo_suspeito",
    "orgao_responsavel",
    "status_investigacao",
    MODUS,
]
# Numeric columns whose nulls become the median of the whole data set.
FILLED_NUMBERS = [
    "quantidade_vitimas",
    "quantidade_suspeitos",
    "idade_suspeito",
    "latitude",
    "longitude",
]

# --- fixed values -----------------------------------------------------------
NOT_INFORMED = "Não Informado"
IGNORED = "Ignorado"
UNKNOWN_SHIFT = "Desconhecido"
ALL_PLACES = "Todos"
ALL_WEAPONS = "Todas"

LETHAL_WEAPONS = ["Arma de Fogo", "Explosivos"]
NIGHT_SHIFTS = ["Noite", "Madrugada"]
SHIFTS = ["Madrugada", "Manhã", "Tarde", "Noite"]
DAY_NAMES = [
    "Monday",
    "Tuesday",
    "Wednesday",
    "Thursday",
    "Friday",
    "Saturday",
    "Sunday",
]

WEAPON_RISK = {
    "Arma de Fogo": 1.0,
    "Explosivos": 1.0,
    "Faca": 0.6,
    "Objeto Contundente": 0.4,
    "Nenhum": 0.1,
    "Não Informado": 0.3,
}
CRIME_RISK = {
    "Homicídio": 0.95,
    "Latrocínio": 0.95,
    "Sequestro": 0.90,
    "Tráfico de Drogas": 0.85,
    "Roubo": 0.80,
    "Estupro": 0.75,
    "Ameaça": 0.40,
    "Violência Doméstica": 0.60,
    "Furto": 0.30,
    "Estelionato": 0.20,
}
SHIFT_RISK = {"Noite": 0.8, "Madrugada": 0.9, "Tarde": 0.6, "Manhã": 0.4}
UNKNOWN_VALUE_RISK = 0.3
UNKNOWN_PLACE_RISK = 0.5
UNKNOWN_TIME_RISK = 0.5
RISK_WEIGHTS = {
    "weapon_risk": 0.30,
    "crime_risk": 0.25,
    "suspect_risk": 0.20,
    "location_risk": 0.15,
    "temporal_risk": 0.10,
}
BAND_EDGES = (0.3, 0.7)
BAND_NAMES = ("Baixo", "Médio", "Alto")

VIOLENT_CRIMES = ["Homicídio", "Latrocínio", "Roubo", "Sequestro", "Tráfico de Drogas"]
BASELINE_CRIMES = VIOLENT_CRIMES + ["Estupro"]
PROTOCOL_CRIMES = ["Homicídio", "Latrocínio", "Sequestro"]

# Spellings that the usual CSV readers take for a missing value.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
# --- end of fixed values ----------------------------------------------------

CLUSTER_NUMBERS = [
    "quantidade_vitimas",
    "quantidade_suspeitos",
    "idade_suspeito",
    "hora",
    "dia_semana_idx",
    "risk_score",
]
CLUSTER_FLAGS = ["arma_letal", "crime_violento", "periodo_noturno"]

MODEL_NUMBERS = [
    "quantidade_vitimas",
    "quantidade_suspeitos",
    "idade_suspeito",
    "hora",
    "dia_semana_idx",
]
MODEL_CATEGORIES = [
    PLACE,
    CRIME,
    "sexo_suspeito",
    SHIFT,
    "orgao_responsavel",
    "status_investigacao",
]
COMPACT_CATEGORIES = [PLACE, CRIME, "sexo_suspeito", SHIFT]
