"""Text lines of the operational summary and the full report.

Each line is a row ``(line_no, text)``; only top-k lists are turned into text.  The
data are read once, into counts per (place, hour, crime).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.numeric import np_round
from riskframe.operators.aggregates import RATE, risk_cells, top_rates_of_cells
from riskframe.schema import CRIME, PLACE

# --- fixed values: wording ------------------------------------------------------
NO_ROWS = "Sem registros no filtro atual."
REPORT_TITLE = "Relatório — Risco Operacional"
NOTES = [
    "Observações:",
    " - Use como insumo para priorização; decisão final é da equipe.",
    " - Limitações: possíveis vieses de registro; revisar anomalias e outliers.",
]
# --- end of fixed values ----------------------------------------------------------


def percent(rate: Column) -> Column:
    return F.format_string("%.1f%%", np_round(rate * 100, 1))


def _line(number: int, frame: DataFrame, text: Column) -> DataFrame:
    return frame.select(F.lit(number).alias("line_no"), text.alias("text"))


KEYS = [PLACE, "hora", CRIME]


def _facts(cells: DataFrame) -> DataFrame:
    return cells.agg(
        F.min("inicio").alias("inicio"),
        F.max("fim").alias("fim"),
        F.coalesce(F.sum("com_data"), F.lit(0)).alias("com_data"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        (F.sum("pos") / F.sum("n")).alias("r"),
    )


def _joined(cells: DataFrame, number: int, prefix: str, key: str, text: Column, top: int = 3) -> DataFrame:
    """One line listing the ``top`` keys by rate."""
    best = top_rates_of_cells(cells, key, top)
    entries = best.agg(F.sort_array(F.collect_list(F.struct((-F.col(RATE)).alias("o"), F.col(key).alias("k"), text.alias("t")))).alias("l"))
    names = F.transform("l", lambda e: e["t"])
    return _line(number, entries.where(F.size("l") > 0), F.concat(F.lit(prefix), F.array_join(names, ", ")))


def _period(prefix: str) -> Column:
    def day(value):
        return F.coalesce(F.date_format(value, "yyyy-MM-dd"), F.lit("—"))

    return F.concat(F.lit(prefix), day("inicio"), F.lit(" → "), day("fim"))


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames).orderBy("line_no")


def summary_lines(df: DataFrame) -> DataFrame:
    cells = risk_cells(df, KEYS)
    if cells.limit(1).count() == 0:
        return df.sparkSession.createDataFrame([(1, NO_ROWS)], "line_no int, text string")
    facts = _facts(cells)
    return _union(
        [
            _line(1, facts, _period("Período analisado: ")),
            _line(2, facts, F.concat(F.lit("Proporção de alto risco: "), percent(F.col("r")))),
            _joined(cells, 3, "Bairros mais críticos: ", PLACE, _with_rate(PLACE)),
            _joined(cells, 4, "Horários mais arriscados (top 3): ", "hora", F.concat(F.col("hora").cast("string"), F.lit("h"))),
            _joined(cells, 5, "Tipos com maior risco: ", CRIME, _with_rate(CRIME)),
        ]
    )


def _with_rate(key: str) -> Column:
    return F.concat(F.col(key), F.lit(" ("), percent(F.col(RATE)), F.lit(")"))


def _listed(cells: DataFrame, first: int, heading: str, key: str, top: int) -> DataFrame:
    """A heading line and one line per key."""
    best = top_rates_of_cells(cells, key, top).agg(
        F.sort_array(F.collect_list(F.struct((-F.col(RATE)).alias("o"), F.col(key).alias("k"), F.col(RATE).alias("r")))).alias("l")
    )
    entries = best.select(F.posexplode("l").alias("i", "e"))
    lines = entries.select(
        (F.lit(first + 1) + F.col("i")).cast("int").alias("line_no"),
        F.concat(F.lit(" - "), F.col("e.k"), F.lit(": "), percent(F.col("e.r"))).alias("text"),
    )
    return _line(first, best.where(F.size("l") > 0), F.lit(heading)).unionByName(lines)


def report_lines(
    df: DataFrame, generated_at: str, metrics: dict[str, float] | None = None, title: str = REPORT_TITLE
) -> DataFrame:
    """Full report; ``metrics`` are model figures that were measured elsewhere."""
    cells = risk_cells(df, KEYS)
    facts = _facts(cells)
    fixed = [(1, title), (2, f"Gerado em: {generated_at}")]
    shown = [(k, v) for k, v in (metrics or {}).items() if v is not None and v == v]
    if shown:
        fixed.append((200, "Desempenho do modelo (teste):"))
        fixed += [(201 + i, f" - {k.upper()}: {v:.3f}") for i, (k, v) in enumerate(shown)]
    fixed += [(300 + i, text) for i, text in enumerate(NOTES)]
    count = F.format_number(F.col("n"), 0)
    return _union(
        [
            df.sparkSession.createDataFrame(fixed, "line_no int, text string"),
            _line(3, facts.where(F.col("com_data") > 0), _period("Período: ")),
            _line(4, facts, F.concat(F.lit("Registros analisados: "), count)),
            _line(
                5,
                facts,
                F.concat(
                    F.lit("Proporção de alto risco (arma/explosivos): "), percent(F.coalesce("r", F.lit(0.0)))
                ),
            ),
            _listed(cells, 10, "Top 5 bairros (maior risco médio):", PLACE, 5),
            _listed(cells, 100, "Top 5 tipos de crime (maior risco médio):", CRIME, 5),
        ]
    )


def recommendation_lines(df: DataFrame, top: int = 3, crime_above: float = 0.3) -> DataFrame:
    """Patrol, hour and protocol recommendations from the highest rates."""
    cells = risk_cells(df, KEYS)
    rate = percent(F.col("e.r"))
    parts = (
        ("Reforço Policial Recomendado", PLACE, None,
         F.concat(F.col("e.k"), F.lit(": Taxa de risco "), rate, F.lit(" - Requer patrulhamento reforçado"))),
        ("Horários Críticos", "hora", None,
         F.concat(F.lpad(F.col("e.k").cast("string"), 2, "0"), F.lit("h: Taxa de risco "), rate, F.lit(" - Aumentar efetivo"))),
        ("Protocolos Especiais", CRIME, crime_above,
         F.concat(F.col("e.k"), F.lit(": Protocolo de alta segurança - Backup obrigatório"))),
    )
    frames = []
    for section, (heading, key, above, text) in enumerate(parts, 1):
        best = top_rates_of_cells(cells, key, top, above).agg(
            F.sort_array(F.collect_list(F.struct((-F.col(RATE)).alias("o"), F.col(key).alias("k"), F.col(RATE).alias("r")))).alias("l")
        )
        frames.append(
            best.select(F.posexplode("l").alias("i", "e")).select(
                (F.lit(section * 10) + F.col("i")).cast("int").alias("line_no"),
                F.lit(heading).alias("secao"),
                text.alias("text"),
            )
        )
    return _union(frames)
