"""Grouped risk tables.

Every table starts from one partially aggregated ``groupBy``; several groupings of
the same rows share one pre-aggregation and then use grouping sets on it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.functions.lookup import lookup_join
from riskframe.functions.numeric import count_of, np_round, safe_ratio
from riskframe.functions.quantiles import exact_quantiles
from riskframe.functions.risk import band
from riskframe.functions.timeparts import day_order
from riskframe.schema import CRIME, DAY_NAMES, LABEL, LETHAL_WEAPONS, PLACE, SHIFT, TIME, WEAPON
from riskframe.session import checkpointed

# --- fixed values: alert thresholds in percent and wording ------------------------
CITY_ALERT = (15, 10, ("ALERTA MÁXIMO", "ATENÇÃO", "SITUAÇÃO NORMAL"))
GROUP_ALERT = (20, 10, ("alto", "medio", "baixo"))
CRIME_ALERT = (50, 25, ("alto", "medio", "baixo"))
# --- end of fixed values -----------------------------------------------------------

TOTAL, HIGH, RATE = "total", "alto_risco", "taxa_risco"


def _lethal() -> Column:
    return F.col(WEAPON).isin(LETHAL_WEAPONS)


def risk_by(df: DataFrame, keys: list[str], extra: dict[str, Column] | None = None) -> DataFrame:
    """Count, high-risk count and rate per key; rows with a null key are left out."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    aggs = {
        TOTAL: F.count(F.lit(1)),
        HIGH: F.sum(F.col(LABEL).cast("long")),
        RATE: F.avg(LABEL),
        **(extra or {}),
    }
    return df.where(present).groupBy(*keys).agg(*[a.alias(n) for n, a in aggs.items()])


def rounded(df: DataFrame, columns: list[str], places: int) -> DataFrame:
    return df.withColumns({c: np_round(F.col(c), places) for c in columns})


def ranked(df: DataFrame, by: str, keys: list[str], top: int | None = None) -> DataFrame:
    out = df.orderBy(F.col(by).desc(), *keys)
    return out if top is None else out.limit(top)


def overall_kpis(df: DataFrame) -> DataFrame:
    sums = df.agg(F.count(F.lit(1)).alias(TOTAL), count_of(F.col(LABEL) == 1).alias(HIGH))
    rate = safe_ratio(F.col(HIGH), F.col(TOTAL)) * 100
    high, middle, names = CITY_ALERT
    return sums.select(TOTAL, HIGH, np_round(rate, 6).alias("taxa_pct"), band(rate, high, middle, names).alias("alerta"))


def group_alerts(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Rates and mean score per key, rounded to 2 places before the alert band is chosen."""
    high, middle, names = GROUP_ALERT
    out = risk_by(df, [key], {"score_medio": F.avg("risk_score")})
    out = rounded(out, [RATE, "score_medio"], 2)
    out = out.withColumn("alerta", band(F.col(RATE) * 100, high, middle, names))
    return ranked(out, RATE, [key], top)


def patrol_priority(df: DataFrame, top: int = 5) -> DataFrame:
    out = risk_by(df, [PLACE], {"armas": count_of(_lethal())})
    return ranked(out, RATE, [PLACE], top).select(PLACE, np_round(F.col(RATE) * 100, 6).alias("risco_pct"), "armas")


def weapon_pivot(df: DataFrame, weapons: list[str] = LETHAL_WEAPONS) -> DataFrame:
    """Incident counts per place and weapon, missing pairs 0."""
    counts = (
        df.where(F.col(PLACE).isNotNull() & F.col(WEAPON).isNotNull())
        .groupBy(PLACE)
        .pivot(WEAPON, weapons)
        .agg(F.count(F.lit(1)))
    )
    return counts.na.fill(0).orderBy(PLACE)


def risk_by_weekday(df: DataFrame) -> DataFrame:
    out = risk_by(df, ["dia_semana"])
    return out.withColumn("taxa_risco_pct", F.col(RATE) * 100).orderBy(day_order(F.col("dia_semana")))


def risk_by_shift(df: DataFrame) -> DataFrame:
    out = risk_by(df, [SHIFT], {"armas_letais": count_of(_lethal())})
    return out.withColumn("taxa_risco_pct", F.col(RATE) * 100).orderBy(SHIFT)


def shift_metrics(df: DataFrame) -> DataFrame:
    means = {"media_suspeitos": F.avg("quantidade_suspeitos"), "media_vitimas": F.avg("quantidade_vitimas")}
    out = rounded(risk_by(df, [SHIFT], means), [RATE, *means], 2)
    return out.withColumn("taxa_risco_pct", np_round(F.col(RATE) * 100, 1)).orderBy(SHIFT)


def crime_risk_rank(df: DataFrame, top: int = 8) -> DataFrame:
    high, middle, names = CRIME_ALERT
    out = rounded(
        risk_by(df, [CRIME], {"media_suspeitos": F.avg("quantidade_suspeitos")}), [RATE, "media_suspeitos"], 2
    )
    pct = F.col(RATE) * 100
    return ranked(out.withColumns({"taxa_risco_pct": pct, "alerta": band(pct, high, middle, names)}), RATE, [CRIME], top)


def top_rates(df: DataFrame, key: str, top: int, above: float | None = None) -> DataFrame:
    """The keys with the highest rate; with ``above``, only those of them beyond it."""
    out = ranked(risk_by(df, [key]), RATE, [key], top).select(key, RATE)
    return out if above is None else out.where(F.col(RATE) > above)


def risk_cells(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per combination of ``keys`` with the time range, computed once.

    The few cells serve every table over one of the keys without another scan.
    """
    times = [F.min(TIME).alias("inicio"), F.max(TIME).alias("fim"), F.count(TIME).alias("com_data")] if TIME in df.columns else []
    sums = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(LABEL).cast("long")).alias("pos"), *times)
    return checkpointed(sums)


def top_rates_of_cells(cells: DataFrame, key: str, top: int, above: float | None = None) -> DataFrame:
    """``top_rates`` from ``risk_cells``."""
    sums = cells.where(F.col(key).isNotNull()).groupBy(key).agg((F.sum("pos") / F.sum("n")).alias(RATE))
    out = ranked(sums, RATE, [key], top)
    return out if above is None else out.where(F.col(RATE) > above)


def risk_statistics(df: DataFrame) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("total_ocorrencias"),
        F.sum(F.col(LABEL).cast("long")).alias("total_alto_risco"),
        np_round(F.avg(LABEL), 6).alias("taxa_risco_geral"),
        F.count_distinct(PLACE).alias("bairros_unicos"),
        F.min(TIME).alias("inicio"),
        F.max(TIME).alias("fim"),
    )


def place_summary(df: DataFrame) -> DataFrame:
    means = {"media_suspeitos": F.avg("quantidade_suspeitos"), "media_vitimas": F.avg("quantidade_vitimas")}
    out = rounded(risk_by(df, [PLACE], means), [RATE, *means], 3)
    return ranked(out, RATE, [PLACE])


def temporal_patterns(df: DataFrame) -> DataFrame:
    """Rates by shift, weekday and hour in one frame, from one pass over the rows."""
    keys = [SHIFT, "dia_semana", "hora"]
    cells = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum(F.col(LABEL).cast("long")).alias("pos"))
    columns = [F.col(k) for k in keys]
    sums = cells.groupingSets([[c] for c in columns], *columns).agg(
        F.sum("n").alias(TOTAL), F.sum("pos").alias(HIGH), F.grouping_id().alias("gid")
    )
    labels = {3: "turno", 5: "dia_semana", 6: "hora"}  # grouping_id: 1 bits are the unused keys
    kind = F.coalesce(*[F.when(F.col("gid") == g, name) for g, name in labels.items()])
    key = F.coalesce(*[F.when(F.col("gid") == g, F.col(name).cast("string")) for g, name in labels.items()])
    return (
        sums.select(
            kind.alias("padrao"),
            key.alias("chave"),
            TOTAL,
            HIGH,
            np_round(F.col(HIGH) / F.col(TOTAL), 3).alias(RATE),
        )
        .where(F.col("chave").isNotNull())
        .orderBy("padrao", "chave")
    )


def data_quality(df: DataFrame) -> DataFrame:
    """Missing values per column (one pass), data types and warnings."""
    types = dict(df.dtypes)
    counts = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[count_of(F.col(c).isNull()).alias(c) for c in df.columns],
    )
    warnings = []
    if LABEL not in df.columns:
        warnings.append("Variável target 'risco_alto' não encontrada")
    if TIME not in df.columns:
        warnings.append("Coluna de data não encontrada")
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("coluna"), F.lit(types[c]).alias("tipo"), F.col(c).alias("ausentes"))
            for c in df.columns
        ]
    )
    pct = np_round(safe_ratio(F.col("ausentes"), F.col("_n")) * 100, 1)
    return counts.select("_n", F.explode(rows).alias("r")).select("_n", "r.*").select(
        "coluna",
        "tipo",
        F.col("_n").alias("total_linhas"),
        "ausentes",
        F.when(F.col("ausentes") > 0, F.format_string("%.1f%%", pct)).alias("ausentes_pct"),
        F.lit("warning" if warnings else "ok").alias("status"),
        F.lit("; ".join(warnings)).alias("avisos"),
    )


def describe(df: DataFrame, texts: list[str], numbers: list[str]) -> DataFrame:
    """Count/unique/top/freq of text columns; count, moments and quartiles of numbers."""
    pairs = F.array(*[F.struct(F.lit(c).alias("coluna"), F.col(c).alias("v")) for c in texts])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").where(F.col("v").isNotNull())
    frequencies = values.groupBy("coluna", "v").agg(F.count(F.lit(1)).alias("n"))
    empty = {c: F.lit(None).cast("double") for c in ("media", "desvio", "minimo", "q25", "q50", "q75", "maximo")}
    text_rows = frequencies.groupBy("coluna").agg(
        F.sum("n").alias("n"),
        F.count(F.lit(1)).alias("distintos"),
        F.min_by("v", F.struct(-F.col("n"), F.col("v"))).alias("mais_comum"),
        F.max("n").alias("frequencia"),
    ).withColumns(empty)

    quartiles = exact_quantiles(df, numbers, [0.25, 0.5, 0.75])
    moments = df.agg(
        *[
            F.struct(
                F.lit(c).alias("coluna"),
                F.count(c).alias("n"),
                F.lit(None).cast("long").alias("distintos"),
                F.lit(None).cast("string").alias("mais_comum"),
                F.lit(None).cast("long").alias("frequencia"),
                np_round(F.avg(c), 6).alias("media"),
                np_round(F.stddev_samp(F.col(c).cast("double")), 6).alias("desvio"),
                np_round(F.min(c).cast("double"), 6).alias("minimo"),
                *[
                    np_round(F.lit(q).cast("double"), 6).alias(name)
                    for name, q in zip(("q25", "q50", "q75"), quartiles[c])
                ],
                np_round(F.max(c).cast("double"), 6).alias("maximo"),
            ).alias(f"c{i}")
            for i, c in enumerate(numbers)
        ]
    )
    number_rows = moments.select(
        F.explode(F.array(*[f"c{i}" for i in range(len(numbers))])).alias("r")
    ).select("r.*")
    return text_rows.unionByName(number_rows).orderBy("coluna")


def risk_pattern_stats(df: DataFrame) -> DataFrame:
    """Overall score figures, and mean score with count by place, shift and crime."""
    keys = [PLACE, SHIFT, CRIME]
    score = F.col("risk_score")
    cells = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(score).alias("s"),
        count_of(score >= 0.7).alias("high"),
        count_of(score <= 0.3).alias("low"),
    )
    columns = [F.col(k) for k in keys]
    sums = cells.groupingSets([[], *[[c] for c in columns]], *columns).agg(
        *[F.sum(c).alias(c) for c in ("n", "s", "high", "low")], F.grouping_id().alias("gid")
    )
    mean = F.col("s") / F.col("n")

    def row(group, key, value):
        return F.struct(F.lit(group).alias("grupo"), key.alias("chave"), value.alias("valor"))

    overall = F.array(
        row("geral", F.lit("avg_risk_score"), np_round(mean, 9)),
        row("geral", F.lit("high_risk_percentage"), np_round(F.col("high") / F.col("n") * 100, 6)),
        row("geral", F.lit("low_risk_percentage"), np_round(F.col("low") / F.col("n") * 100, 6)),
    )
    one = {3: PLACE, 5: SHIFT, 6: CRIME}
    by_key = F.coalesce(
        *[F.when(F.col("gid") == g, F.array(row(k, F.col(k), np_round(mean, 3)))) for g, k in one.items()]
    )
    rows = F.when(F.col("gid") == 7, overall).otherwise(by_key)
    return (
        sums.where(F.col("n") > 0)
        .select(F.explode(rows).alias("r"), "n")
        .select("r.*", "n")
        .where(F.col("chave").isNotNull())
        .orderBy("grupo", "chave")
    )


def heatmap(df: DataFrame, x: str = "hora", y: str = "dia_semana", value: str = LABEL) -> DataFrame:
    """Mean of a value over two keys, long form."""
    return (
        df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(y, x)
        .agg(F.avg(value).alias("media"))
    )


def heatmap_by_hour(df: DataFrame, fill: float | None = None) -> DataFrame:
    """Weekday rows (Monday first) by 24 hour columns."""
    hours = list(range(24))
    wide = df.where(F.col("dia_semana").isin(DAY_NAMES)).groupBy("dia_semana").pivot("hora", hours).agg(F.avg(LABEL))
    wide = wide.select("dia_semana", *[np_round(F.col(str(h)), 6).alias(f"h{h:02d}") for h in hours])
    if fill is not None:
        wide = wide.na.fill(fill)
    return wide.orderBy(day_order(F.col("dia_semana")))


def risk_by_hour_and_day(df: DataFrame) -> DataFrame:
    """Risk percent by hour and by weekday from one pass."""
    out = temporal_patterns(df).where(F.col("padrao").isin("hora", "dia_semana"))
    return out.select("padrao", "chave", np_round(F.col(HIGH) / F.col(TOTAL) * 100, 6).alias("risco_pct"))


def shift_counts(df: DataFrame) -> DataFrame:
    return df.where(F.col(SHIFT).isNotNull()).groupBy(SHIFT).agg(F.count(F.lit(1)).alias("n")).orderBy(SHIFT)


def daily_evolution(df: DataFrame, days: int = 30) -> DataFrame:
    """Daily rate of the last ``days`` days that have incidents."""
    daily = risk_by(df.withColumn("dia", F.to_date(TIME)), ["dia"])
    last = daily.orderBy(F.col("dia").desc()).limit(days)
    return last.orderBy("dia").select("dia", np_round(F.col(RATE) * 100, 6).alias("risco_pct"))


def monthly_rate(df: DataFrame) -> DataFrame:
    return risk_by(df, ["ano_mes"]).orderBy("ano_mes").select("ano_mes", np_round(F.col(RATE), 6).alias(RATE))


def top_places_and_crimes(df: DataFrame, places: int = 10, crimes: int = 12) -> DataFrame:
    cells = risk_cells(df, [PLACE, CRIME])
    parts = [
        top_rates_of_cells(cells, key, n).select(
            F.lit(key).alias("grupo"), F.col(key).alias("chave"), np_round(F.col(RATE) * 100, 1).alias("risco_pct")
        )
        for key, n in ((PLACE, places), (CRIME, crimes))
    ]
    return parts[0].unionByName(parts[1])


def weapon_counts(df: DataFrame, top: int = 8) -> DataFrame:
    counts = df.where(F.col(WEAPON).isNotNull()).groupBy(WEAPON).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.col("n").desc(), WEAPON).limit(top).withColumn("letal", _lethal().cast("int"))


def correlation(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair over rows where both are present; long form.

    A constant column has no correlation (null), as has a pair of fewer than three columns.
    """
    names = [c for c in columns if c in df.columns]
    if len(names) <= 2:
        names = []
    aggs = []
    for i, a in enumerate(names):
        for b in names[i:]:
            both = F.col(a).isNotNull() & F.col(b).isNotNull()
            x, y = F.when(both, F.col(a).cast("double")), F.when(both, F.col(b).cast("double"))
            spread = F.nullif(F.stddev_pop(x) * F.stddev_pop(y), F.lit(0.0))
            aggs.append((a, b, F.covar_pop(x, y) / spread))
    schema = "a string, b string, correlacao double"
    if not aggs:
        return df.sparkSession.createDataFrame([], schema)
    wide = df.agg(*[c.alias(f"p{i}") for i, (_, _, c) in enumerate(aggs)])
    cells = [
        F.struct(F.lit(p).alias("a"), F.lit(q).alias("b"), np_round(F.col(f"p{i}"), 6).alias("correlacao"))
        for i, (a, b, _) in enumerate(aggs)
        for p, q in ({(a, b), (b, a)})
    ]
    return wide.select(F.explode(F.array(*cells)).alias("c")).select("c.*").orderBy("a", "b")


def histogram(df: DataFrame, column: str, bins: int = 30, group: str | None = None, level: float | None = None) -> DataFrame:
    """Equal-width bins between the column's extremes (of each group), last bin closed.

    With ``level``, every row also carries that quantile of the column.
    """
    keys = [group] if group else []
    values = df.where(F.col(column).isNotNull())
    low, high = F.min(column).cast("double"), F.max(column).cast("double")
    limits = values.groupBy(*keys).agg(low.alias("lo"), high.alias("hi")).where(F.col("lo").isNotNull())
    width = F.when(F.col("hi") > F.col("lo"), (F.col("hi") - F.col("lo")) / bins).otherwise(F.lit(1.0))
    limits = checkpointed(limits.withColumn("width", width))  # one row per group
    if not group:
        limits, values = limits.withColumn("_all", F.lit(0)), values.withColumn("_all", F.lit(0))
    by = keys or ["_all"]
    placed = lookup_join(values.select(*by, column), limits, by, "inner", spread_by=column)
    number = F.least(F.floor((F.col(column) - F.col("lo")) / F.col("width")), F.lit(bins - 1)).cast("int")
    counts = placed.withColumn("faixa", number).groupBy(*by, "faixa").agg(F.count(F.lit(1)).alias("n"))
    # all bins, also the empty ones
    frame = limits.withColumn("faixa", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))))
    out = frame.join(counts, [*by, "faixa"], "left").select(
        *keys,
        "faixa",
        np_round(F.col("lo") + F.col("width") * F.col("faixa"), 6).alias("inicio"),
        F.coalesce("n", F.lit(0).cast("long")).alias("n"),
    )
    if level is not None:
        cut = exact_quantiles(values, [column], [level])[column][0]
        out = out.withColumn("corte", np_round(F.lit(cut).cast("double"), 6))
    return out.orderBy(*keys, "faixa")


def mean_score_by_place(df: DataFrame, score: str = "risk_score", top: int = 10) -> DataFrame:
    means = df.where(F.col(PLACE).isNotNull()).groupBy(PLACE).agg(np_round(F.avg(score), 6).alias("risco_previsto"))
    return means.orderBy(F.col("risco_previsto").desc(), PLACE).limit(top)
