"""Exploratory statistics as DataFrame queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atende.functions.rules import MONTHS, WEEKDAYS, half_up, pct, traffic_light
from atende.operators.ranks import row_number_over_all
from atende.operators.scalars import one_row
from atende.plans.kpi.common import mean, n_if, top

def rows() -> Column:
    return F.count(F.lit(1))


def weekday_name(day: str) -> Column:
    return F.element_at(F.array(*[F.lit(d) for d in WEEKDAYS]), F.dayofweek(day))


# --- frequencies and volumes ---------------------------------------------------------

def value_counts(df: DataFrame, *, by: str, limit: int | None = None) -> DataFrame:
    """Frequency and share of each value, most frequent first."""
    counts = df.groupBy(by).agg(rows().alias("nr_linhas"))
    whole = df.agg(rows()).scalar()
    out = counts.select(by, "nr_linhas", pct(F.col("nr_linhas"), whole).alias("pct_total"))
    return top(out, [("nr_linhas", True), (by, False)], limit)


def volume_by_slot(df: DataFrame, *, slot: Column, first: int, last: int, name: str = "nr_faixa") -> DataFrame:
    """Rows per calendar slot (weekday, month, hour); slots without rows count 0."""
    domain = df.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias(name))
    counts = df.groupBy(slot.cast("int").alias(name)).agg(rows().alias("_n"))
    return domain.join(counts, name, "left").select(name, F.coalesce("_n", F.lit(0)).alias("nr_linhas"))


def pivot_hour_weekday(df: DataFrame, *, time: str) -> DataFrame:
    """Hour x weekday matrix of row counts."""
    df = df.filter(F.col(time).isNotNull())
    return pivot_counts(df, [F.hour(time).alias("nr_hora")], weekday_name(time), WEEKDAYS)


def pivot_counts(df: DataFrame, by: Sequence[Column], on: Column, values: Sequence[str]) -> DataFrame:
    """Counts per listed value as columns; one aggregation, no second pass for the values."""
    return df.groupBy(*by).agg(*[n_if(on == v).alias(v.lower()) for v in values])


def weekly_cumulative(df: DataFrame, *, time: str) -> DataFrame:
    """Rows per week (start day) and their running sum; weeks without rows count 0."""
    week = F.to_date(F.date_trunc("week", time))
    counts = df.filter(F.col(time).isNotNull()).groupBy(week.alias("dt_semana")).agg(rows().alias("_n"))
    span = counts.agg(F.min("dt_semana").alias("a"), F.max("dt_semana").alias("b"))
    weeks = span.select(F.explode(F.sequence("a", "b", F.expr("interval 7 days"))).alias("dt_semana"))
    filled = weeks.join(counts, "dt_semana", "left").select("dt_semana", F.coalesce("_n", F.lit(0)).alias("nr_linhas"))
    # One row per week of the calendar: the ordered window stays small.
    running = Window.orderBy("dt_semana").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return filled.withColumn("nr_acumulado", F.sum("nr_linhas").over(running))


def crosstab_row_pct(df: DataFrame, *, by: str, on: str, values: Sequence[str]) -> DataFrame:
    """Share of each listed value of ``on`` inside the rows of ``by`` (100 per row)."""
    return df.groupBy(by).agg(*[pct(n_if(F.col(on) == v), rows()).alias(v.lower()) for v in values])


# --- distributions -------------------------------------------------------------------

def duration_summary(df: DataFrame, *, by: Sequence[str], value: str, trim: float = 0.99) -> DataFrame:
    """Statistics per group after values above the overall ``trim`` quantile are cut off.

    Quantiles are exact; their state is one entry per distinct value (whole seconds here).
    """
    cut = df.agg(F.percentile(value, F.lit(trim))).scalar()
    kept = df.filter(F.col(value) <= cut)
    v = F.col(value)
    return kept.groupBy(*by).agg(
        rows().alias("nr_linhas"),
        mean(v).alias("nr_media"),
        half_up(F.median(v)).alias("nr_mediana"),
        half_up(F.percentile(v, F.lit(0.95))).alias("nr_p95"),
    ).withColumn("nr_corte", half_up(cut))


def box_stats(df: DataFrame, *, by: str, value: str, groups: int | None = 5) -> DataFrame:
    """Quartiles per category, for the most frequent ``groups`` categories."""
    frequent = top(df.groupBy(by).agg(rows().alias("_n")), [("_n", True), (by, False)], groups).select(by)
    v = F.col(value)
    return (
        df.join(frequent, by, "left_semi")
        .groupBy(by)
        .agg(
            F.percentile(v, F.array(*[F.lit(q) for q in (0.25, 0.5, 0.75)])).alias("_q"),
            F.min(v).alias("nr_minimo"),
            F.max(v).alias("nr_maximo"),
        )
        .select(
            by, "nr_minimo",
            *[half_up(F.get("_q", F.lit(i))).alias(f"nr_q{i + 1}") for i in range(3)],
            "nr_maximo",
        )
    )


# --- operational KPIs ----------------------------------------------------------------

def handle_time_vs_goal(calls: DataFrame, *, by: Sequence[str], goal: float = 180.0) -> DataFrame:
    handled = calls.filter((F.col("st_chamada") == "ATENDIDA") & (F.col("nr_duracao_segundos") > 0))
    return handled.groupBy(*by).agg(
        rows().alias("nr_chamadas"), mean("nr_duracao_segundos").alias("nr_tma")
    ).withColumn("fl_na_meta", (F.col("nr_tma") <= goal).cast("smallint"))


def abandon_rate(calls: DataFrame, *, by: Sequence[str]) -> DataFrame:
    gone = n_if(F.col("st_chamada") == "ABANDONADA")
    return calls.groupBy(*by).agg(
        rows().alias("nr_chamadas"), pct(gone, rows()).alias("taxa_abandono")
    ).withColumn("semaforo", traffic_light("taxa_abandono", (5, 10), higher_is_better=False))


def call_sla(calls: DataFrame, *, by: Sequence[str], limit: int = 20, goal: float = 80.0) -> DataFrame:
    """Answered calls that waited at most ``limit`` seconds."""
    answered = calls.filter(F.col("st_chamada") == "ATENDIDA")
    return answered.groupBy(*by).agg(
        rows().alias("nr_atendidas"), pct(n_if(F.col("nr_espera_segundos") <= limit), rows()).alias("sla_pct")
    ).withColumn("fl_na_meta", (F.col("sla_pct") >= goal).cast("smallint"))


def channel_mix_monthly(calls: DataFrame, *, values: Sequence[str]) -> DataFrame:
    kind = F.col("tp_chamada")
    return calls.groupBy(F.month("dt_inicio").alias("nr_mes")).agg(
        *[n_if(kind == v).alias(f"nr_{v.lower()}") for v in values],
        *[pct(n_if(kind == v), n_if(kind.isin(*values))).alias(f"pct_{v.lower()}") for v in values],
    )


# Resolution limits in hours per priority.
TICKET_LIMITS = {"URGENTE": 4, "ALTA": 8, "MEDIA": 24, "BAIXA": 48}


def ticket_sla_by_priority(tickets: DataFrame, limits: dict[str, int] = TICKET_LIMITS) -> DataFrame:
    limit = F.lit(None).cast("int")
    for name, hours in limits.items():
        limit = F.when(F.col("ds_prioridade") == name, hours).otherwise(limit)
    done = tickets.filter("fl_ticket_resolvido = 1").withColumn("limite_h", limit).filter("limite_h is not null")
    inside = n_if(F.col("nr_tempo_resolucao_min") <= F.col("limite_h") * 60)
    return done.groupBy("ds_prioridade", "limite_h").agg(
        rows().alias("nr_total"), inside.alias("nr_dentro_sla"), pct(inside, rows()).alias("sla_pct")
    )


def with_escalation(tickets: DataFrame, interactions: DataFrame) -> DataFrame:
    """Resolved tickets with a 0/1 flag for an escalation among their interactions."""
    raised = (
        interactions.filter(F.col("ds_tipo_interacao") == "ESCALONAMENTO")
        .groupBy("id_ticket")
        .agg(F.lit(1).alias("_esc"))
    )
    return (
        tickets.filter("fl_ticket_resolvido = 1")
        .join(raised, "id_ticket", "left")
        .withColumn("fl_escalonado", F.coalesce("_esc", F.lit(0)))
        .drop("_esc")
    )


def fcr(resolved: DataFrame, *, by: Sequence[str]) -> DataFrame:
    """First-contact resolution: share of resolved tickets that were not escalated."""
    return resolved.groupBy(*by).agg(
        rows().alias("nr_tickets"), pct(n_if(F.col("fl_escalonado") == 0), rows()).alias("fcr_pct")
    )


def executive_kpis(calls: DataFrame, tickets: DataFrame, interactions: DataFrame) -> DataFrame:
    """Six headline numbers with goal status (one row each)."""
    whole = calls.agg(
        half_up(F.avg(F.when((F.col("st_chamada") == "ATENDIDA") & (F.col("nr_duracao_segundos") > 0), F.col("nr_duracao_segundos")))).alias("TMA"),
        pct(n_if(F.col("st_chamada") == "ABANDONADA"), rows()).alias("ABANDONO"),
        pct(n_if((F.col("st_chamada") == "ATENDIDA") & (F.col("nr_espera_segundos") <= 20)), n_if(F.col("st_chamada") == "ATENDIDA")).alias("SLA_CHAMADAS"),
        F.floor(rows() / F.lit(365)).cast("double").alias("CHAMADAS_DIA"),
    )
    sla = ticket_sla_by_priority(tickets).agg(pct(F.sum("nr_dentro_sla"), F.sum("nr_total")))
    first = fcr(with_escalation(tickets, interactions), by=[]).select("fcr_pct")
    one = whole.withColumns({"SLA_TICKETS": sla.scalar(), "FCR": first.scalar()})
    names = ["TMA", "ABANDONO", "SLA_CHAMADAS", "SLA_TICKETS", "FCR", "CHAMADAS_DIA"]
    value, kpi = F.col("nr_valor"), F.col("nm_kpi")
    met = (
        F.when(kpi == "TMA", value <= 180)
        .when(kpi == "ABANDONO", value <= 5)
        .when(kpi == "SLA_CHAMADAS", value >= 80)
        .when(kpi == "SLA_TICKETS", value >= 85)
        .when(kpi == "FCR", value >= 75)
        .otherwise(True)
    )
    return one.unpivot([], names, "nm_kpi", "nr_valor").withColumn("fl_meta", F.coalesce(met, F.lit(False)).cast("smallint"))


# --- operators -----------------------------------------------------------------------

def productivity(calls: DataFrame, operators: DataFrame) -> DataFrame:
    done = calls.filter(F.col("st_chamada") == "ATENDIDA").groupBy("id_operador").agg(rows().alias("nr_chamadas"))
    return done.join(operators.select("id_operador", "nm_operador", "ds_equipe"), "id_operador", "left").withColumn(
        "nm_operador", F.coalesce("nm_operador", F.concat(F.lit("Op "), F.col("id_operador").cast("string")))
    )


def top_n_entities(df: DataFrame, *, by: str, key: str, n: int = 10, best: bool = True) -> DataFrame:
    return top(df, [(by, best), (key, False)], n)


def quality_stats(reviews: DataFrame) -> DataFrame:
    score = F.col("nr_nota_geral")
    return reviews.groupBy("id_operador").agg(
        half_up(F.avg(score), 4).alias("nota_media"),
        half_up(F.stddev_samp(score), 4).alias("nota_std"),
        F.count(score).alias("n_aval"),
    )


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.agg(half_up(F.corr(a, b), 6).alias("correlacao"))


def handle_time_stats(calls: DataFrame) -> DataFrame:
    seconds = F.col("nr_duracao_segundos")
    return calls.filter((F.col("st_chamada") == "ATENDIDA") & (seconds > 0)).groupBy("id_operador").agg(
        mean(seconds).alias("tma_medio"), half_up(F.median(seconds)).alias("tma_mediana"), rows().alias("n_chamadas")
    )


def absence_pct(shifts: DataFrame) -> DataFrame:
    away = n_if(F.col("fl_presente") == 0)
    return shifts.groupBy("id_operador").agg(
        rows().alias("total_dias"), away.alias("dias_ausente"), pct(away, rows()).alias("pct_ausencia")
    )


def absence_weekday(shifts: DataFrame, *, worst: int = 20) -> DataFrame:
    """Absence share per weekday (Monday-Friday) for the operators with the highest share."""
    ids = top(absence_pct(shifts), [("pct_ausencia", True), ("id_operador", False)], worst).select("id_operador")
    day = weekday_name("dt_jornada")
    away = F.col("fl_presente") == 0
    return shifts.join(ids, "id_operador", "left_semi").groupBy("id_operador").agg(
        *[
            F.coalesce(pct(n_if((day == d) & away), n_if(day == d)), F.lit(0.0)).alias(d.lower())
            for d in WEEKDAYS[1:6]
        ]
    )


def minmax_normalize(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """(x - min) / (max - min) per column; a constant column gives 0."""
    span = df.agg(
        *[F.min(c).alias(f"_min_{c}") for c in columns], *[F.max(c).alias(f"_max_{c}") for c in columns]
    )
    ends, out = one_row(span), df
    for c, name in columns.items():
        low, high = ends[f"_min_{c}"], ends[f"_max_{c}"]
        scaled = (F.col(c) - low) / F.nullif((high - low).cast("double"), F.lit(0.0))
        out = out.withColumn(name, half_up(F.when(F.col(c).isNotNull(), F.coalesce(scaled, F.lit(0.0))), 6))
    return out.select(*df.columns, *columns.values())


def operator_matrix(calls: DataFrame, reviews: DataFrame, shifts: DataFrame, operators: DataFrame) -> DataFrame:
    """Operators with productivity, quality and absence; incomplete rows are dropped."""
    return (
        productivity(calls, operators)
        .join(quality_stats(reviews).select("id_operador", "nota_media"), "id_operador", "left")
        .join(absence_pct(shifts).select("id_operador", "pct_ausencia"), "id_operador", "left")
        .na.drop()
    )


def composite_score(matrix: DataFrame, weights: tuple[float, float, float] = (0.4, 0.4, 0.2)) -> DataFrame:
    """p and q raise, absence lowers the score; clipped to 0..1."""
    scaled = minmax_normalize(
        matrix, {"nr_chamadas": "prod_norm", "nota_media": "qual_norm", "pct_ausencia": "aus_norm"}
    )
    p, q, a = weights
    score = p * F.col("prod_norm") + q * F.col("qual_norm") - a * F.col("aus_norm")
    return scaled.withColumn("score_geral", half_up(F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0)), 4))


def quadrant(scored: DataFrame) -> DataFrame:
    """Four labels by the two medians."""
    middle = one_row(scored.agg(F.median("prod_norm").alias("p"), F.median("qual_norm").alias("q")))
    busy, good = F.col("prod_norm") >= middle["p"], F.col("qual_norm") >= middle["q"]
    label = (
        F.when(busy & good, "Estrela").when(busy, "Eficiente").when(good, "Qualificado").otherwise("Desenvolvimento")
    )
    return scored.withColumn("quadrante", label)


def team_summary(scored: DataFrame) -> DataFrame:
    return scored.groupBy("ds_equipe").agg(
        mean("score_geral").alias("score_medio"),
        mean("nr_chamadas").alias("prod_media"),
        mean("nota_media").alias("qual_media"),
        mean("pct_ausencia").alias("abs_media"),
        rows().alias("n_operadores"),
    )


# --- campaigns -----------------------------------------------------------------------

def linear_trend(df: DataFrame, *, x: str, y: str) -> DataFrame:
    """Least-squares line of y over x."""
    return df.agg(
        half_up(F.regr_slope(y, x), 6).alias("inclinacao"), half_up(F.regr_intercept(y, x), 6).alias("intercepto")
    )


def contact_conversion_rates(campaigns: DataFrame) -> DataFrame:
    """Contact and conversion rates, mean per objective (no contacts -> conversion 0)."""
    reached = F.col("nr_contatos_realizados")
    contact = F.lit(100.0) * reached / F.nullif("nr_meta_contatos", F.lit(0))
    sale = F.when(reached > 0, F.lit(100.0) * F.col("nr_conversoes") / F.nullif(reached, F.lit(0))).otherwise(0.0)
    return campaigns.groupBy("ds_objetivo").agg(
        mean(contact).alias("taxa_contato_media"), mean(sale).alias("taxa_conversao_media"), rows().alias("n_campanhas")
    )


def dial_rates(dials: DataFrame, by: Sequence[Column | str]) -> DataFrame:
    """Volume, contact % and conversion % of dials per group."""
    return dials.groupBy(*by).agg(
        rows().alias("nr_total"),
        F.sum("fl_convertido").alias("nr_convertidas"),
        n_if(F.col("st_discagem") == "ATENDIDA").alias("nr_atendidas"),
        pct(n_if(F.col("st_discagem") == "ATENDIDA"), rows()).alias("taxa_contato"),
        pct(F.sum("fl_convertido"), rows()).alias("taxa_conversao"),
    )


def diminishing_returns(dials: DataFrame) -> DataFrame:
    return dial_rates(dials, ["nr_tentativas"])


def _effectiveness() -> Column:
    return half_up(F.lit(100.0) * F.col("nr_conversoes") / F.nullif("nr_meta_contatos", F.lit(0)))


def effectiveness_rank(campaigns: DataFrame) -> DataFrame:
    """Campaigns by conversions over goal with a sequential rank."""
    scored = campaigns.select("id_campanha", "nm_campanha", "ds_objetivo", _effectiveness().alias("efetividade"))
    return row_number_over_all(scored, by="efetividade", tie="id_campanha", name="nr_rank")


def effectiveness_by_objective(campaigns: DataFrame) -> DataFrame:
    scored = campaigns.withColumn("_e", _effectiveness())
    return scored.groupBy("ds_objetivo").agg(
        mean("_e").alias("media"), half_up(F.median("_e")).alias("mediana"), F.max("_e").alias("maximo")
    )


def operator_conversion(dials: DataFrame, operators: DataFrame, *, min_answered: int = 50, n: int = 10) -> DataFrame:
    """Operators with enough answered dials, best conversion first."""
    answered = n_if(F.col("st_discagem") == "ATENDIDA")
    out = (
        dials.groupBy("id_operador")
        .agg(
            rows().alias("total_discagens"),
            F.sum("fl_convertido").alias("conversoes"),
            answered.alias("atendidas"),
            F.coalesce(pct(F.sum("fl_convertido"), answered), F.lit(0.0)).alias("taxa_conversao"),
            pct(answered, rows()).alias("taxa_contato"),
        )
        .filter(F.col("atendidas") >= min_answered)
    )
    best = top(out, [("taxa_conversao", True), ("id_operador", False)], n)
    return best.join(operators.select("id_operador", "nm_operador"), "id_operador", "left")


def dials_by_week(dials: DataFrame) -> DataFrame:
    return dial_rates(dials, [F.to_date(F.date_trunc("week", "dt_ultima_tentativa")).alias("dt_semana")])


def dials_by_hour(dials: DataFrame) -> DataFrame:
    return dial_rates(dials, [F.hour("dt_ultima_tentativa").alias("nr_hora")])


def dials_objective_month(dials: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Objective x month matrix of dial counts."""
    joined = dials.join(campaigns.select("id_campanha", "ds_objetivo"), "id_campanha", "left")
    month = F.month("dt_ultima_tentativa")
    return joined.groupBy("ds_objetivo").agg(
        *[n_if(month == i).alias(name.lower()) for i, name in enumerate(MONTHS, 1)]
    )


# --- digital channels ----------------------------------------------------------------

def channel_comparison(chats: DataFrame, whatsapp: DataFrame, ivr: DataFrame) -> DataFrame:
    """Volume, completion %, satisfaction and minutes of the three channels."""
    def row(name: str, df: DataFrame, done: Column, score: Column, minutes: Column) -> DataFrame:
        return df.agg(
            rows().alias("nr_volume"),
            pct(n_if(done), rows()).alias("pct_conclusao"),
            half_up(score).alias("nr_satisfacao"),
            half_up(minutes).alias("nr_duracao_min"),
        ).select(F.lit(name).alias("ds_canal"), "*")

    wa_minutes = F.when(F.col("nr_duracao_minutos") > 0, F.col("nr_duracao_minutos"))
    return (
        row("CHAT", chats, F.col("st_chat") == "ENCERRADO", F.avg("nr_satisfacao"), F.avg("nr_duracao_minutos"))
        .unionByName(row("WHATSAPP", whatsapp, F.col("st_atendimento") == "RESOLVIDO", F.avg("nr_satisfacao"), F.median(wa_minutes)))
        .unionByName(row("URA", ivr, F.col("fl_transferiu_humano") == 0, F.avg(F.lit(None).cast("double")), F.avg("nr_duracao_segundos") / F.lit(60.0)))
    )


def chat_enrich(chats: DataFrame, messages: DataFrame) -> DataFrame:
    """Message counts per session and the customer's share."""
    counts = messages.groupBy("id_chat").agg(
        rows().alias("nr_mensagens"), n_if(F.col("ds_remetente") == "CLIENTE").alias("msgs_cliente")
    )
    return chats.select("id_chat", "st_chat").join(counts, "id_chat", "left").withColumns(
        {
            "msgs_operador": F.col("nr_mensagens") - F.coalesce("msgs_cliente", F.lit(0)),
            "pct_msgs_cliente": pct(F.col("msgs_cliente"), F.col("nr_mensagens")),
        }
    )


def satisfaction_bins(df: DataFrame) -> DataFrame:
    """Share per satisfaction band (scores up to 2, 3, 4, 5)."""
    score = F.col("nr_satisfacao")
    band = (
        F.when(score <= 2, "Insatisfeito (1-2)").when(score <= 3, "Neutro (3)")
        .when(score <= 4, "Satisfeito (4)").when(score <= 5.1, "Muito Satisfeito (5)")
    )
    scored = df.filter(score.between(0, 5.1)).withColumn("ds_faixa", band)
    return value_counts(scored, by="ds_faixa")


def self_service_rate(ivr: DataFrame, goal: float = 60.0) -> DataFrame:
    return ivr.agg(
        pct(n_if(F.col("fl_transferiu_humano") == 0), rows()).alias("taxa_autoatendimento"),
        pct(n_if(F.col("fl_transferiu_humano") == 1), rows()).alias("taxa_transferencia"),
    ).withColumn("fl_na_meta", (F.col("taxa_autoatendimento") >= goal).cast("smallint"))
