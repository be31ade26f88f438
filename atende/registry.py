"""All registered queries: name -> callable(spark, source folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


from atende.operators import quality
from atende.plans import datasets, explore, views
from atende.plans.kpi import (
    kpi01, kpi02, kpi03, kpi04, kpi05, kpi06, kpi07, kpi08, kpi09, kpi10, kpi11, kpi12,
)
from atende.plans.layers import Lakehouse, lake_for
from atende.plans.period import Period
from atende.plans.silver import SPECS
from atende.queries_base import BASE
from atende.sources.stage import staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# The given events lie in 2024.
MIN_YEAR = 2024
# The bound campaigns know only ATIVA and INATIVA; the latter counts as finished.
SITUATIONS = {
    "ATIVA": ("ATIVA", "EM_ANDAMENTO", "RUNNING"),
    "ENCERRADA": ("ENCERRADA", "FINALIZADA", "CONCLUIDA", "INATIVA"),
}


def register(name: str, build: Callable[[Lakehouse], DataFrame]) -> None:
    """Register a query that is built from the layered tables of the source folder."""
    QUERIES[name] = lambda spark, sf_dir: build(lake_for(spark, sf_dir))


for _name, _fn in BASE.items():
    register(_name, _fn)

for _i, _e in enumerate(SPECS, 1):
    register(f"d{_i}_silver_{_e}", lambda lake, e=_e: lake.silver(e, extended=False)[0])

# --- KPI families --------------------------------------------------------------------
_KPIS: dict[str, tuple[Callable, dict]] = {
    "g1_1": (kpi01.kpi01_base, {"min_year": MIN_YEAR}),
    "g1_2": (kpi01.kpi01_by_channel, {"min_year": MIN_YEAR}),
    "g1_3": (kpi01.kpi01_by_queue, {"min_year": MIN_YEAR}),
    "g1_4": (kpi01.kpi01_queue_rank, {"min_year": MIN_YEAR}),
    "g2_1": (kpi02.kpi02_calls_by_operator_month, {}),
    "g2_2": (kpi02.kpi02_quality_by_operator, {}),
    "g2_3": (kpi02.kpi02_attendance, {}),
    "g2_4": (kpi02.kpi02_consolidated, {}),
    "g2_5": (kpi02.kpi02_ranking, {}),
    "g3_1": (kpi03.kpi03_base, {}),
    "g3_2": (kpi03.kpi03_by_operator, {}),
    "g3_3": (kpi03.kpi03_by_supervisor, {}),
    "g3_4": (kpi03.kpi03_monthly_trend, {}),
    "g4_1": (kpi04.kpi04_base, {}),
    "g4_2": (kpi04.kpi04_daily, {}),
    "g4_3": (kpi04.kpi04_sla_by_priority, {}),
    "g4_4": (kpi04.kpi04_by_category, {}),
    "g4_5": (kpi04.kpi04_status_share, {}),
    "g5_1": (kpi05.kpi05_base, {}),
    "g5_2": (kpi05.kpi05_mttr_category, {}),
    "g5_3": (kpi05.kpi05_mttr_priority, {}),
    "g5_4": (kpi05.kpi05_backlog, {}),
    "g5_5": (kpi05.kpi05_band_share, {}),
    "g5_6": (kpi05.kpi05_fcr_global, {}),
    "g6_1": (kpi06.kpi06_chat_base, {}),
    "g6_2": (kpi06.kpi06_whatsapp_base, {}),
    "g6_3": (kpi06.kpi06_messages_per_session, {"agent": "OPERADOR"}),
    "g6_4": (kpi06.kpi06_unified, {"agent": "OPERADOR"}),
    "g6_5": (kpi06.kpi06_daily_channel, {"agent": "OPERADOR"}),
    "g6_6": (kpi06.kpi06_monthly_trend, {"agent": "OPERADOR"}),
    "g7_1": (kpi07.kpi07_unified, {}),
    "g7_2": (kpi07.kpi07_csat_channel, {}),
    "g7_3": (kpi07.kpi07_monthly_trend, {}),
    "g7_4": (kpi07.kpi07_by_operator, {}),
    "g8_1": (kpi08.kpi08_base, {}),
    "g8_2": (kpi08.kpi08_campaign, {}),
    "g8_3": (kpi08.kpi08_client_campaign, {}),
    "g8_4": (kpi08.kpi08_attempt_bands, {}),
    "g9_1": (kpi09.kpi09_roi, {"situations": SITUATIONS}),
    "g9_2": (kpi09.kpi09_by_situation, {"situations": SITUATIONS}),
    "g9_3": (kpi09.kpi09_rank_by_type, {"situations": SITUATIONS}),
    "g9_4": (kpi09.kpi09_quartiles, {"situations": SITUATIONS}),
    "g10_1": (kpi10.kpi10_base, {}),
    "g10_2": (kpi10.kpi10_attendance, {}),
    "g10_3": (kpi10.kpi10_monthly, {}),
    "g10_4": (kpi10.kpi10_absence_weekday, {}),
    "g11_1": (kpi11.kpi11_base, {}),
    "g11_2": (kpi11.kpi11_daily_occupancy, {}),
    "g11_3": (kpi11.kpi11_intraday, {}),
    "g11_4": (kpi11.kpi11_overload_rank, {}),
    "g11_5": (kpi11.kpi11_weekly_pattern, {}),
    "g11_6": (kpi11.kpi11_peak_hour, {}),
    "g12_1": (kpi12.kpi12_base, {}),
    "g12_2": (kpi12.kpi12_daily, {}),
    "g12_3": (kpi12.kpi12_top_flows, {}),
    "g12_4": (kpi12.kpi12_abandon_points, {}),
    "g12_5": (kpi12.kpi12_monthly_trend, {}),
    "g12_6": (kpi12.kpi12_global, {}),
}
for _id, (_fn, _kw) in _KPIS.items():
    register(f"{_id}_{_fn.__name__}", lambda lake, fn=_fn, kw=_kw: fn(lake, **kw))

register("g11_2_kpi11_daily_occupancy_ties", lambda lake: kpi11.kpi11_daily_occupancy(lake, keep_ties=True))
# One query of each family over a period; the bound orders start in 1992, so the floor cuts some of them.
SINCE_YEAR = 1996
SINCE = [
    "g2_4_kpi02_consolidated", "g3_1_kpi03_base", "g4_2_kpi04_daily", "g5_3_kpi05_mttr_priority", "g6_5_kpi06_daily_channel",
    "g7_3_kpi07_monthly_trend", "g8_4_kpi08_attempt_bands", "g9_2_kpi09_by_situation", "g10_3_kpi10_monthly", "g11_3_kpi11_intraday",
    "g12_2_kpi12_daily",
]
_BY_NAME = {f"{_id}_{_fn.__name__}": (_fn, _kw) for _id, (_fn, _kw) in _KPIS.items()}
for _name in SINCE:
    register(f"{_name}_since", lambda lake, known=_BY_NAME[_name]: known[0](Period(lake, min_year=SINCE_YEAR), **known[1]))

# --- dimensions and facts ------------------------------------------------------------
for _name, _dim in {
    "e3_dim_status_chamada": "dim_status_chamada", "e3_dim_status_ticket": "dim_status_ticket",
    "e3_dim_categoria_ticket": "dim_categoria_ticket", "e3_dim_prioridade_ticket": "dim_prioridade_ticket",
    "e4_dim_skill": "dim_skill", "e5_dim_campanha": "dim_campanha", "e6_dim_fila": "dim_fila",
    "e8_dim_cliente": "dim_cliente", "e9_dim_operador": "dim_operador",
    "e10_dim_supervisor": "dim_supervisor",
}.items():
    register(_name, lambda lake, dim=_dim: lake.plan(dim))
for _i, _f in enumerate(
    [
        "fato_chamada", "fato_ticket", "fato_chat", "fato_whatsapp", "fato_discagem",
        "fato_jornada_operador", "fato_metricas_operacionais", "fato_qualidade",
        "fato_interacao_ticket", "fato_mensagem_chat", "fato_ura_navegacao",
    ],
    3,
):
    register(f"f{_i}_{_f}", lambda lake, fact=_f: lake.plan(fact))

# --- views and datasets --------------------------------------------------------------
for _i, _v in enumerate(
    [
        views.view_calls_month_status, views.view_operators, views.view_quality_month,
        views.view_tickets_month, views.view_ticket_sla, views.view_digital_month,
        views.view_campaigns, views.view_queue_metrics, views.view_ivr_options,
    ],
    1,
):
    register(f"h{_i}_{_v.__name__}", _v)
# The bound orders and dials start in 1995.
register("i1_dataset_calls", lambda lake: datasets.dataset_calls(lake, MIN_YEAR))
register("i2_dataset_operators", lambda lake: datasets.dataset_operators(lake, MIN_YEAR))
register("i2_dataset_operators_once", lambda lake: datasets.dataset_operators(lake, MIN_YEAR, prejoined=False))
register("i3_dataset_tickets", lambda lake: datasets.dataset_tickets(lake, 1995))
register("i4_dataset_digital", lambda lake: datasets.dataset_digital(lake, MIN_YEAR))
register("i5_dataset_campaign_roi", lambda lake: datasets.dataset_campaign_roi(lake, 1995))

# --- exploratory statistics ----------------------------------------------------------
PROFILED = ["cliente", "operador", "chamada", "ticket", "chat", "campanha", "discagem"]
CALL_STATUSES = ["ATENDIDA", "ABANDONADA", "TRANSFERIDA", "ENGAJADA", "DESCONHECIDO"]


def _raw(lake: Lakehouse, entity: str) -> DataFrame:
    return lake.bronze(entity).drop("Op", "_timestamp", "_seq")


def _matrix(lake: Lakehouse) -> DataFrame:
    """Staged: scaling, medians and rows of the operators read it several times."""
    return staged(
        explore.operator_matrix(lake["chamada"], lake["avaliacao_qualidade"], lake["jornada_operador"], lake["operador"])
    )


def _month(c: str = "dt_inicio"):
    return F.month(c).alias("nr_mes")


def _productivity(lake: Lakehouse) -> DataFrame:
    return explore.productivity(lake["chamada"], lake["operador"])


def _handled(lake: Lakehouse) -> DataFrame:
    return lake["chamada"].filter("st_chamada = 'ATENDIDA' and nr_duracao_segundos > 0")


def _resolved(lake: Lakehouse) -> DataFrame:
    return explore.with_escalation(lake["ticket"], lake["interacao_ticket"])


_EXPLORE: dict[str, Callable[[Lakehouse], DataFrame]] = {
    "j1_profile_tables": lambda k: reduce(
        DataFrame.unionByName, [quality.profile_table(_raw(k, e), e) for e in PROFILED]
    ),
    "j2_null_pct_by_column": lambda k: quality.null_pct_by_column(_raw(k, "chamada")),
    "j3_value_counts_status": lambda k: explore.value_counts(k["chamada"], by="st_chamada"),
    "j3_top_states": lambda k: explore.value_counts(k["endereco_cliente"], by="ds_estado", limit=10),
    "j3_top_options": lambda k: explore.value_counts(k["ura_navegacao"], by="ds_opcao_selecionada", limit=10),
    "j4_volume_by_weekday": lambda k: explore.volume_by_slot(k["chamada"], slot=F.dayofweek("dt_inicio"), first=1, last=7),
    "j4_volume_by_month": lambda k: explore.volume_by_slot(k["ticket"], slot=F.month("dt_abertura"), first=1, last=12),
    "j4_volume_by_hour": lambda k: explore.volume_by_slot(k["ura_navegacao"], slot=F.hour("dt_navegacao"), first=0, last=23),
    "j5_pivot_hour_weekday": lambda k: explore.pivot_hour_weekday(k["chamada"], time="dt_inicio"),
    "j6_weekly_cumulative": lambda k: explore.weekly_cumulative(k["ticket"], time="dt_abertura"),
    "j7_crosstab_row_pct": lambda k: explore.crosstab_row_pct(k["chamada"], by="tp_chamada", on="st_chamada", values=CALL_STATUSES),
    "j8_trim_outliers_p99": lambda k: explore.duration_summary(_handled(k), by=["tp_chamada"], value="nr_duracao_segundos"),
    "j9_top10_operators": lambda k: explore.top_n_entities(_productivity(k), by="nr_chamadas", key="id_operador", n=10),
    "j9_top15_operators": lambda k: explore.top_n_entities(_productivity(k), by="nr_chamadas", key="id_operador", n=15),
    "j9_top20_operators": lambda k: explore.top_n_entities(_productivity(k), by="nr_chamadas", key="id_operador", n=20),
    "j9_bottom10_operators": lambda k: explore.top_n_entities(_productivity(k), by="nr_chamadas", key="id_operador", n=10, best=False),
    "j10_handle_time_vs_goal": lambda k: explore.handle_time_vs_goal(k["chamada"], by=[_month(), "id_fila"]),
    "j11_abandon_rate_by_queue": lambda k: explore.abandon_rate(k["chamada"], by=["id_fila"]),
    "j11_abandon_rate_by_month": lambda k: explore.abandon_rate(k["chamada"], by=[_month()]),
    "j11_abandon_rate_global": lambda k: explore.abandon_rate(k["chamada"], by=[]),
    "j12_call_sla_20s_by_channel": lambda k: explore.call_sla(k["chamada"], by=["tp_chamada"]),
    "j12_call_sla_20s_by_queue": lambda k: explore.call_sla(k["chamada"], by=["id_fila"]),
    "j12_call_sla_20s_by_month": lambda k: explore.call_sla(k["chamada"], by=[_month()]),
    "j13_channel_mix_monthly": lambda k: explore.channel_mix_monthly(k["chamada"], values=["ENTRADA", "SAIDA"]),
    "j14_ticket_sla_by_priority": lambda k: explore.ticket_sla_by_priority(k["ticket"]),
    "j15_fcr_global": lambda k: explore.fcr(_resolved(k), by=[]),
    "j15_fcr_by_category": lambda k: explore.fcr(_resolved(k), by=["ds_categoria"]),
    "j15_fcr_by_priority": lambda k: explore.fcr(_resolved(k), by=["ds_prioridade"]),
    "j16_executive_kpis": lambda k: explore.executive_kpis(k["chamada"], k["ticket"], k["interacao_ticket"]),
    "j17_quality_stats": lambda k: explore.quality_stats(k["avaliacao_qualidade"]),
    "j18_correlation": lambda k: explore.correlation(
        _productivity(k).join(explore.quality_stats(k["avaliacao_qualidade"]), "id_operador"), "nr_chamadas", "nota_media"
    ),
    "j19_handle_time_stats": lambda k: explore.handle_time_stats(k["chamada"]),
    "j20_absence_pct": lambda k: explore.absence_pct(k["jornada_operador"]),
    "j20_absence_weekday": lambda k: explore.absence_weekday(k["jornada_operador"]),
    "j21_minmax_normalize": lambda k: explore.minmax_normalize(
        _matrix(k), {"nr_chamadas": "prod_norm", "nota_media": "qual_norm", "pct_ausencia": "aus_norm"}
    ),
    "j22_composite_score": lambda k: explore.composite_score(_matrix(k)),
    "j23_quadrant": lambda k: explore.quadrant(explore.composite_score(_matrix(k))),
    "j24_team_summary": lambda k: explore.team_summary(explore.composite_score(_matrix(k))),
    "j25_linear_trend": lambda k: explore.linear_trend(k["campanha"], x="nr_meta_contatos", y="nr_conversoes"),
    "j26_contact_conversion_rates": lambda k: explore.contact_conversion_rates(k["campanha"]),
    "j27_diminishing_returns": lambda k: explore.diminishing_returns(k["discagem"]),
    "j28_effectiveness_rank": lambda k: explore.effectiveness_rank(k["campanha"]),
    "j28_effectiveness_by_objective": lambda k: explore.effectiveness_by_objective(k["campanha"]),
    "j29_operator_conversion": lambda k: explore.operator_conversion(k["discagem"], k["operador"]),
    "j30_dials_by_week": lambda k: explore.dials_by_week(k["discagem"]),
    "j30_dials_by_hour": lambda k: explore.dials_by_hour(k["discagem"]),
    "j30_dials_objective_month": lambda k: explore.dials_objective_month(k["discagem"], k["campanha"]),
    "j31_channel_comparison": lambda k: explore.channel_comparison(k["chat"], k["whatsapp_atendimento"], k["ura_navegacao"]),
    "j32_chat_enrich": lambda k: explore.chat_enrich(k["chat"], k["mensagem_chat"]),
    "j33_satisfaction_bins": lambda k: explore.satisfaction_bins(k["whatsapp_atendimento"]),
    "j33_satisfaction_bins_chat": lambda k: explore.satisfaction_bins(k["chat"]),
    "j34_duration_box_operators": lambda k: explore.box_stats(k["chamada"], by="id_operador", value="nr_duracao_segundos", groups=None),
    "j34_duration_box_stats": lambda k: explore.box_stats(k["ura_navegacao"], by="ds_opcao_selecionada", value="nr_duracao_segundos"),
    "j35_self_service_rate": lambda k: explore.self_service_rate(k["ura_navegacao"]),
}
for _name, _fn in _EXPLORE.items():
    register(_name, _fn)
