"""Name of a registered query -> DuckDB SQL."""

from __future__ import annotations

import re

from atende.plans.facts import FACTS
from atende.plans.silver import SPECS
from atende.registry import SINCE, SINCE_YEAR
from oracle import base, compose, exploration, gold, kpis, reports, silver

RELATIONS = {**silver.RELATIONS, **gold.RELATIONS, **kpis.RELATIONS}

ANSWERS: dict[str, str] = {}


def _add(name: str, sql: str) -> None:
    ANSWERS[name] = compose(sql, RELATIONS)


for _i, _e in enumerate(SPECS, 1):
    _add(f"d{_i}_silver_{_e}", f"select {', '.join(silver.output_columns(_e))} from sv_{_e}")

for _name, _sql in kpis.FINALS.items():
    _add(_name, _sql)

for _name, _sql in reports.FINALS.items():
    _add(_name, _sql)

# Dimensions and facts: the relation itself.
DIM_QUERIES = {
    "e3_dim_status_chamada": "dim_status_chamada", "e3_dim_status_ticket": "dim_status_ticket",
    "e3_dim_categoria_ticket": "dim_categoria_ticket", "e3_dim_prioridade_ticket": "dim_prioridade_ticket",
    "e4_dim_skill": "dim_skill", "e5_dim_campanha": "dim_campanha", "e6_dim_fila": "dim_fila",
    "e8_dim_cliente": "dim_cliente", "e9_dim_operador": "dim_operador",
    "e10_dim_supervisor": "dim_supervisor",
}
for _name, _dim in DIM_QUERIES.items():
    _add(_name, f"select * from {_dim}")
for _i, _f in enumerate(
    [
        "fato_chamada", "fato_ticket", "fato_chat", "fato_whatsapp", "fato_discagem",
        "fato_jornada_operador", "fato_metricas_operacionais", "fato_qualidade",
        "fato_interacao_ticket", "fato_mensagem_chat", "fato_ura_navegacao",
    ],
    3,
):
    _add(f"f{_i}_{_f}", f"select * from {_f}")

RELATIONS |= exploration.RELATIONS
for _name, _sql in exploration.FINALS.items():
    _add(_name, _sql)

RELATIONS |= base.RELATIONS
for _name, _sql in base.FINALS.items():
    _add(_name, _sql)
_add(
    "f15_table_counts",
    " union all ".join(
        [f"select '{g}' as nm_tabela, count(*) as nr_linhas from {g}" for g in gold.TABLES]
        + [f"select '{n.split('_', 1)[1]}' as nm_tabela, count(*) as nr_linhas from ({sql})" for n, sql in reports.FINALS.items() if n.startswith("h")]
    ),
)

# KPIs limited to a period: facts from the floor on, parents resolved before it.
_LIMITED = dict(RELATIONS)
for _f, _spec in FACTS.items():
    _LIMITED[f"{_f}_full"] = re.sub(r"\b(fato_[a-z_]+)", r"\1_full", RELATIONS[_f])
    _LIMITED[_f] = f"select * from {_f}_full where {_spec.date_key} >= {SINCE_YEAR * 10000}"
for _name in SINCE:
    ANSWERS[f"{_name}_since"] = compose(kpis.FINALS[_name], _LIMITED)
