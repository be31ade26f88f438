"""The layered tables of one source folder, built in dependency order and stored once.

Stored tables are partitioned: current-state tables by verdict and the date parts of their spec, facts by the
month of their date key, with files sorted by the key. The checked rows of a current-state table are written
once; the table itself, its quarantine and its run figures are views of them. Each build goes to a folder
of its own, so a reader of an earlier build keeps its files.

Current-state and star-schema tables are written as Parquet and read back: dimensions get
exact file sizes (so the planner, not a hint, decides what is small enough to broadcast),
facts are resolved once for all queries, and a lost executor only costs a re-read.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atende.operators.cdc import dedup_tasks
from atende.operators.keys import KeyRegistry
from atende.operators.lookup import partition_of
from atende.plans import dims
from atende.plans.facts import FACTS, build_fact
from atende.plans.silver import SPECS, build_silver, late_columns, mark_silver, silver_spec
from atende.sources import bindings
from atende.sources.stage import work_dir
from atende.sources.tables import Published
from atende.sources.verdicts import MarkedTable

AS_OF = "2024-01-16"
CALENDAR = ("1992-01-01", "2030-12-31")

SILVER_WAVE = list(SPECS)
DIM_WAVE = [
    "dim_data", "dim_canal", "dim_cliente", "dim_operador", "dim_supervisor", "dim_fila",
    "dim_skill", "dim_campanha", "dim_status_chamada", "dim_status_ticket",
    "dim_categoria_ticket", "dim_prioridade_ticket",
]
BASE_FACT_WAVE = [
    "fato_chamada", "fato_chat", "fato_ticket", "fato_whatsapp", "fato_discagem",
    "fato_jornada_operador", "fato_metricas_operacionais",
]
CHILD_FACT_WAVE = ["fato_qualidade", "fato_ura_navegacao", "fato_interacao_ticket", "fato_mensagem_chat"]
# Current-state tables behind each dimension.
DIM_SOURCES = {
    "dim_data": [], "dim_canal": [], "dim_cliente": ["cliente", "endereco_cliente"],
    "dim_operador": ["operador"], "dim_supervisor": ["dim_operador"],
    "dim_fila": ["fila_atendimento"], "dim_skill": ["skill_operador"],
    "dim_campanha": ["campanha"], "dim_status_chamada": ["chamada"],
    "dim_status_ticket": ["ticket"], "dim_categoria_ticket": ["ticket"],
    "dim_prioridade_ticket": ["ticket"],
}
PARALLEL_BUILDS = 5
GOLD = DIM_WAVE + BASE_FACT_WAVE + CHILD_FACT_WAVE

# The one batch of a layer build.
FULL_BUILD = "completo"
# Days of a month share a folder under this grain; "day" gives each day its own, for tables of some GB a day.
GRAINS = ("month", "day")


def build_dim(name: str, spark: SparkSession, t, calendar: tuple[str, str] = CALENDAR) -> DataFrame:
    if name == "dim_data":
        return dims.dim_data(spark, *calendar)
    if name == "dim_canal":
        return dims.dim_canal(spark)
    if name == "dim_supervisor":
        return dims.dim_supervisor(t["dim_operador"])
    return getattr(dims, name)(t)


class Lakehouse:
    """Mapping of table names to stored tables; a missing one is built on first use."""

    def __init__(
        self,
        spark: SparkSession,
        source_dir: str,
        *,
        root: str | None = None,
        as_of: str = AS_OF,
        calendar: tuple[str, str] = CALENDAR,
        grain: str = "month",
        stable_keys: bool = False,
    ):
        if grain not in GRAINS:
            raise ValueError(f"grain is one of {GRAINS}")
        self.spark, self.source_dir = spark, source_dir.rstrip("/")
        self.as_of, self.calendar = as_of, calendar
        label = hashlib.md5(self.source_dir.encode()).hexdigest()[:12]
        self.root = root or os.path.join(work_dir(spark), label)
        # With stable keys the members of dimensions keep their keys in later builds under the same root.
        self.grain, self.stable_keys = grain, stable_keys
        self._tables: dict[str, DataFrame] = {}
        self._marked: dict[str, MarkedTable] = {}
        self._lock = threading.RLock()

    def source(self, table: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.source_dir}/{table}.parquet")

    def _spread(self, table: str) -> DataFrame:
        """Source rows on all cores, also when the table is one small file.

        A scan has fewer input splits than cores only while the table is below about 4 MB
        per core; larger tables are left as their splits are and get no extra shuffle.
        """
        df, cores = self.source(table), self.spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() >= cores:
            return df
        return df.repartition(cores, df.columns[0])

    def bronze(self, entity: str) -> DataFrame:
        return bindings.bronze(self.spark, entity, self._spread)

    def silver(self, entity: str, *, extended: bool = True) -> tuple[DataFrame, DataFrame]:
        return build_silver(
            entity, self.bronze(entity), as_of=self.as_of, tie_break="_seq", extended=extended, tasks=self._dedup_tasks(entity)
        )

    def _dedup_tasks(self, entity: str) -> int | None:
        return dedup_tasks(self.bronze(entity), silver_spec(entity, self.as_of).key)

    def plan(self, name: str, *, extended: bool = True) -> DataFrame:
        """The lazy definition of a table on top of the stored tables it needs."""
        if name in SPECS:
            return self.silver(name, extended=extended)[0]
        if name in FACTS:
            return build_fact(name, self, extended=extended)
        return build_dim(name, self.spark, self, self.calendar)

    def needs(self, name: str) -> list[str]:
        """Tables a table is built from."""
        if name in SPECS:
            return []
        if name in FACTS:
            spec = FACTS[name]
            channel = ["dim_canal"] if isinstance(spec.channel, str) else []
            return [spec.source, *dict.fromkeys(look.dim for look in spec.lookups()), *channel]
        return DIM_SOURCES[name]

    def _store(self, name: str) -> DataFrame:
        path = os.path.join(self.root, name, uuid.uuid4().hex[:12])
        if name in SPECS:
            return self._store_silver(name, path)
        df = self.plan(name)
        if name in FACTS:
            return self._store_fact(df, path, FACTS[name].date_key)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _store_silver(self, entity: str, path: str) -> DataFrame:
        """All checked rows in one write; the valid ones are the table."""
        rows = partial(
            mark_silver, entity, self.bronze(entity), as_of=self.as_of, tie_break="_seq", extended=True, tasks=self._dedup_tasks(entity)
        )
        partition = silver_spec(entity, self.as_of).partition
        by = [c for c in (partition[1] if partition else ()) if self.grain == "day" or not c.startswith("dia")]
        table = MarkedTable(self.spark, path, rows().schema, by)
        late = late_columns(entity, self.as_of)
        table.write(rows(hashed=False), FULL_BUILD, ingested=F.lit(self.as_of), late=late)
        self._marked[entity] = table
        return table.valid()

    def _store_fact(self, df: DataFrame, path: str, date_key: str) -> DataFrame:
        """A fact by month of its date key; its frame ends with that column, which filters and joins prune by."""
        part = partition_of(date_key)
        rows = df.withColumn(part, F.floor(F.col(date_key) / 100).cast("int"))
        rows.hint("rebalance", F.col(part)).sortWithinPartitions(part, date_key).write.partitionBy(part).option("compression", "zstd").parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def marked(self, entity: str) -> MarkedTable:
        """The checked rows of a current-state table."""
        self.require([entity])
        return self._marked[entity]

    def registry(self, dim: str, natural: str) -> KeyRegistry:
        """The stored keys of a dimension."""
        return KeyRegistry(self.spark, os.path.join(self.root, "chaves", dim), natural)

    def quarantine(self, entity: str) -> DataFrame:
        """Rejected rows of a current-state table, with the reason and the day of ingestion."""
        return self.marked(entity).rejected()

    def require(self, names: list[str]) -> None:
        """Store the missing tables among ``names`` and what they need, independent ones at once."""
        with self._lock:
            missing: list[str] = []

            def visit(name: str) -> None:
                if name not in self._tables and name not in missing:
                    for other in self.needs(name):
                        visit(other)
                    missing.append(name)

            for name in names:
                visit(name)
            while missing:
                ready = [n for n in missing if all(o in self._tables for o in self.needs(n))]
                with ThreadPoolExecutor(PARALLEL_BUILDS) as pool:
                    for name, df in zip(ready, pool.map(inheritable_thread_target(self.spark)(self._store), ready)):
                        self._tables[name] = df
                missing = [n for n in missing if n not in ready]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._tables:
            self.require([name])
        return self._tables[name]

    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def closure(self, names: list[str]) -> list[str]:
        """The named tables and all they are built from."""
        found: list[str] = []
        for name in names:
            found += [n for n in self.closure(self.needs(name)) if n not in found]
            found += [name] if name not in found else []
        return found

    def run(
        self, start: str = "silver", *, only: list[str] | None = None, publish_to: str | None = None
    ) -> dict[str, list[str]]:
        """Build the layers from ``start`` on, wave by wave; later layers are rebuilt.

        silver -> dimensions -> base facts -> dependent facts -> (publish). ``only`` limits
        the run to some tables and what they need.
        """
        wanted = set(self.closure(only)) if only else {*SILVER_WAVE, *GOLD}
        waves = {
            "silver": [n for n in SILVER_WAVE if n in wanted],
            "gold": [n for n in GOLD if n in wanted],
        }
        first = {"bronze": 0, "silver": 0, "gold": 1, "publish": 2}[start]
        done: dict[str, list[str]] = {}
        for layer in list(waves)[first:]:
            for name in waves[layer]:
                self._tables.pop(name, None)
                self._marked.pop(name, None)
        for layer in list(waves)[first:]:
            self.require(waves[layer])
            done[layer] = waves[layer]
        if publish_to:
            Published(self.spark, publish_to).publish({n: self.visible(n) for n in waves["gold"]})
            done["publish"] = waves["gold"]
        return done

    def visible(self, name: str) -> DataFrame:
        """A stored table without its partition column."""
        df = self[name]
        return df.drop(partition_of(FACTS[name].date_key)) if name in FACTS else df


_lakes: dict[tuple[str, str], Lakehouse] = {}
_lakes_lock = threading.Lock()


def lake_for(spark: SparkSession, source_dir: str) -> Lakehouse:
    """One Lakehouse per Spark application and source folder."""
    key = (spark.sparkContext.applicationId, source_dir.rstrip("/"))
    with _lakes_lock:
        if key not in _lakes:
            _lakes[key] = Lakehouse(spark, source_dir)
        return _lakes[key]
