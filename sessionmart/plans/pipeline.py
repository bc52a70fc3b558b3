"""Compose the models, write the layers, run checks.

``build_models`` gives every model as a lazy DataFrame over one shared lineage.
A model that was written is ``put`` back as the table read again, and everything
built later uses that table: ``session_vwap`` is written once, ``bars_exhaustion``
stays a view over it, ``session_features`` are built from that view and the funnel
from the written features. Staging stays a view: it is a projection of the source,
and re-reading the column-pruned source costs less than writing a copy of it.

Written tables lie in shared storage, so losing an executor afterwards costs nothing.
"""

from __future__ import annotations

import os
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionmart import params as P
from sessionmart.config import shared_dir
from sessionmart.plans import catalog_layers, intermediate, marts, quality_suite, staging
from sessionmart.operators.joins import reduce_to_keys
from sessionmart.operators.long_sessions import LongSessions
from sessionmart.sources import sinks
from sessionmart.sources.ingest import check_preconditions, load_raw


class Models(Mapping[str, DataFrame]):
    """Every model as a lazy DataFrame, built on first access only (no job runs)."""

    NAMES = ("stg_bars", "stg_setups", "stg_results", "session_vwap", "bars_exhaustion",
             "session_features", "setup_outcomes", "signal_candidates", "setup_funnel")

    def __init__(self, bars: DataFrame, setups: DataFrame, results: DataFrame,
                 params: P.StrategyParams = P.FROZEN, chunk_bars: int | None = None):
        self._chunk_bars, self._long = chunk_bars, None
        self._in = {"bars": bars, "setups": setups, "results": results}
        self._params = params
        self._built: dict[str, DataFrame] = {}

    def put(self, name: str, df: DataFrame) -> None:
        """Use ``df`` (a written copy) for the model from now on."""
        self._built[name] = df

    def _long_sessions(self) -> LongSessions | None:
        """Cuts of the sessions with more than ``chunk_bars`` bars, found once (this runs a job); None without that limit."""
        if self._chunk_bars and self._long is None:
            self._long = LongSessions.find(intermediate.regular_bars(self["stg_bars"]), self._chunk_bars)
        return self._long

    def _build(self, name: str) -> DataFrame:
        p, m = self._params, self
        if name == "stg_bars":
            return staging.stg_bars(self._in["bars"])
        if name == "stg_setups":
            return staging.stg_setups(self._in["setups"])
        if name == "stg_results":
            return staging.stg_results(self._in["results"])
        if name == "session_vwap":
            return intermediate.session_vwap(m["stg_bars"], self._long_sessions())
        if name == "bars_exhaustion":
            return intermediate.bars_exhaustion(m["session_vwap"], p, self._long_sessions())
        if name == "session_features":
            return intermediate.session_features(m["bars_exhaustion"], p)
        if name == "setup_outcomes":
            return intermediate.setup_outcomes(m["stg_setups"], m["stg_results"])
        if name == "signal_candidates":
            return marts.signal_candidates(m["bars_exhaustion"], p)
        if name == "setup_funnel":
            return marts.setup_funnel(m["setup_outcomes"], m._setup_features())
        raise KeyError(name)

    def _setup_features(self) -> DataFrame:
        """Session features for the funnel's left join.

        Features that were written are used as they are. Otherwise the staged bars
        are reduced to the sessions that some setup refers to before the windows:
        every window partitions by session, so whole sessions give the same rows.
        """
        if "session_features" in self._built:
            return self._built["session_features"]
        keys = self["stg_setups"].select("symbol", F.col("setup_date").alias("session_date"))
        bars = reduce_to_keys(self["stg_bars"], keys, ["symbol", "session_date"])
        long = self._long_sessions()
        exh = intermediate.bars_exhaustion(intermediate.session_vwap(bars, long), self._params, long)
        return intermediate.session_features(exh, self._params)

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.NAMES)

    def __len__(self) -> int:
        return len(self.NAMES)


def build_models(bars: DataFrame, setups: DataFrame, results: DataFrame,
                 params: P.StrategyParams = P.FROZEN, chunk_bars: int | None = None) -> Models:
    """The models; with ``chunk_bars``, sessions of more bars are worked on in chunks (``operators.long_sessions``)."""
    return Models(bars, setups, results, params, chunk_bars)


def materialize(models: Models, scratch: str) -> Models:
    """Write the window table and the session features under ``scratch`` and go on from there."""
    spark = models["stg_setups"].sparkSession
    for name in ("session_vwap", "session_features"):
        target = os.path.join(scratch, name)
        sinks.write_table(models[name], target)
        models.put(name, sinks.read_table(spark, target))
    return models


@dataclass
class PipelineResult:
    out_dir: str
    tables: dict[str, str]
    checks: DataFrame


# Tables partitioned by ET session_date and clustered; the layer of each model.
PARTITIONED = {"session_vwap": "session_date", "signal_candidates": "session_date"}
LAYER = {"stg_bars": "staging", "stg_setups": "staging", "stg_results": "staging",
         "session_vwap": "intermediate", "bars_exhaustion": "intermediate",
         "session_features": "intermediate", "setup_outcomes": "intermediate",
         "signal_candidates": "marts", "setup_funnel": "marts"}


def run_pipeline(spark: SparkSession, bars: DataFrame, setups: DataFrame,
                 results: DataFrame, out_dir: str | None = None, target: str = "dev",
                 params: P.StrategyParams = P.FROZEN,
                 namespace_prefix: str | None = None, create_namespaces: bool = True,
                 chunk_bars: int | None = None, bars_table: str | None = None) -> PipelineResult:
    """Build every layer, write the tables, run the 42 checks over what was written.

    Tables go to ``out_dir`` as Parquet folders, or -- with
    ``namespace_prefix`` -- into one catalog namespace per layer
    (``<prefix>_intermediate.session_vwap`` ...); the two seeds and the bars (unless ``bars_table`` names the
    catalog table they came from) then go to the raw namespace, the seeds' staging models to the staging one, and the
    other models become permanent views (``catalog_layers``), so every layer can be read by name in later
    sessions. Without ``create_namespaces`` the namespaces must exist.
    """
    layers = None
    if namespace_prefix:
        if create_namespaces:
            layers = sinks.create_layers(spark, namespace_prefix)
        else:
            layers = sinks.layer_names(namespace_prefix)
            for database in layers.values():
                check_preconditions(spark, database=database)
    out_dir = out_dir or os.path.join(shared_dir(spark), "warehouse")
    models = build_models(bars, setups, results, params, chunk_bars)

    def target_of(name: str) -> str:
        return f"{layers[LAYER[name]]}.{name}" if layers else os.path.join(out_dir, name)

    tables: dict[str, str] = {}

    def write(name: str, writer, **options) -> None:
        tables[name] = target_of(name)
        writer(models[name], tables[name], **options)
        models.put(name, sinks.read_table(spark, tables[name]))
    if layers:
        for name, df in (("setups", setups), ("backtest_results", results)):
            tables[name] = f"{layers['raw']}.{name}"
            sinks.write_table(df, tables[name])
        if not bars_table:
            bars_table = tables["bars_1min"] = f"{layers['raw']}.bars_1min"
            load_raw(bars, bars_table)
        for name in ("stg_setups", "stg_results"):
            write(name, sinks.write_table)
    write("session_vwap", sinks.write_partitioned, partition_col=PARTITIONED["session_vwap"], cluster_by=("symbol", "bar_ts_utc"))
    write("session_features", sinks.write_table)
    write("signal_candidates", sinks.write_partitioned, partition_col=PARTITIONED["signal_candidates"], cluster_by=("symbol", "bar_ts_utc"))
    write("setup_funnel", sinks.write_table)
    if layers:
        tables |= catalog_layers.create_views(spark, layers, bars_table, params)
    for name in models:
        sinks.write_view(models[name], name)
    checks = quality_suite.run_suite(models, target=target, params=params)
    return PipelineResult(out_dir, tables, checks)
