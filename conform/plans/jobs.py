"""The three layers as jobs: raw ingest → conform (bridge, dim, fact) → serve.

Driver code here only builds plans and starts one write job per table; no data passes
through the driver. Intermediate results are written (staged) so each table is computed
once, its checks are counted in that same job, and lost executors only redo the last stage.
"""

from __future__ import annotations

import logging
import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conform.context import RunContext, audit_stamp
from conform.operators.conform import (
    conform_bridge_source,
    conform_dim_source,
    conform_facts,
    conform_lookup_source,
    union_all,
)
from conform.operators.dedup import latest_per_key
from conform.operators.merge import upsert
from conform.operators.quality import (
    DIM_CHECKS,
    FACT_CHECKS,
    quality_summary,
    staged_with_checks,
)
from conform.operators.resolve import feeder_lookup
from conform.operators.serve import feeder_details
from conform.session import dropped_shuffles, scratch_path
from conform.sources.csv import csv_load
from conform.sources.keyed import bucket_of, upsert_keyed
from conform.sources.tables import batch_scan, load_batch, publish, read_table, remove
from conform.spec import SourceSpec

log = logging.getLogger("conform.jobs")

DIM_KEYS = ("utility_id", "feeder_id")
FACT_KEYS = ("utility_id", "der_id", "status")
DIM_ORDER = ("batch_date", "last_refresh_date")
FACT_ORDER = ("batch_date",)
CAPACITY_CLUSTER = ("max_hosting_capacity", "feeder_id")
DETAILS_CLUSTER = ("feeder_id", "der_id", "status")
DETAILS_BLOOM = {"feeder_id": 100_000}  # feeders a file: a look-up without a source meets every source's files


@dataclass(frozen=True)
class Layout:
    """Where each layer lives (any Hadoop-compatible URI)."""

    raw: str
    conformed: str
    serving: str
    fact_buckets: int = 16  # of the fact table's key, fixed once it exists; more for a table of many TB

    def raw_table(self, source_id: str, dataset: str) -> str:
        return f"{self.raw}/{source_id}_{dataset}"

    def conformed_table(self, name: str) -> str:
        return f"{self.conformed}/{name}"

    def serving_table(self, name: str) -> str:
        return f"{self.serving}/{name}"


# ---------------------------------------------------------------- raw
def ingest_file(spark: SparkSession, path: str, spec: SourceSpec, layout: Layout, dataset: str, ctx: RunContext) -> dict:
    """One drop (a file or a folder of files) → a load of the raw table: strings, provenance, audit columns."""
    table = layout.raw_table(spec.source_id, dataset)
    return csv_load(spark, path, lambda rows: load_batch(audit_stamp(rows, ctx), table, spec.source_id, ctx.batch_date, ctx.pipeline_run_id),
                    spec.multiline, source_id=spec.source_id)


def run_concurrently(tasks: dict[str, Callable[[], object]], max_workers: int = 8) -> dict[str, object]:
    """Submit independent write jobs together so the scheduler can run them side by side.

    Each task writes its own table; an ingest of one unsplittable file (multi-line CSV) uses
    one core, so running files one after another would leave the cluster idle.
    """
    if len(tasks) <= 1:
        return {k: f() for k, f in tasks.items()}
    with ThreadPoolExecutor(max_workers=min(max_workers, len(tasks))) as pool:
        futures = {k: pool.submit(f) for k, f in tasks.items()}
        return {k: fut.result() for k, fut in futures.items()}


def pipe_raw(spark: SparkSession, specs: Sequence[SourceSpec], landing: str, layout: Layout,
             ctx: RunContext, max_parallel_files: int = 8) -> dict[str, int]:
    """Ingest every dataset of every active source; each drop replaces earlier drops of its batch only."""
    def one(spec: SourceSpec, ds: str) -> int:
        return ingest_file(spark, f"{landing.rstrip('/')}/{spec.file_name(ds)}", spec, layout, ds, ctx)["rows"]

    tasks = {f"{spec.source_id}_{ds}": (lambda spec=spec, ds=ds: one(spec, ds))
             for spec in specs for ds in spec.datasets}
    counts = run_concurrently(tasks, max_parallel_files)
    log.info("raw: %s rows", sum(counts.values()))
    return counts


# ---------------------------------------------------------------- conform
def build_conformed(
    raws: dict[tuple[str, str], DataFrame],
    specs: Sequence[SourceSpec],
    known_dim: DataFrame | None = None,
    bridges: dict[str, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Pure plan of the conform layer: (dim rows, fact rows, bridges) before checks/dedup/upsert.

    ``raws[(source_id, dataset)]`` are raw rows. Ambiguous ids resolve against the published ``bridges``
    and ``known_dim`` when given, else against a lookup built in one pass over this drop's own circuits.
    """
    bridges = dict(bridges or {})
    dim_rows = union_all([conform_dim_source(raws[(s.source_id, s.circuits_dataset)], s) for s in specs])
    facts = []
    for s in specs:
        circuits = raws[(s.source_id, s.circuits_dataset)]
        if known_dim is not None:
            if s.source_id not in bridges and s.circuit_id:
                bridges[s.source_id] = conform_bridge_source(circuits, s)
            known = known_dim.where(F.col("utility_id") == F.lit(s.source_id)).select("feeder_id")
            lookup = feeder_lookup(bridges.get(s.source_id), known) if s.circuit_id else None
        else:
            lookup = conform_lookup_source(circuits, s)
        ders = {status: raws[(s.source_id, ds.dataset)] for status, ds in s.der}
        if ders:
            facts.append(conform_facts(ders, s, lookup))
    return dim_rows, union_all(facts), bridges


def pipe_conform(spark: SparkSession, specs: Sequence[SourceSpec], layout: Layout, ctx: RunContext,
                 batch_date=None, only_newer: bool = False) -> dict:
    """Conform one batch (default: the context's) of the raw tables and upsert the results.

    Order: bridges → dimension (checks, then latest row per feeder, then upsert) → facts of
    both statuses (latest row per DER, checks, upsert). Facts resolve direct feeder ids
    against the *upserted* dimension, so feeders of earlier batches still resolve. The dimension is published as a whole; of
    the facts, all history, only the sources and key buckets of the batch are rewritten (``fact_der`` counts these rows).

    Staged rows and shuffles are dropped as soon as what they are for is written; a job that dies leaves its staged rows to the
    retention of the scratch folder.
    """
    with dropped_shuffles(spark):
        return _conform(spark, specs, layout, ctx, batch_date, only_newer)


def _conform(spark: SparkSession, specs: Sequence[SourceSpec], layout: Layout, ctx: RunContext, batch_date, only_newer: bool) -> dict:
    batch = ctx.batch_date if batch_date is None else batch_date
    raws = {(s.source_id, ds): batch_scan(spark, layout.raw_table(s.source_id, ds), batch_date=batch)
            for s in specs for ds in s.datasets}
    out: dict = {}
    timings = out["seconds"] = {}
    mark = time.perf_counter()

    def lap(name: str) -> None:
        nonlocal mark
        now = time.perf_counter()
        timings[name], mark = round(now - mark, 3), now

    # bridges (small, reused by both statuses) and the dimension's staging are independent jobs: run together
    tasks: dict[str, Callable[[], object]] = {}
    for s in specs:
        b = conform_bridge_source(raws[(s.source_id, s.circuits_dataset)], s)
        if b is not None:
            tasks[f"bridge_{s.source_id}"] = (lambda b=b, s=s: publish(
                b, layout.conformed_table(f"bridge_{s.source_id}"))["rows"])
    dim_rows = union_all([conform_dim_source(raws[(s.source_id, s.circuits_dataset)], s) for s in specs])
    stage = {name: scratch_path(spark, f"stage-{name}") for name in ("dim", "fact")}
    tasks["_dim"] = lambda: staged_with_checks(dim_rows, DIM_CHECKS, "dim", "dim_feeder", stage["dim"])
    done = run_concurrently(tasks)
    dim_clean, out["dim_checks"] = done.pop("_dim")
    out.update(done)
    bridges = {s.source_id: read_table(spark, layout.conformed_table(f"bridge_{s.source_id}"))
               for s in specs if f"bridge_{s.source_id}" in done}
    lap("bridges_and_dim_stage")
    dim_new = audit_stamp(latest_per_key(dim_clean, DIM_KEYS, DIM_ORDER), ctx, keep_batch_date=True)
    dim_path = layout.conformed_table("dim_feeder")
    dim_state = upsert(read_table(spark, dim_path), dim_new, DIM_KEYS, only_newer=only_newer)
    out["dim_feeder"] = publish(dim_state, dim_path, partition_cols=("utility_id",))["rows"]
    remove(spark, stage["dim"])
    dim = read_table(spark, dim_path)
    lap("dim_publish")

    _, fact_rows, _ = build_conformed(raws, specs, known_dim=dim, bridges=bridges)
    # one shuffle for the latest row and the table's layout: the stored rows lie in the order of sources and buckets
    parts = ("utility_id", f"bucket_of_{layout.fact_buckets}")
    fact_latest = latest_per_key(fact_rows.withColumn(parts[1], bucket_of(FACT_KEYS, layout.fact_buckets)), FACT_KEYS, FACT_ORDER, ranges=parts)
    fact_clean, out["fact_checks"] = staged_with_checks(fact_latest, FACT_CHECKS, "fact", "fact_der", stage["fact"])
    lap("fact_stage")
    fact_new = audit_stamp(fact_clean, ctx, keep_batch_date=True)
    fact_path = layout.conformed_table("fact_der")
    written = upsert_keyed(fact_new, fact_path, FACT_KEYS, ("utility_id",), layout.fact_buckets, only_newer, stored=True, together=True)
    remove(spark, stage["fact"])
    out["fact_der"], out["fact_buckets"] = written["rows"], written["buckets"]
    lap("fact_upsert")
    return out


# ---------------------------------------------------------------- serve
def pipe_serve(spark: SparkSession, layout: Layout, ctx: RunContext) -> dict:
    """Capacity (clustered on capacity), DER details (clustered on feeder), quality summary.

    Inputs are the published conformed tables. The range sampling of the details reads the join's shuffled rows and joins them
    once more, which is cheaper than a stored copy of the result; capacity is a plain scan. The cluster columns end in the key, so
    neither a hot feeder nor rows without one are left to a single range.
    """
    dim = read_table(spark, layout.conformed_table("dim_feeder"))
    fact = read_table(spark, layout.conformed_table("fact_der"))
    tasks = {
        "feeder_capacity": lambda: publish(dim, layout.serving_table("feeder_capacity"), ("utility_id",),
                                           cluster_cols=CAPACITY_CLUSTER)["rows"],
        "feeder_der_details": lambda: publish(feeder_details(fact, dim, stored=True), layout.serving_table("feeder_der_details"),
                                              ("utility_id",), cluster_cols=DETAILS_CLUSTER, bloom=DETAILS_BLOOM)["rows"],
        "data_quality": lambda: publish(quality_summary(dim, fact, ctx), layout.serving_table("data_quality"))["rows"],
    }
    with dropped_shuffles(spark):
        return run_concurrently(tasks)


def run_all(spark: SparkSession, specs: Sequence[SourceSpec], landing: str, layout: Layout, ctx: RunContext,
            only_newer: bool = False, clear_landing: bool = False) -> dict:
    """Raw → conform → serve for one drop, one context for all layers.

    ``clear_landing`` removes the specs' drops as soon as all of them are rows of the raw tables, from which the later layers
    can be run again; by default they stay.
    """
    raw = pipe_raw(spark, specs, landing, layout, ctx)
    if clear_landing:
        for spec in specs:
            for ds in spec.datasets:
                remove(spark, f"{landing.rstrip('/')}/{spec.file_name(ds)}")
    return {
        "raw": raw,
        "conform": pipe_conform(spark, specs, layout, ctx, only_newer=only_newer),
        "serve": pipe_serve(spark, layout, ctx),
    }
