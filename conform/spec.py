"""Declarative source specs: everything source-specific is data, not code.

A new source is onboarded by writing one ``SourceSpec``; no operator changes.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame


@dataclass(frozen=True)
class DerDataset:
    """Column mapping of one DER dataset (one per status) of a source."""

    dataset: str                    # raw dataset name, e.g. "install_der"
    der_id: str                     # source column of the DER key
    nameplate: str                  # capacity in kW
    circuit_id: str | None = None   # id that may name a circuit or a feeder → two-step resolution
    feeder_id: str | None = None    # feeder given directly
    der_type: str | None = None     # single label column; else wide columns (``SourceSpec.label_columns``)


@dataclass(frozen=True)
class SourceSpec:
    source_id: str
    # circuits / feeders dataset
    feeder_id: str
    max_hc: str | None = None
    min_hc: str | None = None
    refresh_date: str | None = None
    voltage: str | None = None
    circuits_dataset: str = "circuits"
    circuit_id: str | None = None        # set → rows are segments: bridge circuit → feeder is built
    segments: bool = False               # roll segments up to one row per feeder
    ts_format: str | None = None         # refresh timestamp pattern; None → default ISO parsing
    der: tuple[tuple[str, DerDataset], ...] = ()          # (status, dataset)
    label_columns: tuple[tuple[str, str], ...] = ()       # (wide source column, label)
    hybrid_flag: str | None = None       # 'Y' flag column marking intended hybrids
    null_tokens: tuple[str, ...] = ("",)  # texts read as NULL in id columns
    numeric_ids: bool = False            # ids exported as numbers (maybe floats): normalise 7.0 → '7'
    file_pattern: str = "{source_id}_{dataset}.csv"
    multiline: bool = False              # quoted line breaks in records; makes each file one task
    transform: Callable[[DataFrame], DataFrame] | None = field(default=None, compare=False)

    @property
    def datasets(self) -> tuple[str, ...]:
        return (self.circuits_dataset, *(d.dataset for _, d in self.der))

    def der_for(self, status: str) -> DerDataset | None:
        return dict(self.der).get(status)

    def file_name(self, dataset: str) -> str:
        return self.file_pattern.format(source_id=self.source_id, utility_id=self.source_id, dataset=dataset)

    def with_null_tokens(self, tokens: tuple[str, ...]) -> "SourceSpec":
        return replace(self, null_tokens=tokens)


STATUSES = ("installed", "planned")

# Texts that several sources use for "no value" in exported CSVs.
RECOMMENDED_NULL_TOKENS = ("", "null", "NULL", "na")

# Wide nameplate columns of source "utility1" and the label each one stands for,
# in the order the source lists them (the first positive column names a single-type DER).
UTILITY1_LABELS = (
    ("SolarPV", "Solar"),
    ("EnergyStorageSystem", "Energy Storage"),
    ("Wind", "Wind"),
    ("CombinedHeatandPower", "Combined Heat and Power"),
    ("FuelCell", "Fuel Cell"),
    ("FarmWaste", "Anaerobic Digester"),
    ("Hydro", "Hydro"),
    ("MicroTurbine", "Micro Turbine"),
    ("SynchronousGenerator", "Synchronous Generator"),
    ("InductionGenerator", "Induction Generator"),
    ("GasTurbine", "Gas Turbine"),
    ("InternalCombustionEngine", "Internal Combustion Engine"),
    ("SteamTurbine", "Steam Turbine"),
    ("Other", "Other"),
)

# Source column names of the two utilities' monthly drops.
UTILITY1 = SourceSpec(
    source_id="utility1",
    feeder_id="NYHCPV_csv_NFEEDER",
    circuit_id="Circuits_Phase3_CIRCUIT",
    max_hc="NYHCPV_csv_FMAXHC",
    min_hc="NYHCPV_csv_FMINHC",
    refresh_date="NYHCPV_csv_FHCADATE",
    voltage="NYHCPV_csv_FVOLTAGE",
    segments=True,
    numeric_ids=True,
    der=(
        ("installed", DerDataset("install_der", der_id="ProjectID", nameplate="NamePlateRating", circuit_id="ProjectCircuitID")),
        ("planned", DerDataset("planned_der", der_id="ProjectID", nameplate="NamePlateRating", circuit_id="ProjectCircuitID")),
    ),
    label_columns=UTILITY1_LABELS,
    null_tokens=RECOMMENDED_NULL_TOKENS,
    hybrid_flag="Hybrid",
)

UTILITY2 = SourceSpec(
    source_id="utility2",
    feeder_id="Master_CDF",
    max_hc="feeder_max_hc",
    min_hc="feeder_min_hc",
    refresh_date="hca_refresh_date",
    voltage="feeder_voltage",
    ts_format="yyyy/MM/dd HH:mm:ssx",
    multiline=True,                      # street addresses may hold line breaks
    null_tokens=RECOMMENDED_NULL_TOKENS,
    der=(
        ("installed", DerDataset("install_der", der_id="DER_ID", nameplate="DER_NAMEPLATE_RATING",
                                 feeder_id="DER_INTERCONNECTION_LOCATION", der_type="DER_TYPE")),
        ("planned", DerDataset("planned_der", der_id="INTERCONNECTION_QUEUE_REQUEST_ID", nameplate="DER_NAMEPLATE_RATING",
                               feeder_id="DER_INTERCONNECTION_LOCATION", der_type="DER_TYPE")),
    ),
)

SHIPPED_SPECS = {s.source_id: s for s in (UTILITY1, UTILITY2)}


def specs_for(source_ids: list[str], registry: dict[str, SourceSpec] | None = None) -> list[SourceSpec]:
    """Active specs in order; an id without a spec is a configuration error."""
    registry = SHIPPED_SPECS if registry is None else registry
    missing = [s for s in source_ids if s not in registry]
    if missing:
        raise KeyError(f"no SourceSpec registered for {missing}")
    return [registry[s] for s in source_ids]
