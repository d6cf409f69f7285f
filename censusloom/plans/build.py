"""The whole run: microdata in, four projected levels out."""

from __future__ import annotations

import logging
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from functools import cached_property

from pyspark.sql import DataFrame

from censusloom.config import TERRITORIES, Config
from censusloom.operators import base as base_ops
from censusloom.operators import births as birth_ops
from censusloom.operators import mobility, projection, shares
from censusloom.operators.disaggregate import disaggregate
from censusloom.plans.storage import Manifest, clear, fingerprint, settle, settle_all
from censusloom.sinks.export import export_levels
from censusloom.sources.microdata import in_scope, read_birth_months

log = logging.getLogger(__name__)


@dataclass
class Inputs:
    """Tables a run reads. Estimates and flows may be missing; the rest may not."""

    census: DataFrame
    birth_records: DataFrame
    lookup: DataFrame
    departments: DataFrame
    flows: DataFrame | None = None
    estimates: DataFrame | None = None
    pyramids: Mapping[str, DataFrame] = field(default_factory=dict)

    def frames(self) -> dict[str, DataFrame | None]:
        """All tables by name."""
        own = {f.name: getattr(self, f.name) for f in fields(self) if f.name != "pyramids"}
        return own | {f"pyramid {code}": df for code, df in self.pyramids.items()}


@dataclass
class Build:
    """Compact levels of a run, without the birth-month expansion."""

    base: DataFrame
    births: DataFrame
    ratios: dict[str, DataFrame]
    levels: dict[str, DataFrame]
    cfg: Config
    manifest: Manifest | None = None

    def export(self, folder: str, selected=None, yearly_levels=(), replace=True, metrics=None) -> dict[str, str]:
        return export_levels(self.levels, self.births, folder, selected, yearly_levels, replace, metrics)

    def close(self) -> None:
        """Delete the run's intermediate tables, once everything is exported."""
        clear(self.base.sparkSession)
        if self.manifest is not None:
            self.manifest.clear()


def wanted_territories(cfg: Config) -> list:
    wanted = {"mayotte": cfg.include_mayotte, "tom": cfg.include_tom, "com": cfg.include_com}
    return [t for t in TERRITORIES if wanted[t.group]]


def build_levels(inputs: Inputs, cfg: Config, resume: bool = False) -> Build:
    """Scan each microdata file once into cells, then work on the cells.

    Settled, each round side by side: the cells of the inputs; births, census
    departments and shares; the projected departments and the corrected shares.

    With ``resume`` these tables are kept under a fingerprint of inputs, parameters
    and code: a second run on the same inputs, also by another driver, reads those
    that are whole instead of scanning the microdata again, until close() deletes
    them.
    """
    manifest = Manifest(inputs.census.sparkSession, fingerprint(inputs.frames(), cfg)) if resume else None
    if cfg.lost_cohorts:
        log.warning("the %d youngest cohorts were not born at the census and will be absent", cfg.lost_cohorts)
    base = base_ops.base_population(in_scope(inputs.census, cfg), cfg.census_year)
    territories = wanted_territories(cfg)
    if territories:
        base = base_ops.append_territories(base, inputs.pyramids, cfg.census_year, territories=territories)
    cells = {
        "base": base,
        "lookup": inputs.lookup,
        "birth_cells": birth_ops.birth_cells(read_birth_months(inputs.birth_records)),
    }
    if cfg.correct_mobility:
        if inputs.flows is None:
            raise ValueError("the mobility correction needs the commuting flows")
        cells["flow_cells"] = mobility.flow_cells(inputs.flows)
    cells = settle_all(cells, manifest)
    base, lookup = cells["base"], cells["lookup"]

    tables = settle_all(
        {
            "births": birth_ops.birth_month_distribution(
                cells["birth_cells"], inputs.departments, cfg.big_department_weight
            ),
            "census_departments": projection.census_departments(base),
        }
        | {level: shares.geo_ratios(level, base, lookup) for level in ("epci", "canton", "iris")},
        manifest,
    )
    births, ratios = tables["births"], {level: tables[level] for level in ("epci", "canton", "iris")}
    if births.isEmpty():
        raise ValueError("no usable birth month in the birth records")
    last = {"department": projection.project(tables["census_departments"], cfg, inputs.estimates, births)}
    if cfg.correct_mobility:
        moves = Mobility(base, lookup, cells["flow_cells"], cfg, manifest)
        last["corrected_epci"] = moves.corrected_epci(ratios["epci"])
        last["corrected_iris"] = moves.corrected_iris(ratios["iris"])
    last = settle_all(last, manifest)
    department = last.pop("department")
    ratios |= {name.removeprefix("corrected_"): df for name, df in last.items()}
    levels = {"department": department} | {
        level: disaggregate(department, df, level, cfg.confidence_extra[level])
        for level, df in ratios.items()
    }
    return Build(base, births, ratios, levels, cfg, manifest)


class Mobility:
    """Student flows of a run, and the area shares corrected by them.

    Works on settled base cells, commune lookup and flow cells. Weights and flows
    are settled in turn, since each is read by more than one step.
    """

    def __init__(self, base: DataFrame, lookup: DataFrame, cells: DataFrame, cfg: Config, manifest: Manifest | None = None):
        self.base, self.lookup, self.cells, self.cfg = base, lookup, cells, cfg
        self.settle = settle if manifest is None else manifest.settle
        self.roles = mobility.band_roles(base.sparkSession, cfg.student_bands)

    @property
    def rates(self) -> DataFrame:
        return mobility.mobility_rates(self.cells, self.roles)

    @cached_property
    def weights(self) -> DataFrame:
        return self.settle(mobility.mobility_weights(self.rates, self.base, self.cfg.student_bands), "mobility_weights")

    @property
    def to_epci(self) -> DataFrame:
        return mobility.student_flows_epci(self.cells, self.lookup, self.roles)

    @cached_property
    def share(self) -> DataFrame:
        return self.settle(mobility.iris_commune_share(self.base, self.lookup), "iris_commune_share")

    @cached_property
    def by_commune(self) -> DataFrame:
        return self.settle(mobility.student_flows_commune(self.cells, self.share, self.roles), "student_flows_commune")

    @property
    def to_iris(self) -> DataFrame:
        return mobility.student_flows_iris(self.by_commune, self.share)

    @property
    def intra(self) -> DataFrame:
        return mobility.intra_fraction(self.by_commune, self.share)

    def corrected_epci(self, census_ratios: DataFrame) -> DataFrame:
        flows = self.settle(self.to_epci, "student_flows_epci")
        return mobility.blend_epci(census_ratios, flows, self.weights, self.cfg.student_bands)

    def corrected_iris(self, census_ratios: DataFrame) -> DataFrame:
        local = mobility.local_flows_iris(self.by_commune, self.share)
        return mobility.blend_iris(census_ratios, local, self.intra, self.weights, self.cfg.student_bands)
