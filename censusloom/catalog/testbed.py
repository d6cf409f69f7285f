"""Census-shaped inputs derived from the driver's tables.

The three microdata files are views of ``lineitem``: one row is one person. The
commune reference and the territory pyramids come from ``customer``, the outside
figures from ``orders``, departments and regions from ``nation``. Everything
is a projection or a group-by, so a query's work grows with the tables.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.config import NO_GEO, Config
from censusloom.functions import single
from censusloom.operators import base as base_ops
from censusloom.operators import births as birth_ops
from censusloom.operators import mobility, projection, shares
from censusloom.operators.disaggregate import disaggregate
from censusloom.plans.build import Mobility
from censusloom.plans.storage import run_folder, settle, settle_all
from censusloom.sources import (
    bands_from_labels,
    commune_lookup,
    estimates_long,
    read_birth_months,
    reference_pyramid,
)
from censusloom.sources.pyramids import band_labels

CENSUS_YEAR = 2022
EXCLUDED = ("22", "23")
# The window most queries project: every age band edge and confidence step occurs.
WINDOW = Config(
    census_year=CENSUS_YEAR,
    start_year=2019,
    end_year=2027,
    min_age=15,
    max_age=24,
    excluded_codes=EXCLUDED,
)
PYRAMID_AGES = [str(a) for a in range(10)] + ["100 ou plus"]


def code(number: Column, width: int) -> Column:
    return F.lpad(number.cast("string"), width, "0")


class Testbed:
    """Lazily derived inputs and intermediate tables of one query."""

    def __init__(self, spark: SparkSession, sf_dir: str, cfg: Config = WINDOW):
        self.spark, self.dir, self.cfg = spark, sf_dir, cfg
        self._cells: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def file(self, df: DataFrame, kind: str, **options: str | bool) -> str:
        """Write a derived frame as the file it would be published as; returns its path."""
        path = f"{run_folder(self.spark)}/{uuid.uuid4().hex}/published"
        df.write.format(kind).options(**options).save(path)
        return path

    @property
    def ages(self) -> tuple[int, int]:
        return self.cfg.min_age, self.cfg.max_age

    # -- microdata -----------------------------------------------------------

    @property
    def _persons(self) -> DataFrame:
        d = F.col("l_orderkey") % 25
        c = (F.col("l_suppkey") + F.col("l_linenumber")) % 20
        return self.table("lineitem").select("*", d.alias("d"), c.alias("c"), ((d + 1) * 1000 + c).alias("place"))

    @property
    def _regions(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").cast("bigint").alias("d"),
            code(F.col("n_nationkey") + 1, 2).alias("dept"),
            F.col("n_regionkey").cast("string").alias("REGION"),
        )

    @property
    def _sex(self) -> Column:
        return (
            F.when(F.col("l_orderkey") % 97 == 0, F.lit("9"))
            .when(F.col("l_linestatus") == "O", F.lit("1"))
            .otherwise(F.lit("2"))
        )

    @property
    def census(self) -> DataFrame:
        part, place = F.col("l_partkey"), F.col("place")
        iris = (
            F.when((F.col("d") >= 23) | (part % 7 == 0), F.lit(NO_GEO))
            .when(part % 11 == 0, F.concat(code(place, 5), F.lit("XXXX")))
            .otherwise(code(place * 10_000 + part % 3, 9))
        )
        canton = F.when(F.col("c") == 7, F.lit("")).otherwise(code((F.col("d") + 1) * 100 + F.col("c") % 5, 4))
        born = F.lit(CENSUS_YEAR) - (part * 7 + F.col("l_orderkey")) % 100
        return self._persons.join(self._regions, "d").select(
            iris.alias("IRIS"),
            F.rpad("dept", 3, " ").alias("DEPT"),
            "REGION",
            canton.alias("CANTVILLE"),
            F.when(part % 101 != 100, born.cast("string")).alias("ANAI"),
            self._sex.alias("SEXE"),
            F.when(part % 103 != 102, F.col("l_quantity").cast("int").cast("string")).alias("IPONDI"),
        )

    @property
    def birth_records(self) -> DataFrame:
        month = F.when(F.col("l_partkey") % 50 == 0, F.lit("XX")).otherwise(code(F.month("l_shipdate"), 2))
        unweighted = F.col("d").isin(4, 9) & (F.col("l_linenumber") > 1)
        return self._persons.join(self._regions, "d").select(
            F.when(F.col("d") % 3 == 0, F.lit("99")).otherwise(F.col("dept")).alias("DEPT"),
            "REGION",
            month.alias("MNAI"),
            F.when(unweighted, F.lit("n/a")).otherwise(F.col("l_quantity").cast("int").cast("string")).alias("IPONDI"),
        )

    @property
    def flows(self) -> DataFrame:
        part, line = F.col("l_partkey"), F.col("l_linenumber")
        study = F.when(part % 10 >= F.col("d") % 10, F.col("d")).otherwise(F.col("l_suppkey") % 25)
        # Nobody of one department studies, and of another nobody in the younger group.
        idle = (F.col("d") == 24) | ((F.col("d") == 23) & (line <= 2))
        return self._persons.select(
            code(F.col("place"), 5).alias("COMMUNE"),
            F.when(part % 107 != 0, code((study + 1) * 1000 + (part + line) % 20, 5)).alias("DCETUF"),
            F.when(idle | (line > 5), F.lit("25")).when(line <= 2, F.lit("15")).otherwise(F.lit("18")).alias("AGEREV10"),
            self._sex.alias("SEXE"),
            F.col("l_quantity").cast("int").cast("string").alias("IPONDI"),
        )

    # -- reference data ------------------------------------------------------

    @property
    def commune_records(self) -> DataFrame:
        n, s = F.col("c_nationkey"), F.col("c_custkey") % 20
        dept = code(n + 1, 2)
        epci = F.concat(F.lit("E"), F.floor(n / 2).cast("string"), F.lit("_"), (s % 4).cast("string"))
        persons = F.when(F.col("c_mktsegment") == "BUILDING", F.lit(0)).otherwise(F.col("c_custkey") % 9 * 10)
        return (
            self.table("customer")
            .groupBy(
                F.concat(dept, code(s, 3)).alias("code"),
                F.when(s != 19, epci).alias("codeEpci"),
                dept.alias("codeDepartement"),
            )
            .agg(F.sum(persons).alias("population"))
            .withColumn("nom", F.concat(F.lit("Commune "), "code"))
        )

    @property
    def cog(self) -> DataFrame:
        dept, s = code(F.col("c_nationkey") + 1, 2), F.col("c_custkey") % 20
        return (
            self.table("customer")
            .select(
                F.concat(dept, code(s, 3)).alias("commune_code"),
                dept.alias("department_code"),
                F.concat(dept, code(s % 5, 2)).alias("canton_code"),
            )
            .distinct()
        )

    @property
    def departments(self) -> DataFrame:
        """The 25 nations as departments, and two without records: one without a region."""
        extra = birth_ops.department_dimension(self.spark, [("26", None, False), ("27", "9", False)])
        return (
            self.table("nation")
            .select(
                code(F.col("n_nationkey") + 1, 2).alias("department_code"),
                F.col("n_regionkey").cast("string").alias("region_code"),
                (F.col("n_nationkey") < 20).alias("is_metro"),
            )
            .unionByName(extra)
        )

    @property
    def expected(self) -> DataFrame:
        d = F.col("department_code").cast("int")
        territory = (
            F.when(d <= 20, "metro").when(d <= 22, "dom").when(d.isin(23, 26), "mayotte").otherwise(F.lit("tom"))
        )
        return self.departments.select("department_code", territory.alias("territory"))

    @property
    def sheet(self) -> DataFrame:
        """A spreadsheet with a commune per line and a (sex, age) per column."""
        cells, n = [], len(PYRAMID_AGES)
        for i in range(2 * n):
            mine = (F.col("c_custkey") % n == i % n) & (F.col("c_nationkey") % 2 == i // n)
            value = F.sum(F.when(mine, F.col("c_custkey") % 1000 * 7.5).otherwise(F.lit(0.0)))
            cells.append(F.translate(F.format_number(value, 1), ",.", " ,").alias(f"c{i + 2}"))
        commune = F.concat(code(F.col("c_nationkey") + 1, 2), code(F.col("c_custkey") % 20, 3))
        lines = (
            self.table("customer")
            .groupBy(commune.alias("c0"))
            .agg(F.lit(100).alias("row"), F.lit("").alias("c1"), *cells)
        )
        names = ["row", "c0", "c1", *[f"c{i + 2}" for i in range(2 * n)]]
        head = self.spark.createDataFrame(
            [
                (5, "Variables :", "SEXE", *["1"] * n, *["2.0"] * n),
                (6, None, "AGED100", *PYRAMID_AGES, *PYRAMID_AGES),
                (10, "CODGEO", "LIBGEO", *[None] * (2 * n)),
            ],
            "row int, " + ", ".join(f"{c} string" for c in names[1:]),
        )
        return head.unionByName(lines)

    def territory_pyramid(self, segment: str) -> DataFrame:
        return (
            self.table("customer")
            .where(F.col("c_mktsegment") == segment)
            .groupBy(
                (F.col("c_custkey") % 101).cast("int").alias("age"),
                F.when(F.col("c_nationkey") % 2 == 0, "male").otherwise(F.lit("female")).alias("sex"),
            )
            .agg(F.sum(F.col("c_custkey") % 40).cast("double").alias("population"))
        )

    @property
    def band_table(self) -> DataFrame:
        k = F.col("c_custkey") % 17
        start = k * 5
        label = F.when(k == 16, F.lit("80 ans et +")).otherwise(
            F.concat(start.cast("string"), F.lit(" à "), (start + 4).cast("string"), F.lit(" ans"))
        )

        def cell(parity):
            total = F.sum(F.when(F.col("c_nationkey") % 2 == parity, F.col("c_custkey") % 1000).otherwise(F.lit(0)))
            return F.translate(F.format_number(total, 0), ",", " ")

        return (
            self.table("customer").groupBy(label.alias("label")).agg(cell(0).alias("male"), cell(1).alias("female"))
        )

    @property
    def bands(self) -> DataFrame:
        return bands_from_labels(self.band_table, band_labels(self.spark))

    # -- outside figures -----------------------------------------------------

    @property
    def estimates_wide(self) -> DataFrame:
        """Yearly sheets: a line per birth year, a total line, and one unpublished cell."""
        o = self.table("orders").select(
            (F.col("o_orderkey") % 8 + 2019).cast("int").alias("year"),
            (F.col("o_custkey") % 18 + 1995).cast("int").alias("born"),
            (F.col("o_custkey") % 50 + 1).alias("n"),
            "o_orderstatus",
        )
        male = F.sum(F.when(F.col("o_orderstatus") != "P", F.col("n"))).cast("string")
        female = F.sum(F.when(F.col("o_orderstatus") != "O", F.col("n"))).cast("string")
        lines = (
            o.where(F.col("born") % 13 != 0)
            .groupBy("year", F.col("born").cast("string").alias("naissance"))
            .agg(male.alias("male"), female.alias("female"))
            .withColumn(
                "female",
                F.when((F.col("year") == 2021) & (F.col("naissance") == "2003"), "n.d.").otherwise(F.col("female")),
            )
        )
        total = (
            o.groupBy("year")
            .agg(male.alias("male"), female.alias("female"))
            .withColumn("naissance", F.lit("Total"))
        )
        return lines.unionByName(total)

    @property
    def estimates(self) -> DataFrame:
        return estimates_long(self.estimates_wide)

    @property
    def reference(self) -> DataFrame:
        raw = self.table("orders").select(
            (F.col("o_orderkey") % 9 + 2019).cast("string").alias("ANNEE"),
            (F.col("o_custkey") % 5).cast("string").alias("region_code"),
            (F.col("o_custkey") % 23 + 10).cast("string").alias("AGE"),
            F.when(F.col("o_orderstatus") == "O", "M").otherwise(F.lit("F")).alias("SEXE"),
            (F.col("o_orderkey") % 50 + 1).cast("string").alias("POP"),
        )
        return reference_pyramid(raw)

    @property
    def pyramid_csv(self) -> DataFrame:
        male = F.col("o_orderstatus") == "O"
        return self.table("orders").select(
            (F.col("o_orderkey") % 5 + 2015).cast("string").alias(" Année"),
            F.when(F.col("o_custkey") % 91 == 90, F.lit("90+"))
            .otherwise((F.col("o_custkey") % 91).cast("string"))
            .alias("Âge "),
            F.when(male, "1").when(F.col("o_orderstatus") == "F", "2").otherwise(F.lit("T")).alias("Sexe"),
            (F.col("o_custkey") % 30 * F.when(male, -1).otherwise(F.lit(1))).cast("string").alias("Pop"),
        )

    @property
    def enrolment_rows(self) -> DataFrame:
        group = F.create_map(
            *[
                F.lit(x)
                for x in (
                    "1-URGENT", "UNIV", "2-HIGH", "GE", "3-MEDIUM", "STS", "4-NOT SPECIFIED", "CPGE", "5-LOW", "ENS",
                )
            ]
        )
        place = F.concat(code(F.col("o_custkey") % 25 + 1, 2), code(F.col("o_orderkey") % 20, 3))
        return self.table("orders").select(
            F.when(F.col("o_orderkey") % 3 == 0, "2021-22").otherwise(F.lit("2022-23")).alias("annee_universitaire"),
            F.when(F.col("o_orderkey") % 29 == 0, "").otherwise(place).alias("com_id"),
            group[F.col("o_orderpriority")].alias("regroupement"),
            (F.col("o_custkey") % 40 + 1).cast("int").alias("effectif"),
        )

    # -- cells and tables derived from them ------------------------------------

    @property
    def base_cells(self) -> DataFrame:
        """Base cells for a query that reads them once."""
        return base_ops.base_population(self.census, CENSUS_YEAR)

    def prepare(self, *names: str) -> None:
        """Settle the cells several steps of a query read, side by side."""
        sources = {
            "base": lambda: self.base_cells,
            "lookup": lambda: commune_lookup(self.commune_records),
            "flow_cells": lambda: mobility.flow_cells(self.flows),
            "birth_cells": lambda: birth_ops.birth_cells(read_birth_months(self.birth_records)),
        }
        self._cells |= settle_all({name: sources[name]() for name in names if name not in self._cells})

    def _cell(self, name: str) -> DataFrame:
        self.prepare(name)
        return self._cells[name]

    @property
    def base(self) -> DataFrame:
        """Base cells: persons are scanned once however many steps read them."""
        return self._cell("base")

    @property
    def lookup(self) -> DataFrame:
        return self._cell("lookup")

    @property
    def flow_cells(self) -> DataFrame:
        return self._cell("flow_cells")

    @property
    def birth_cells(self) -> DataFrame:
        return self._cell("birth_cells")

    @cached_property
    def mobility(self) -> Mobility:
        self.prepare("base", "lookup", "flow_cells")
        return Mobility(self.base, self.lookup, self.flow_cells, self.cfg)

    @property
    def big_department(self) -> Column:
        """The mean weight of a known department: at any size some are above it and some below."""
        known = self.birth_cells.join(self.departments.select("department_code"), "department_code", "left_semi")
        return single(known.groupBy("department_code").agg(F.sum("weight").alias("weight")), F.avg("weight"))

    @property
    def births(self) -> DataFrame:
        return birth_ops.birth_month_distribution(self.birth_cells, self.departments, self.big_department)

    @cached_property
    def births_table(self) -> DataFrame:
        return settle(self.births, "births")

    def ratios(self, level: str) -> DataFrame:
        self.prepare("base", "lookup")
        return shares.geo_ratios(level, self.base, self.lookup)

    @cached_property
    def blended_epci(self) -> DataFrame:
        return self.mobility.corrected_epci(self.ratios("epci"))

    @cached_property
    def blended_iris(self) -> DataFrame:
        return self.mobility.corrected_iris(self.ratios("iris"))

    @property
    def census_departments(self) -> DataFrame:
        return projection.census_departments(self.base)

    @property
    def stable(self) -> DataFrame:
        births = self.births_table if self.cfg.monthly else None
        return projection.project_stable(self.census_departments, self.cfg, births)

    @cached_property
    def parent(self) -> DataFrame:
        """The projected departments as parent of finer levels."""
        return settle(self.stable, "department")

    def level(self, level: str) -> DataFrame:
        """A compact level of the cohort-stable projection with census shares."""
        if level == "department":
            return self.parent
        self.prepare("base", "lookup")
        return disaggregate(self.parent, self.ratios(level), level)
