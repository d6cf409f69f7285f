"""Age pyramids published as spreadsheets, reshaped to (age, sex, population)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from censusloom.functions import age_label, decode_sex, french_number, sex_code, single

HEADER_LINES = 15  # the header block ends before this line, unless a caller says otherwise

# Band labels of the source tables and the age each band starts at.
BAND_LABELS = {f"{a} à {a + 4} ans": a for a in range(0, 80, 5)} | {
    "80 à 84 ans": 80,
    "80 ans et +": 80,
    "85 ans et +": 85,
}


def pyramid_header(sheet: DataFrame, header_lines: int | None = HEADER_LINES) -> DataFrame:
    """Which (sex, age) each value column of a wide sheet holds: (column, sex, age).

    ``sheet`` has an integer ``row`` and string cells c0, c1, c2, ...; the header
    lines are the last ones whose second cell reads SEXE and AGED100, among the
    first ``header_lines`` lines or, with None, among all lines. One aggregate
    finds both. Columns without a readable sex and age are left out.
    """
    values = _values(sheet)
    kind = F.upper(F.trim("c1"))
    head = sheet.where(kind.isin("SEXE", "AGED100"))
    if header_lines is not None:
        head = head.where(F.col("row") < header_lines)
    line = F.struct("row", F.array(*[F.col(c) for c in values]).alias("cells"))
    found = head.groupBy().agg(*[F.max(F.when(kind == name, line)).alias(name) for name in ("SEXE", "AGED100")])
    cells = F.arrays_zip(
        F.array(*[F.lit(c) for c in values]).alias("column"), F.col("SEXE.cells").alias("sexe"), F.col("AGED100.cells").alias("aged")
    )
    return (
        found.select(F.explode(cells).alias("cell"))
        .select("cell.column", decode_sex(sex_code(F.col("cell.sexe"))).alias("sex"), age_label(F.col("cell.aged")).alias("age"))
        .where(F.col("sex").isNotNull() & F.col("age").isNotNull())
    )


def pyramid_unpivot(
    sheet: DataFrame, header: DataFrame | None = None, prefix: str | None = None, header_lines: int | None = HEADER_LINES
) -> DataFrame:
    """Sum a sheet with one line per commune and one column per (sex, age).

    Lines count from below the CODGEO title on: the last one among the first
    ``header_lines`` lines or, with None, the first one of the whole sheet.
    ``prefix`` keeps the communes of one territory. Only positive totals are kept.
    A sheet without that title is an error, raised when the result is read.

    The check stands in a global aggregate, which has a row whatever the sheet
    holds, and the result is made of that row alone: there is no join or filter
    before it whose empty side would let an optimiser skip the check.
    """
    header = pyramid_header(sheet, header_lines) if header is None else header
    values = _values(sheet)
    code = F.trim("c0")
    titled = sheet.where(F.lower(code) == "codgeo")
    title = single(titled, F.min("row")) if header_lines is None else single(titled.where(F.col("row") < header_lines), F.max("row"))
    inside = (F.col("row") > title) & F.col("c0").isNotNull()
    if prefix is not None:
        inside = inside & code.startswith(prefix)
    # Sum every column first: one partial-aggregated row instead of a row per cell.
    sums = sheet.groupBy().agg(*[F.sum(F.when(inside, french_number(F.col(c)))).alias(c) for c in values])
    where = "line of the sheet" if header_lines is None else f"line above line {header_lines}"
    known = single(header, F.collect_list(F.struct("column", "sex", "age")))
    checked = F.when(title.isNotNull(), known).otherwise(F.raise_error(F.lit(f"no CODGEO {where}")).cast("array<struct<column:string,sex:string,age:int>>"))
    column_sums = F.map_from_arrays(F.array(*[F.lit(c) for c in values]), F.array(*[F.col(c) for c in values]))
    return (
        sums.select(column_sums.alias("sums"), checked.alias("known"))
        .select("sums", F.explode("known").alias("cell"))
        .groupBy("cell.age", "cell.sex")
        .agg(F.sum(F.try_element_at("sums", F.col("cell.column"))).alias("population"))
        .where(F.col("population") > 0)
    )


def _values(sheet: DataFrame) -> list[str]:
    return [c for c in sheet.columns if c not in ("row", "c0", "c1")]


def band_labels(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(BAND_LABELS.items()), "label string, start int")


def bands_from_labels(table: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, male, female) cells -> (start, male, female); other lines drop out."""
    return table.select(
        F.trim("label").alias("label"),
        french_number(F.col("male")).alias("male"),
        french_number(F.col("female")).alias("female"),
    ).join(F.broadcast(labels), "label").select("start", "male", "female")


def expand_bands(bands: DataFrame, open_end_start: int, max_age: int = 100) -> DataFrame:
    """Spread five-year bands evenly over their ages; the open band ends at ``max_age``."""
    last = F.when(F.col("start") >= open_end_start, F.lit(max_age)).otherwise(F.col("start") + 4)
    first = F.when(F.col("start") >= open_end_start, F.lit(open_end_start)).otherwise(F.col("start"))
    return (
        bands.unpivot(["start"], ["male", "female"], "sex", "band_population")
        .where(F.col("band_population") > 0)
        .select(
            F.explode(F.sequence(first, last)).alias("age"),
            "sex",
            (F.col("band_population") / (last - first + 1)).alias("population"),
        )
    )
