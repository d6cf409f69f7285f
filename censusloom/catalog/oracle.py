"""The catalogue's queries in SQL, written on their own for comparison.

Each query is a final SELECT over named building blocks; only the blocks it
needs, directly or through others, become its WITH list.
"""

from __future__ import annotations

import re

from censusloom.catalog.queries import RATIOS

BLOCKS: dict[str, str] = {}

# -- persons (lineitem) --------------------------------------------------------

BLOCKS["x_person"] = """
SELECT l.*, l_orderkey % 25 AS d, (l_suppkey + l_linenumber) % 20 AS c,
       lpad(CAST(l_orderkey % 25 + 1 AS VARCHAR), 2, '0') AS dept,
       CASE WHEN l_orderkey % 97 = 0 THEN NULL WHEN l_linestatus = 'O' THEN 'male' ELSE 'female' END AS sex,
       CAST(n_regionkey AS VARCHAR) AS region
FROM lineitem l JOIN nation ON n_nationkey = l_orderkey % 25"""

BLOCKS["x_place"] = """
SELECT *, dept || lpad(CAST(c AS VARCHAR), 3, '0') AS commune FROM x_person"""

BLOCKS["x_census"] = """
SELECT dept, region, sex,
       CASE WHEN c = 7 THEN '' ELSE dept || lpad(CAST(c % 5 AS VARCHAR), 2, '0') END AS canton,
       CASE WHEN dept IN ('24', '25') OR l_partkey % 7 = 0 THEN 'ZZZZZZZZZ'
            WHEN l_partkey % 11 = 0 THEN commune || 'XXXX'
            ELSE commune || lpad(CAST(l_partkey % 3 AS VARCHAR), 4, '0') END AS iris,
       CASE WHEN l_partkey % 101 <> 100 THEN CAST((l_partkey * 7 + l_orderkey) % 100 AS INTEGER) END AS age,
       CASE WHEN l_partkey % 103 <> 102 THEN l_quantity END AS w
FROM x_place"""

BLOCKS["x_base"] = """
SELECT 2022 AS year, dept AS department_code, region AS region_code, canton AS canton_code,
       CASE iris WHEN 'ZZZZZZZZZ' THEN '' ELSE substr(iris, 1, 5) END AS commune_code,
       iris AS iris_code, age, sex, SUM(w) AS population
FROM x_census WHERE age IS NOT NULL AND w IS NOT NULL GROUP BY ALL"""

BLOCKS["x_banded"] = """
SELECT *, CASE WHEN age >= 95 THEN '95_plus'
               ELSE CAST(age - age % 5 AS VARCHAR) || '_' || CAST(age - age % 5 + 4 AS VARCHAR) END AS age_band,
       iris_code NOT LIKE 'ZZZ%' AND iris_code NOT LIKE '%XXXX' AS usable
FROM x_base"""

# -- birth months ----------------------------------------------------------------

BLOCKS["x_birth"] = """
SELECT CASE WHEN d % 3 = 0 THEN '99' ELSE dept END AS department_code, region AS region_code,
       CAST(month(l_shipdate) AS INTEGER) AS month, l_quantity AS w
FROM x_person
WHERE l_partkey % 50 <> 0 AND NOT (dept IN ('05', '10') AND l_linenumber > 1)"""

BLOCKS["x_dim"] = """
SELECT lpad(CAST(n_nationkey + 1 AS VARCHAR), 2, '0') AS department_code,
       CAST(n_regionkey AS VARCHAR) AS region_code, n_nationkey < 20 AS is_metro FROM nation
UNION ALL SELECT '26', NULL, false UNION ALL SELECT '27', '9', false"""

BLOCKS["x_big"] = """
SELECT department_code FROM x_birth WHERE department_code IN (SELECT department_code FROM x_dim)
GROUP BY 1 HAVING SUM(w) >= (SELECT AVG(s) FROM (
    SELECT SUM(w) AS s FROM x_birth WHERE department_code IN (SELECT department_code FROM x_dim) GROUP BY department_code) k)"""

BLOCKS["x_own"] = """
SELECT department_code, month, SUM(w) / SUM(SUM(w)) OVER (PARTITION BY department_code) AS month_ratio
FROM x_birth WHERE department_code IN (SELECT department_code FROM x_big) GROUP BY 1, 2"""

BLOCKS["x_region_months"] = """
SELECT region_code, month, SUM(w) / SUM(SUM(w)) OVER (PARTITION BY region_code) AS month_ratio
FROM x_birth GROUP BY 1, 2"""

BLOCKS["x_metro_months"] = """
SELECT month, SUM(w) / SUM(SUM(w)) OVER () AS month_ratio
FROM x_birth WHERE department_code IN (SELECT department_code FROM x_dim WHERE is_metro) GROUP BY 1"""

BLOCKS["x_births"] = """
SELECT d.department_code, coalesce(o.month, r.month, m.month) AS month,
       coalesce(o.month_ratio, r.month_ratio, m.month_ratio) AS month_ratio
FROM x_dim d
CROSS JOIN (SELECT unnest(range(1, 13)) AS month) k
LEFT JOIN x_own o ON o.department_code = d.department_code AND o.month = k.month
LEFT JOIN x_region_months r ON r.region_code = d.region_code AND r.month = k.month
     AND d.department_code NOT IN (SELECT department_code FROM x_big)
LEFT JOIN x_metro_months m ON m.month = k.month
     AND d.department_code NOT IN (SELECT department_code FROM x_big)
     AND coalesce(d.region_code, '-') NOT IN (SELECT region_code FROM x_birth)
WHERE coalesce(o.month, r.month, m.month) IS NOT NULL"""

# -- communes (customer) ------------------------------------------------------------

BLOCKS["x_customer"] = """
SELECT *, lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') AS dept, c_custkey % 20 AS s,
       lpad(CAST(c_nationkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(c_custkey % 20 AS VARCHAR), 3, '0') AS commune
FROM customer"""

BLOCKS["x_commune"] = """
SELECT commune AS commune_code,
       'E' || CAST(c_nationkey // 2 AS VARCHAR) || '_' || CAST(s % 4 AS VARCHAR) AS epci_code,
       'Commune ' || commune AS commune_name, dept AS department_code,
       CAST(SUM(CASE WHEN c_mktsegment = 'BUILDING' THEN 0 ELSE c_custkey % 9 * 10 END) AS BIGINT) AS commune_population
FROM x_customer WHERE s <> 19 GROUP BY ALL"""

BLOCKS["x_epci_of"] = "SELECT commune_code, epci_code FROM x_commune"

BLOCKS["x_cog"] = """
SELECT DISTINCT commune AS commune_code, dept AS department_code,
       dept || lpad(CAST(s % 5 AS VARCHAR), 2, '0') AS canton_code FROM x_customer"""

# -- shares ---------------------------------------------------------------------------

BLOCKS["x_epci_pop"] = """
SELECT department_code, epci_code, age_band, sex, SUM(population) AS p
FROM x_banded JOIN x_epci_of USING (commune_code)
WHERE iris_code <> 'ZZZZZZZZZ' GROUP BY ALL"""

BLOCKS["x_ratio_epci"] = """
SELECT department_code, epci_code, age_band, sex,
       p / SUM(p) OVER (PARTITION BY department_code, age_band, sex) AS geo_ratio
FROM x_epci_pop WHERE sex IS NOT NULL
UNION ALL
SELECT DISTINCT department_code, department_code, age_band, sex, CAST(1 AS DOUBLE)
FROM x_banded WHERE department_code IN (SELECT department_code FROM x_fallback_epci)"""

BLOCKS["x_fallback_epci"] = """
SELECT department_code FROM x_base GROUP BY 1 HAVING bool_or(iris_code = 'ZZZZZZZZZ')
EXCEPT SELECT department_code FROM x_epci_pop"""

BLOCKS["x_ratio_iris"] = """
SELECT department_code, region_code, commune_code, iris_code, epci_code, age_band, sex,
       SUM(population) / SUM(SUM(population)) OVER (PARTITION BY department_code, age_band, sex) AS geo_ratio
FROM x_banded LEFT JOIN x_epci_of USING (commune_code)
WHERE usable AND sex IS NOT NULL GROUP BY 1, 2, 3, 4, 5, 6, 7
UNION ALL
SELECT DISTINCT department_code, region_code, commune_code, iris_code, NULL, age_band, sex, CAST(1 AS DOUBLE)
FROM x_banded
WHERE department_code IN (SELECT department_code FROM x_banded GROUP BY 1
                          HAVING bool_or(iris_code = 'ZZZZZZZZZ') AND NOT bool_or(usable))"""

BLOCKS["x_ratio_canton"] = """
SELECT department_code, region_code, canton_code, age_band, sex,
       SUM(population) / SUM(SUM(population)) OVER (PARTITION BY department_code, age_band, sex) AS geo_ratio
FROM x_banded WHERE canton_code <> '' AND sex IS NOT NULL GROUP BY 1, 2, 3, 4, 5"""

# -- mobility ---------------------------------------------------------------------------

BLOCKS["x_trip"] = """
SELECT dept AS department_code, sex, l_quantity AS w,
       CASE WHEN dept = '25' OR (dept = '24' AND l_linenumber <= 2) OR l_linenumber > 5 THEN '25'
            WHEN l_linenumber <= 2 THEN '15' ELSE '18' END AS age_group,
       CASE WHEN l_partkey % 107 <> 0
            THEN lpad(CAST((CASE WHEN l_partkey % 10 >= d % 10 THEN d ELSE l_suppkey % 25 END) + 1 AS VARCHAR), 2, '0')
                 || lpad(CAST((l_partkey + l_linenumber) % 20 AS VARCHAR), 3, '0') END AS study_commune
FROM x_place"""

BLOCKS["x_role"] = """
SELECT * FROM (VALUES ('15', '15_19', CAST(0.75 AS DOUBLE), true), ('18', '15_19', CAST(0.25 AS DOUBLE), false),
                      ('18', '20_24', CAST(1 AS DOUBLE), true)) r(age_group, age_band, part, is_main)"""

BLOCKS["x_rate"] = """
SELECT age_band, department_code, SUM(part * away) AS mobility_rate
FROM (SELECT age_band, department_code, is_main, part,
             SUM(CASE WHEN substr(study_commune, 1, 2) <> department_code THEN w ELSE 0 END) / SUM(w) AS away
      FROM x_trip JOIN x_role USING (age_group) GROUP BY ALL) r
GROUP BY 1, 2 HAVING bool_or(is_main)"""

BLOCKS["x_weight"] = """
SELECT b.age_band, d.department_code, coalesce(mobility_rate, b.fallback) AS mobility_rate,
       CASE WHEN mobility_rate IS NULL THEN b.fallback WHEN mobility_rate > b.cap THEN b.cap
            ELSE mobility_rate END AS blend_weight
FROM (SELECT DISTINCT department_code FROM x_base) d
CROSS JOIN (VALUES ('15_19', CAST(0.25 AS DOUBLE), CAST(0.1 AS DOUBLE)),
                   ('20_24', CAST(0.6 AS DOUBLE), CAST(0.3 AS DOUBLE))) b(age_band, cap, fallback)
LEFT JOIN x_rate r ON r.department_code = d.department_code AND r.age_band = b.age_band"""

BLOCKS["x_flow_epci"] = """
SELECT age_band, department_code, epci_code, sex,
       SUM(s) / SUM(SUM(s)) OVER (PARTITION BY age_band, department_code, sex) AS study_geo_ratio
FROM (SELECT age_band, department_code, epci_code, sex, part,
             part * SUM(w) / SUM(SUM(w)) OVER (PARTITION BY age_band, age_group, department_code, sex) AS s
      FROM x_trip JOIN x_role USING (age_group) JOIN x_epci_of ON commune_code = study_commune
      WHERE sex IS NOT NULL GROUP BY age_band, age_group, department_code, epci_code, sex, part) r
GROUP BY 1, 2, 3, 4"""

BLOCKS["x_area"] = """
SELECT commune_code, department_code, region_code, iris_code, epci_code, SUM(population) AS iris_pop,
       SUM(SUM(population)) OVER (PARTITION BY commune_code) AS commune_pop
FROM x_banded LEFT JOIN x_epci_of USING (commune_code) WHERE usable GROUP BY 1, 2, 3, 4, 5"""

BLOCKS["x_flow_iris"] = """
SELECT age_band, department_code, iris_dept, region_code, commune_code, iris_code, epci_code, sex,
       SUM(s) / SUM(SUM(s)) OVER (PARTITION BY age_band, department_code, sex) AS study_geo_ratio
FROM (SELECT age_band, t.department_code, a.department_code AS iris_dept, a.region_code, a.commune_code, a.iris_code,
             a.epci_code, sex,
             part * SUM(w * iris_pop / commune_pop)
                  / SUM(SUM(w * iris_pop / commune_pop)) OVER (PARTITION BY age_band, age_group, t.department_code, sex)
             AS s
      FROM x_trip t JOIN x_role USING (age_group) JOIN x_area a ON a.commune_code = t.study_commune
      WHERE sex IS NOT NULL
      GROUP BY age_band, age_group, t.department_code, iris_dept, a.region_code, a.commune_code, a.iris_code,
               a.epci_code, sex, part) r
GROUP BY 1, 2, 3, 4, 5, 6, 7, 8"""

BLOCKS["x_blend_epci"] = """
SELECT department_code, epci_code, age_band, sex,
       coalesce(raw / nullif(SUM(raw) OVER (PARTITION BY department_code, age_band, sex), 0), 0) AS geo_ratio
FROM (SELECT r.department_code, r.epci_code, r.age_band, r.sex,
             (1 - blend_weight) * geo_ratio + blend_weight * coalesce(study_geo_ratio, 0) AS raw
      FROM x_ratio_epci r JOIN x_weight w ON w.department_code = r.department_code AND w.age_band = r.age_band
      LEFT JOIN x_flow_epci f ON f.department_code = r.department_code AND f.age_band = r.age_band
           AND f.sex = r.sex AND f.epci_code = r.epci_code
      WHERE r.sex IS NOT NULL
      UNION ALL
      SELECT f.department_code, f.epci_code, f.age_band, f.sex, blend_weight * study_geo_ratio
      FROM x_flow_epci f JOIN x_weight w ON w.department_code = f.department_code AND w.age_band = f.age_band
      WHERE study_geo_ratio > 0
        AND (f.department_code, f.sex) IN (SELECT (department_code, sex) FROM x_ratio_epci)
        AND (f.department_code, f.age_band, f.sex) NOT IN
            (SELECT (department_code, age_band, sex) FROM x_ratio_epci WHERE sex IS NOT NULL)) b
UNION ALL SELECT * FROM x_ratio_epci WHERE age_band NOT IN ('15_19', '20_24')"""

BLOCKS["x_intra"] = """
SELECT age_band, department_code, sex,
       SUM(CASE WHEN iris_dept = department_code THEN study_geo_ratio ELSE 0 END) AS intra_frac
FROM x_flow_iris GROUP BY 1, 2, 3"""

# What the blend needs of the flows, in one row for each department, band and sex.
BLOCKS["x_home"] = """
SELECT age_band, department_code, sex, SUM(study_geo_ratio) FILTER (WHERE iris_dept = department_code) AS intra_frac,
       map_from_entries(list((iris_code, study_geo_ratio)) FILTER (WHERE iris_dept = department_code)) AS home
FROM x_flow_iris GROUP BY 1, 2, 3"""

BLOCKS["x_blend_iris"] = """
SELECT department_code, region_code, commune_code, iris_code, epci_code, age_band, sex,
       raw / SUM(raw) OVER (PARTITION BY department_code, age_band, sex) AS geo_ratio
FROM (SELECT r.* EXCLUDE (geo_ratio),
             (1 - blend_weight * coalesce(intra_frac, 0)) * geo_ratio
             + blend_weight * coalesce(map_extract(home, r.iris_code)[1], 0) AS raw
      FROM x_ratio_iris r JOIN x_weight w ON w.department_code = r.department_code AND w.age_band = r.age_band
      LEFT JOIN x_home h ON h.department_code = r.department_code AND h.age_band = r.age_band AND h.sex = r.sex
      WHERE r.sex IS NOT NULL) b
UNION ALL SELECT * FROM x_ratio_iris WHERE age_band NOT IN ('15_19', '20_24')"""

# -- projection -----------------------------------------------------------------------------

BLOCKS["x_dept"] = """
SELECT department_code, age, sex, SUM(population) AS population,
       MIN(MIN(region_code)) OVER (PARTITION BY department_code) AS region_code
FROM x_base GROUP BY department_code, age, sex"""

BLOCKS["x_nation"] = "SELECT age, sex, SUM(population) AS total FROM x_base GROUP BY 1, 2"

BLOCKS["x_share"] = """
SELECT d.department_code, d.region_code, d.age, d.sex, d.population / n.total AS dept_share
FROM x_dept d JOIN x_nation n ON n.age = d.age AND n.sex = d.sex"""

BLOCKS["x_years"] = "SELECT CAST(unnest(range(2019, 2028)) AS INTEGER) AS year"

BLOCKS["x_stable_raw"] = """
SELECT y.year, 1 AS month, s.department_code, s.region_code, s.age, s.sex, n.total * s.dept_share AS population
FROM x_share s CROSS JOIN x_years y JOIN x_nation n ON n.age = s.age - (y.year - 2022) AND n.sex = s.sex
WHERE s.age BETWEEN 15 AND 24"""

BLOCKS["x_aging_raw"] = """
SELECT y.year, 1 AS month, department_code, region_code, CAST(age + y.year - 2022 AS INTEGER) AS age, sex, population
FROM x_dept CROSS JOIN x_years y WHERE age + y.year - 2022 BETWEEN 15 AND 24"""

BLOCKS["x_estimates_wide"] = """
SELECT CAST(o_orderkey % 8 + 2019 AS INTEGER) AS year, CAST(o_custkey % 18 + 1995 AS INTEGER) AS naissance,
       CAST(SUM(CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 50 + 1 END) AS DOUBLE) AS male,
       CAST(SUM(CASE WHEN o_orderstatus <> 'O' THEN o_custkey % 50 + 1 END) AS DOUBLE) AS female
FROM orders GROUP BY 1, 2
HAVING naissance % 13 <> 0 AND NOT (year = 2021 AND naissance = 2003) AND male IS NOT NULL AND female IS NOT NULL"""

BLOCKS["x_estimates"] = """
SELECT year, naissance, 'male' AS sex, male AS population FROM x_estimates_wide
UNION ALL SELECT year, naissance, 'female', female FROM x_estimates_wide"""


def finish(raw: str) -> str:
    """Dates and bounds of a projected block."""
    return f"""
SELECT year, month, make_date(year, month, 1) AS snapshot_month, make_date(year - age, 1, 1) AS born_date,
       (12 * age + month - 1) / CAST(12 AS DOUBLE) AS decimal_age, department_code, region_code, age, sex,
       'exact' AS geo_precision, population, m AS confidence_pct,
       population * (1 - m) AS population_low, population * (1 + m) AS population_high
FROM (SELECT *, CAST(CASE WHEN abs(year - 2022) < 2 THEN 0.02 WHEN abs(year - 2022) < 4 THEN 0.03
                          ELSE abs(year - 2022) / 100 END AS DOUBLE) AS m FROM {raw}) p
WHERE population > 0"""


BLOCKS["x_stable"] = finish("x_stable_raw")
BLOCKS["x_aging"] = finish("x_aging_raw")
# Monthly, every birth month of the department is a snapshot.
BLOCKS["x_monthly_raw"] = """
SELECT s.* EXCLUDE (month), b.month FROM x_stable_raw s JOIN x_births b USING (department_code)"""
BLOCKS["x_monthly"] = finish("x_monthly_raw")


def anchored(projected: str) -> str:
    return f"""
SELECT p.* REPLACE (population * f AS population, population_low * f AS population_low,
                    population_high * f AS population_high)
FROM (SELECT q.*, CASE WHEN department_code IN ('22', '23') THEN CAST(1 AS DOUBLE)
                       ELSE coalesce(e.population / k.total, 1) END AS f
      FROM {projected} q
      JOIN (SELECT year, month, age, sex, SUM(CASE WHEN department_code NOT IN ('22', '23') THEN population END) AS total
            FROM {projected} GROUP BY ALL) k USING (year, month, age, sex)
      LEFT JOIN x_estimates e ON e.year = least(q.year, 2026) AND e.naissance = q.year - q.age AND e.sex = q.sex) p"""


BLOCKS["x_anchored_f"] = anchored("x_stable")
BLOCKS["x_anchored"] = "SELECT * EXCLUDE (f) FROM x_anchored_f"
BLOCKS["x_anchored_monthly_f"] = anchored("x_monthly")
BLOCKS["x_anchored_monthly"] = "SELECT * EXCLUDE (f) FROM x_anchored_monthly_f"


def level(parent: str, ratios: str, extra: str, geo: str) -> str:
    return f"""
SELECT year, month, snapshot_month, born_date, decimal_age, {geo}, age, sex, geo_precision,
       p * g AS population, m AS confidence_pct, p * g * (1 - m) AS population_low, p * g * (1 + m) AS population_high
FROM (SELECT d.* EXCLUDE (population, confidence_pct), r.* EXCLUDE (department_code, sex, geo_ratio),
             d.population AS p, r.geo_ratio AS g, d.confidence_pct + CAST({extra} AS DOUBLE) AS m
      FROM {parent} d JOIN {ratios} r ON r.department_code = d.department_code AND r.sex = d.sex
           AND r.age_band = CASE WHEN d.age < 20 THEN '15_19' ELSE '20_24' END) j
WHERE p * g > 0"""


EPCI_GEO = "department_code, region_code, epci_code"
BLOCKS["x_level_epci"] = level("x_stable", "x_ratio_epci", "0.03", EPCI_GEO)
BLOCKS["x_level_blend"] = level("x_stable", "x_blend_epci", "0.03", EPCI_GEO)
BLOCKS["x_stable_bare"] = "SELECT * EXCLUDE (region_code) FROM x_stable"
BLOCKS["x_level_canton"] = level(
    "x_stable_bare", "x_ratio_canton", "0.05", "department_code, region_code, canton_code"
)
BLOCKS["x_level_iris"] = level(
    "x_stable_bare", "x_ratio_iris", "0.1", "department_code, region_code, epci_code, commune_code, iris_code"
)


def expanded(lv: str, geo: str) -> str:
    return f"""
SELECT year, l.month, b.month AS birth_month, snapshot_month, make_date(year - age, b.month, 1) AS born_date,
       (12 * age + l.month - b.month) / CAST(12 AS DOUBLE) AS decimal_age, {geo}, age, sex, geo_precision,
       population * month_ratio AS population, confidence_pct,
       population * month_ratio * (1 - confidence_pct) AS population_low,
       population * month_ratio * (1 + confidence_pct) AS population_high
FROM {lv} l JOIN x_births b ON b.department_code = l.department_code
WHERE population * month_ratio > 0"""


# -- outside figures (orders) -----------------------------------------------------------------

BLOCKS["x_reference"] = """
SELECT CAST(o_orderkey % 9 + 2019 AS INTEGER) AS year, CAST(o_custkey % 5 AS VARCHAR) AS region_code,
       CAST(o_custkey % 23 + 10 AS INTEGER) AS age,
       CASE WHEN o_orderstatus = 'O' THEN 'male' ELSE 'female' END AS sex,
       CAST(o_orderkey % 50 + 1 AS DOUBLE) AS pop
FROM orders"""

BLOCKS["x_enrol_row"] = """
SELECT lpad(CAST(o_custkey % 25 + 1 AS VARCHAR), 2, '0') || lpad(CAST(o_orderkey % 20 AS VARCHAR), 3, '0') AS com_id,
       CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'UNIV' WHEN '2' THEN 'GE' WHEN '3' THEN 'STS'
            WHEN '4' THEN 'CPGE' ELSE 'ENS' END AS regroupement,
       o_orderkey % 29 = 0 AS nowhere, o_custkey % 40 + 1 AS effectif
FROM orders WHERE o_orderkey % 3 <> 0"""

BLOCKS["x_enrol"] = """
SELECT com_id, CAST(SUM(effectif) AS BIGINT) AS enrolled FROM x_enrol_row WHERE NOT nowhere GROUP BY 1"""
BLOCKS["x_enrol_degree"] = """
SELECT com_id, CAST(SUM(effectif) AS BIGINT) AS enrolled FROM x_enrol_row
WHERE NOT nowhere AND regroupement IN ('UNIV', 'GE', 'ENS') GROUP BY 1"""

BLOCKS["x_enrol_epci"] = """
SELECT epci_code, department_code, CAST(SUM(enrolled) AS BIGINT) AS enrolled
FROM x_enrol JOIN x_commune ON commune_code = com_id GROUP BY 1, 2"""

# January of 2024, used by most reports; regions and reference at the same ages.
BLOCKS["x_our_2024"] = "SELECT * FROM x_stable WHERE year = 2024"
BLOCKS["x_ref_2024"] = "SELECT * FROM x_reference WHERE year = 2024 AND age BETWEEN 15 AND 24"
BLOCKS["x_epci_2024"] = "SELECT * FROM x_level_epci WHERE year = 2024"
BLOCKS["x_iris_2024"] = "SELECT * FROM x_level_iris WHERE year = 2024"
BLOCKS["x_iris_2022"] = "SELECT * FROM x_level_iris WHERE year = 2022"
BLOCKS["x_census_area"] = """
SELECT iris_code, age, coalesce(sex, 'female') AS sex, SUM(population) AS census_pop
FROM x_base WHERE iris_code <> 'ZZZZZZZZZ' AND age BETWEEN 15 AND 24 GROUP BY ALL"""
BLOCKS["x_epci_share"] = """
SELECT epci_code, SUM(CASE WHEN age >= 20 THEN population ELSE 0 END) AS num_pop, SUM(population) AS den_pop
FROM x_epci_2024 GROUP BY 1"""
BLOCKS["x_year_share"] = """
SELECT e.year, epci_code, num_pop, den_pop, num_pop / den_pop * 100 AS share_pct, national_pct,
       num_pop / den_pop * 100 - national_pct AS delta
FROM (SELECT year, epci_code, SUM(CASE WHEN age >= 20 THEN population ELSE 0 END) AS num_pop, SUM(population) AS den_pop
      FROM x_level_epci WHERE epci_code IN ('E0_0', 'E3_1', 'E7_2', 'E11_3') GROUP BY 1, 2) e
JOIN (SELECT year, SUM(CASE WHEN age >= 20 THEN population ELSE 0 END) / SUM(population) * 100 AS national_pct
      FROM x_level_epci GROUP BY 1) n USING (year)"""
BLOCKS["x_students"] = """
SELECT epci_code, SUM(population) AS pop_20_24 FROM x_level_epci WHERE year = 2022 AND age >= 20 GROUP BY 1"""
BLOCKS["x_band_label"] = """
SELECT CAST(c_custkey % 17 * 5 AS INTEGER) AS start,
       CAST(SUM(CASE WHEN c_nationkey % 2 = 0 THEN c_custkey % 1000 ELSE 0 END) AS DOUBLE) AS male,
       CAST(SUM(CASE WHEN c_nationkey % 2 = 1 THEN c_custkey % 1000 ELSE 0 END) AS DOUBLE) AS female
FROM customer GROUP BY 1"""


def forward(segment: str, dept: str, region: str, canton: str, years: int) -> str:
    """Cells of a territory whose pyramid is one customer segment."""
    return f"""
SELECT 2022 AS year, '{dept}' AS department_code, '{region}' AS region_code, '{canton}' AS canton_code,
       '' AS commune_code, 'ZZZZZZZZZ' AS iris_code, CAST(c_custkey % 101 + {years} AS INTEGER) AS age,
       CASE WHEN c_nationkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex,
       CAST(SUM(c_custkey % 40) AS DOUBLE) AS population
FROM customer WHERE c_mktsegment = '{segment}' GROUP BY age, sex HAVING SUM(c_custkey % 40) > 0"""


BLOCKS["x_t976"] = forward("BUILDING", "976", "06", "9799", 5)
BLOCKS["x_t986"] = forward("MACHINERY", "986", "98", "9869", 0)
BLOCKS["x_t988"] = forward("HOUSEHOLD", "988", "98", "9889", 3)
BLOCKS["x_t975"] = forward("AUTOMOBILE", "975", "975", "9750", 0)

# -- queries --------------------------------------------------------------------------------------

# name -> (SELECT, columns to round: RATIOS to twelve decimals, others to six)
QUERIES: dict[str, tuple[str, str]] = {}


def q(name: str, sql: str, rounded: str = "") -> None:
    QUERIES[name] = (sql, rounded)


BOUNDS = "decimal_age population confidence_pct population_low population_high"

q("census_scan", """
SELECT rpad(dept, 3, ' ') AS "DEPT", region AS "REGION",
       CASE sex WHEN 'male' THEN '1' WHEN 'female' THEN '2' ELSE '9' END AS "SEXE",
       COUNT(*) AS n, SUM(w) AS weight, COUNT(*) - COUNT(age) AS no_birth_year
FROM x_census GROUP BY ALL""", "weight")
q("census_scan_years", """
SELECT rpad(dept, 3, ' ') AS "DEPT", region AS "REGION",
       CASE sex WHEN 'male' THEN '1' WHEN 'female' THEN '2' ELSE '9' END AS "SEXE",
       COUNT(*) AS n, SUM(w) AS weight, CASE WHEN sex = 'male' THEN COUNT(*) ELSE 0 END AS no_canton
FROM x_census GROUP BY dept, region, sex""", "weight")
q("birth_record_scan", """
SELECT department_code, region_code, month, COUNT(*) AS n, SUM(w) AS weight FROM x_birth GROUP BY ALL""", "weight")
q("flow_cells", """
SELECT department_code, study_commune, age_group, sex, SUM(w) AS weight FROM x_trip GROUP BY ALL""", "weight")
q("commune_lookup", "SELECT * FROM x_commune")
q("commune_reference", "SELECT * FROM x_cog")
q("pyramid_csv", """
SELECT CAST(o_custkey % 91 AS INTEGER) AS age, CASE o_orderstatus WHEN 'O' THEN 'male' ELSE 'female' END AS sex,
       COUNT(*) AS n, CAST(SUM(o_custkey % 30) AS DOUBLE) AS population
FROM orders WHERE o_orderkey % 5 = 4 AND o_orderstatus IN ('O', 'F') AND o_custkey % 91 < 90 AND o_custkey % 30 > 0
GROUP BY ALL""", "population")
q("reference_pyramid", "SELECT year, region_code, age, sex, SUM(pop) AS pop FROM x_reference GROUP BY ALL", "pop")
q("enrolment", "SELECT * FROM x_enrol")
q("enrolment_degrees", "SELECT * FROM x_enrol_degree")
q("level_scan", "SELECT year, epci_code, age, SUM(population) AS pop FROM x_epci_2024 GROUP BY ALL", "pop")
q("estimates_long", "SELECT * FROM x_estimates", "population")

q("base_population", "SELECT * FROM x_base", "population")
q("territory_filter", """
SELECT department_code, COUNT(*) AS cells, SUM(population) AS population FROM x_base
WHERE department_code NOT IN ('22', '23') GROUP BY 1""", "population")
q("age_band_totals", "SELECT department_code, age_band, sex, SUM(population) AS population FROM x_banded GROUP BY ALL",
  "population")
q("masked_iris_fallback", """
SELECT CASE WHEN iris_code LIKE '%XXXX' THEN commune_code ELSE iris_code END AS area, usable,
       SUM(population) AS population FROM x_banded GROUP BY ALL""", "population")
q("pyramid_unpivot", """
SELECT CAST(CASE c_custkey % 11 WHEN 10 THEN 100 ELSE c_custkey % 11 END AS INTEGER) AS age,
       CASE c_nationkey % 2 WHEN 0 THEN 'male' ELSE 'female' END AS sex,
       SUM(c_custkey % 1000 * CAST(7.5 AS DOUBLE)) AS population
FROM customer GROUP BY ALL HAVING SUM(c_custkey % 1000) > 0""", "population")
q("bands_from_labels", "SELECT * FROM x_band_label", "male female")
q("expand_bands", """
SELECT CAST(age AS INTEGER) AS age, sex, p / (CASE WHEN start = 80 THEN 21 ELSE 5 END) AS population
FROM (SELECT start, sex, p, unnest(range(start, CASE WHEN start = 80 THEN 101 ELSE start + 5 END)) AS age
      FROM (SELECT start, 'male' AS sex, male AS p FROM x_band_label
            UNION ALL SELECT start, 'female', female FROM x_band_label) s
      WHERE p > 0) b""", "population")
q("age_forward_reject", "SELECT * FROM x_t976", "population")
q("age_forward_floor", "SELECT * FROM x_t986", "population")
q("append_territories", """
SELECT department_code, region_code, age, COUNT(*) AS cells, SUM(population) AS population
FROM (SELECT * FROM x_base UNION ALL SELECT * FROM x_t976 UNION ALL SELECT * FROM x_t986
      UNION ALL SELECT * FROM x_t988 UNION ALL SELECT * FROM x_t975) a GROUP BY ALL""", "population")
q("canton_weights", """
SELECT canton_code, epci_code,
       coalesce(SUM(commune_population) / nullif(CAST(SUM(SUM(commune_population)) OVER (PARTITION BY canton_code) AS DOUBLE), 0), 0)
       AS weight
FROM x_cog g JOIN x_commune c ON c.commune_code = g.commune_code GROUP BY 1, 2""", "weight")

q("birth_month_own", "SELECT * FROM x_own", "month_ratio")
q("birth_month_region", "SELECT * FROM x_region_months", "month_ratio")
q("birth_month_national", "SELECT month, SUM(w) / SUM(SUM(w)) OVER () AS month_ratio FROM x_birth GROUP BY 1", "month_ratio")
q("birth_month_all", "SELECT * FROM x_births", "month_ratio")

q("geo_ratio_epci", "SELECT * FROM x_ratio_epci", "geo_ratio")
q("geo_ratio_iris", "SELECT * FROM x_ratio_iris", "geo_ratio")
q("geo_ratio_canton", "SELECT * FROM x_ratio_canton", "geo_ratio")
q("fallback_departments", "SELECT * FROM x_fallback_epci")
q("ratio_sizes", """
SELECT COUNT(*) AS n_rows, COUNT(DISTINCT epci_code) AS n_areas, 'epci' AS level FROM x_ratio_epci
UNION ALL SELECT COUNT(*), COUNT(DISTINCT canton_code), 'canton' FROM x_ratio_canton
UNION ALL SELECT COUNT(*), COUNT(DISTINCT iris_code), 'iris' FROM x_ratio_iris""")

q("mobility_rates", "SELECT * FROM x_rate", "mobility_rate")
q("mobility_weights", "SELECT * FROM x_weight", "mobility_rate blend_weight")
q("student_flows_epci", "SELECT * FROM x_flow_epci", "study_geo_ratio")
q("iris_commune_share", "SELECT * FROM x_area", "iris_pop commune_pop")
q("student_flows_iris", "SELECT * FROM x_flow_iris", "study_geo_ratio")
q("blend_epci", "SELECT * FROM x_blend_epci", "geo_ratio")
q("intra_fraction", "SELECT * FROM x_intra", "intra_frac")
q("blend_iris", "SELECT * FROM x_blend_iris", "geo_ratio")

q("census_departments", "SELECT * FROM x_dept", "population")
q("cohort_totals", "SELECT * FROM x_nation", "total")
q("dept_age_shares", "SELECT * FROM x_share", "dept_share")
q("project_aging", "SELECT * FROM x_aging", BOUNDS)
q("project_stable", "SELECT * FROM x_stable", BOUNDS)
q("project_estimates", "SELECT * FROM x_anchored", BOUNDS)
q("project_monthly", "SELECT * FROM x_anchored_monthly", BOUNDS)
q("uncovered_cells", """
SELECT y.year, CAST(a.age AS INTEGER) AS age, s.sex
FROM x_years y CROSS JOIN (SELECT unnest(range(0, 111)) AS age) a CROSS JOIN (VALUES ('male'), ('female')) s(sex)
WHERE NOT EXISTS (SELECT 1 FROM x_nation n WHERE n.age = a.age AND n.sex = s.sex)
   OR NOT EXISTS (SELECT 1 FROM x_nation n WHERE n.age = a.age - (y.year - 2022) AND n.sex = s.sex)""")
q("disaggregate_epci", "SELECT * FROM x_level_epci", BOUNDS)
q("disaggregate_canton", "SELECT * FROM x_level_canton", BOUNDS)
q("disaggregate_iris", """
SELECT year, department_code, region_code, epci_code, commune_code, iris_code, confidence_pct, COUNT(*) AS cells,
       SUM(population) AS population, SUM(population_low) AS population_low, SUM(population_high) AS population_high
FROM x_level_iris GROUP BY ALL""", "confidence_pct population population_low population_high")
# The same level over all ages: the stable projection without an age window, joined on the band of each age.
BLOCKS["x_wide_raw"] = BLOCKS["x_stable_raw"].replace("s.age BETWEEN 15 AND 24", "s.age BETWEEN 0 AND 110")
BLOCKS["x_wide"] = "SELECT * FROM (" + finish("x_wide_raw") + ") w"
BAND = """CASE WHEN d.age >= 95 THEN '95_plus'
     ELSE CAST(d.age - d.age % 5 AS VARCHAR) || '_' || CAST(d.age - d.age % 5 + 4 AS VARCHAR) END"""
for lv, ratios in (("epci", "x_ratio_epci"), ("canton", "x_ratio_canton"), ("iris", "x_ratio_iris")):
    q(f"all_ages_{lv}", f"""
SELECT year, {lv}_code, r.age_band, COUNT(*) AS cells, SUM(d.population * geo_ratio) AS population
FROM x_wide d JOIN {ratios} r ON r.department_code = d.department_code AND r.sex = d.sex AND r.age_band = {BAND}
WHERE d.population * geo_ratio > 0 GROUP BY ALL""", "population")
for lv, ratios, parent in (("epci", "x_ratio_epci", "x_monthly"), ("iris", "x_ratio_iris", "x_monthly_bare")):
    BLOCKS[f"x_monthly_{lv}"] = level(parent, ratios, "0.03", f"department_code, {lv}_code")
    q(f"monthly_{lv}", "SELECT year, month, department_code, COUNT(*) AS cells, SUM(population) AS population FROM ("
      + expanded(f"x_monthly_{lv}", "l.department_code") + ") e GROUP BY ALL", "population")
BLOCKS["x_monthly_bare"] = "SELECT * EXCLUDE (region_code) FROM x_monthly"
q("disaggregate_blended", "SELECT * FROM x_level_blend", BOUNDS)
q("expand_birth_month", "SELECT * FROM ("
  + expanded("x_stable", "l.department_code, region_code") + ") e", BOUNDS)
q("expand_birth_month_iris", """
SELECT department_code, iris_code, birth_month, COUNT(*) AS cells, SUM(population) AS population
FROM (""" + expanded("x_level_iris", "l.department_code, iris_code") + """) e GROUP BY ALL""", "population")
q("yearly_downsample", """
SELECT year, department_code, COUNT(*) AS cells, SUM(population) AS population
FROM x_monthly WHERE month = 1 GROUP BY ALL""", "population")
q("write_level", """
SELECT year, epci_code, department_code, birth_month, COUNT(*) AS n, SUM(population) AS population
FROM (""" + expanded("x_level_epci", "l.department_code, epci_code") + """) e GROUP BY ALL""", "population")
q("export_levels", """
SELECT 'department' AS level, year, month, COUNT(*) AS n, SUM(population) AS population
FROM (""" + expanded("x_monthly", "l.department_code") + """) e GROUP BY ALL
UNION ALL
SELECT 'canton', year, month, COUNT(*), SUM(population)
FROM (""" + expanded("x_level_canton", "l.department_code") + """) e GROUP BY ALL""", "population")

q("rewrite_year", """
SELECT year, canton_code, COUNT(*) AS n, SUM(CASE WHEN year = 2024 THEN 2 * population ELSE population END) AS population
FROM (""" + expanded("x_level_canton", "l.department_code, canton_code") + """) e GROUP BY 1, 2""", "population")
BLOCKS["x_exported"] = " UNION ALL ".join(
    f"""SELECT '{level}' AS level, {code} AS code, department_code, year, month, age, population
FROM (""" + expanded(t, columns) + ") e"
    for level, t, code, columns in (
        ("department", "x_stable", "department_code", "l.department_code"),
        ("epci", "x_level_epci", "epci_code", "l.department_code, epci_code"),
        ("canton", "x_level_canton", "canton_code", "l.department_code, canton_code"),
    )
)
q("export_stats", """
SELECT level, COUNT(*) AS n_rows, SUM(population) AS population, COUNT(DISTINCT code) AS n_areas,
       round(100 * SUM(population) / (SELECT SUM(population) FROM x_exported WHERE level = 'department'), 1) AS coverage_pct,
       SUM(population) / (COUNT(DISTINCT year) * COUNT(DISTINCT month)) AS avg_snapshot
FROM x_exported GROUP BY 1""", "population avg_snapshot")
q("export_validation", """
SELECT level, COUNT(*) AS total_rows, SUM(population) AS total_population, COUNT(DISTINCT department_code) AS departments,
       COUNT(DISTINCT year) AS years, MIN(age) AS min_age, MAX(age) AS max_age,
       COUNT(*) FILTER (WHERE population IS NULL OR population < 0) AS invalid_rows,
       COUNT(*) FILTER (WHERE population IS NULL OR population < 0) = 0 AS is_valid
FROM x_exported GROUP BY 1""", "total_population")

q("row_count", "SELECT COUNT(*) AS n_rows FROM x_base")
q("validation_stats", """
SELECT COUNT(*) AS total_rows, SUM(population) AS total_population, COUNT(DISTINCT department_code) AS departments,
       COUNT(DISTINCT year) AS years, MIN(age) AS min_age, MAX(age) AS max_age FROM x_base""", "total_population")
q("invalid_rows", "SELECT COUNT(*) FILTER (WHERE population IS NULL OR population < 0) AS invalid_rows FROM x_base")
BLOCKS["x_expected"] = """
SELECT department_code, CASE WHEN department_code <= '20' THEN 'metro' WHEN department_code <= '22' THEN 'dom'
       WHEN department_code IN ('23', '26') THEN 'mayotte' ELSE 'tom' END AS territory,
       department_code IN (SELECT department_code FROM x_base) AS present FROM x_dim"""
q("department_coverage", "SELECT * FROM x_expected")
q("validate", """
SELECT COUNT(*) FILTER (WHERE population IS NULL OR population < 0) AS invalid_rows,
       COUNT(*) FILTER (WHERE population IS NULL OR population < 0) = 0 AS is_valid,
       COUNT(*) AS total_rows, SUM(population) AS total_population, COUNT(DISTINCT department_code) AS departments,
       COUNT(DISTINCT year) AS years, MIN(age) AS min_age, MAX(age) AS max_age,
       """ + ", ".join(
    f"""(SELECT coalesce(string_agg(department_code, ',' ORDER BY department_code), '') FROM x_expected
        WHERE territory = '{t}' AND {p}) AS {name}"""
    for t, p, name in (
        ("metro", "NOT present", "missing_metro"), ("dom", "NOT present", "missing_dom"),
        ("tom", "NOT present", "missing_tom"), ("dom", "present", "dom_present"), ("tom", "present", "tom_present"),
    )
) + """, (SELECT bool_or(present) FROM x_expected WHERE territory = 'mayotte') AS mayotte_present
FROM x_base""", "total_population")
BLOCKS["x_all_levels"] = """
SELECT 'department' AS level, department_code AS code, year, population FROM x_stable
UNION ALL SELECT 'epci', epci_code, year, population FROM x_level_epci
UNION ALL SELECT 'canton', canton_code, year, population FROM x_level_canton
UNION ALL SELECT 'iris', iris_code, year, population FROM x_level_iris"""
q("level_stats", """
SELECT level, COUNT(*) AS n_rows, SUM(population) AS population, COUNT(DISTINCT code) AS n_areas,
       round(100 * SUM(population) / (SELECT SUM(population) FROM x_stable), 1) AS coverage_pct,
       SUM(population) / 9 AS avg_snapshot
FROM x_all_levels GROUP BY 1""", "population avg_snapshot")
q("level_summary", """
SELECT COUNT(*) AS n_rows, SUM(population) AS population, COUNT(DISTINCT canton_code) AS n_areas,
       COUNT(DISTINCT year) AS n_years, COUNT(DISTINCT age) AS n_ages,
       SUM(population) / (COUNT(DISTINCT year) * 12) AS avg_month,
       SUM(population) / (COUNT(DISTINCT year) * 12) / COUNT(DISTINCT age) AS avg_age
FROM x_level_canton""", "population avg_month avg_age")
q("null_audit", "SELECT " + ", ".join(
    f"COUNT(*) - COUNT({c}) AS {c}_nulls" for c in ("department_code", "iris_code", "sex", "age", "population")
) + " FROM x_base")
q("share_sum_audit", """
SELECT department_code, age_band, sex, SUM(geo_ratio) AS ratio_sum, SUM(geo_ratio) BETWEEN 0.999 AND 1.001 AS ok
FROM x_blend_epci GROUP BY 1, 2, 3""", "ratio_sum")
for child, low in (("epci", "0.95"), ("iris", "0")):
    q(f"child_parent_{child}", f"""
SELECT year, month, department_code, age, sex, p.population AS parent_pop, c.population AS child_pop,
       c.population / p.population AS ratio,
       c.population / p.population BETWEEN {low} AND {'1.05' if child == 'epci' else '1.01'} AS ok
FROM x_stable p JOIN (SELECT year, month, department_code, age, sex, SUM(population) AS population
                      FROM x_level_{child} GROUP BY ALL) c USING (year, month, department_code, age, sex)""",
      "parent_pop child_pop ratio")
q("coverage_by_department", """
SELECT department_code, dept_pop, coalesce(e, 0) AS epci_pop, coalesce(i, 0) AS iris_pop,
       coalesce(e, 0) / dept_pop AS epci_ratio, coalesce(i, 0) / dept_pop AS iris_ratio
FROM (SELECT department_code, SUM(population) AS dept_pop FROM x_stable GROUP BY 1) d
LEFT JOIN (SELECT department_code, SUM(population) AS e FROM x_level_epci GROUP BY 1) x USING (department_code)
LEFT JOIN (SELECT department_code, SUM(population) AS i FROM x_level_iris GROUP BY 1) y USING (department_code)""",
  "dept_pop epci_pop iris_pop epci_ratio iris_ratio")
q("yoy_change", """
SELECT year, total_pop, change, change < 0.03 AS ok
FROM (SELECT a.year, a.t AS total_pop, abs(a.t - b.t) / b.t AS change
      FROM (SELECT year, SUM(population) AS t FROM x_stable GROUP BY 1) a
      JOIN (SELECT year + 1 AS year, SUM(population) AS t FROM x_stable GROUP BY 1) b USING (year)) c""", "total_pop change")
q("bounds", """
SELECT MIN(population) AS min_pop, MAX(population) AS max_pop, AVG(population) AS avg_pop,
       MIN(population) > 0 AND MAX(population) < 60000 AND AVG(population) BETWEEN 600 AND 12000 AS ok FROM x_stable""",
  "min_pop max_pop avg_pop")
q("relative_bounds", """
WITH cell AS (
  SELECT department_code, CAST(ceil(ln(population) / ln(1.01 / 0.99)) AS INTEGER) AS bucket, COUNT(*) AS n
  FROM x_stable WHERE population > 0 GROUP BY 1, 2
),
upto AS (
  SELECT *, SUM(n) OVER (PARTITION BY department_code ORDER BY bucket) AS below, SUM(n) OVER (PARTITION BY department_code) AS whole
  FROM cell
),
level AS (
  SELECT department_code, 2.0 * pow(1.01 / 0.99, MIN(bucket) FILTER (WHERE below >= 0.5 * whole)) / (1.01 / 0.99 + 1) AS median_pop,
         2.0 * pow(1.01 / 0.99, MIN(bucket) FILTER (WHERE below >= 0.99 * whole)) / (1.01 / 0.99 + 1) AS high_pop
  FROM upto GROUP BY 1
),
stats AS (
  SELECT department_code, MIN(population) AS min_pop, MAX(population) AS max_pop, AVG(population) AS avg_pop FROM x_stable GROUP BY 1
)
SELECT stats.*, median_pop, high_pop,
       min_pop > 0 AND max_pop <= 20 * high_pop AND avg_pop BETWEEN median_pop / 20 AND median_pop * 20 AS ok
FROM stats JOIN level USING (department_code)""", "min_pop max_pop avg_pop median_pop high_pop")
q("snapshot_stock", """
SELECT year, month, SUM(population) AS stock,
       SUM(population) / MAX(SUM(population)) FILTER (WHERE month = 1) OVER (PARTITION BY year) AS vs_january
FROM x_monthly GROUP BY 1, 2""", "stock vs_january")
q("share_concentration", " UNION ALL ".join(
    f"""SELECT avg(s) AS mean_stddev, '{stage}' AS stage
FROM (SELECT stddev_samp(geo_ratio) AS s FROM {t} WHERE age_band = '20_24' GROUP BY department_code, sex) x"""
    for stage, t in (("census", "x_ratio_epci"), ("corrected", "x_blend_epci"))
), "mean_stddev")
q("precision_split", """
SELECT department_code, SUM(population) FILTER (WHERE age >= 18) AS exact_pop,
       SUM(population) AS total_pop, SUM(population) FILTER (WHERE age >= 18) / SUM(population) AS exact_pct
FROM x_level_epci GROUP BY 1""", "exact_pop total_pop exact_pct")
q("single_snapshot", """
SELECT year, department_code, age, sex, COUNT(DISTINCT month) AS n_months FROM x_monthly
GROUP BY ALL HAVING n_months <> 1""")

q("region_rollup", "SELECT year, region_code, age, sex, SUM(population) AS pop FROM x_our_2024 GROUP BY ALL", "pop")
q("region_diff", """
SELECT o.region_code, our_pop, coalesce(ref, 0) AS ref_pop, (our_pop - ref) / ref * 100 AS diff_pct
FROM (SELECT region_code, SUM(population) AS our_pop FROM x_our_2024 GROUP BY 1) o
LEFT JOIN (SELECT region_code, SUM(pop) AS ref FROM x_ref_2024 GROUP BY 1) r ON r.region_code = o.region_code""",
  "our_pop ref_pop diff_pct")
BLOCKS["x_subband"] = """
SELECT region_code, who, CASE WHEN age < 18 THEN '15-17' WHEN age < 20 THEN '18-19' ELSE '20-24' END AS band,
       SUM(p) / SUM(SUM(p)) OVER (PARTITION BY region_code, who) * 100 AS share
FROM (SELECT region_code, 'our' AS who, age, population AS p FROM x_our_2024
      UNION ALL SELECT region_code, 'ref', age, pop FROM x_ref_2024) u GROUP BY 1, 2, 3"""
q("subband_shares", """
SELECT region_code, band, our_share, ref_share, our_share - ref_share AS diff_pp,
       abs(our_share - ref_share) > 0.3 AND band = '15-17' AS flag
FROM (SELECT region_code, band, coalesce(MAX(share) FILTER (WHERE who = 'our'), 0) AS our_share,
             coalesce(MAX(share) FILTER (WHERE who = 'ref'), 0) AS ref_share FROM x_subband GROUP BY 1, 2) s""",
  "our_share ref_share diff_pp")
q("sex_ratio", """
SELECT region_code, o AS our_ratio, r AS ref_ratio, o - r AS diff
FROM (SELECT region_code, SUM(population) FILTER (WHERE sex = 'male') / SUM(population) FILTER (WHERE sex = 'female') AS o
      FROM x_our_2024 GROUP BY 1) a
JOIN (SELECT region_code, SUM(pop) FILTER (WHERE sex = 'male') / SUM(pop) FILTER (WHERE sex = 'female') AS r
      FROM x_ref_2024 GROUP BY 1) b USING (region_code)""", "our_ratio ref_ratio diff")
q("year_drift", """
SELECT year, our_total, ref_total, (our_total - ref_total) / ref_total * 100 AS diff_pct
FROM (SELECT year, SUM(population) AS our_total FROM x_stable GROUP BY 1) o
JOIN (SELECT year, SUM(pop) AS ref_total FROM x_reference WHERE age BETWEEN 15 AND 24 GROUP BY 1) r USING (year)""",
  "our_total ref_total diff_pct")
q("epci_coverage", """
SELECT region_code, p AS parent_pop, c AS child_pop, c / p * 100 AS coverage_pct, p - c AS missing,
       (p - c) / p * 100 AS missing_pct
FROM (SELECT coalesce(region_code, 'ALL') AS region_code, SUM(p) AS p, SUM(c) AS c
      FROM (SELECT region_code, population AS p, 0 AS c FROM x_our_2024
            UNION ALL SELECT region_code, 0, population FROM x_epci_2024) u GROUP BY ROLLUP (region_code)) t""",
  "parent_pop child_pop coverage_pct missing missing_pct")
q("band_share_vs_national", """
SELECT epci_code, num_pop, den_pop, num_pop / den_pop * 100 AS share_pct,
       num_pop / den_pop * 100 - (SELECT SUM(CASE WHEN age >= 20 THEN population ELSE 0 END) / SUM(population) * 100
                                  FROM x_our_2024) AS vs_national
FROM x_epci_share""", "num_pop den_pop share_pct vs_national")
for name, order in (("top20_share", "DESC"), ("bottom20_share", "ASC")):
    q(name, f"""
SELECT epci_code, num_pop, den_pop, num_pop / den_pop * 100 AS share_pct FROM x_epci_share WHERE den_pop > 100
ORDER BY round(num_pop / den_pop * 100, 9) {order}, epci_code LIMIT 20""", "num_pop den_pop share_pct")
q("sex_ratio_diff", """
SELECT region_code, p AS parent_ratio, c AS child_ratio, c - p AS diff
FROM (SELECT region_code, SUM(population) FILTER (WHERE sex = 'male') / SUM(population) FILTER (WHERE sex = 'female') AS p
      FROM x_our_2024 GROUP BY 1) a
JOIN (SELECT region_code, SUM(population) FILTER (WHERE sex = 'male') / SUM(population) FILTER (WHERE sex = 'female') AS c
      FROM x_epci_2024 GROUP BY 1) b USING (region_code)""", "parent_ratio child_ratio diff")
q("share_by_year", "SELECT * FROM x_year_share", "num_pop den_pop share_pct national_pct delta")
q("share_pivot", "SELECT year, national_pct, " + ", ".join(
    f"""MAX(share_pct) FILTER (WHERE epci_code = '{c}') AS "{c}" """ for c in ("E0_0", "E3_1", "E7_2", "E11_3")
) + " FROM x_year_share GROUP BY 1, 2", "national_pct E0_0 E3_1 E7_2 E11_3")
q("drift_summary", """
SELECT epci_code, MIN(year) AS first_year, MAX(year) AS last_year, arg_min(share_pct, year) AS first_share,
       arg_max(share_pct, year) AS last_share, MAX(share_pct) - MIN(share_pct) AS drift_pp,
       MAX(share_pct) - MIN(share_pct) > 1 AS flag
FROM x_year_share GROUP BY 1 HAVING COUNT(*) > 1""", "first_share last_share drift_pp")
q("iris_level_coverage", """
SELECT a.*, b.*, iris_pop / epci_pop * 100 AS coverage_pct
FROM (SELECT COUNT(DISTINCT epci_code) AS epci_epcis, SUM(population) AS epci_pop FROM x_epci_2024) a
CROSS JOIN (SELECT COUNT(DISTINCT epci_code) AS iris_epcis, SUM(population) AS iris_pop FROM x_iris_2024) b""",
  "epci_pop iris_pop coverage_pct")
q("iris_epci_gap", """
SELECT epci_code, SUM(i) AS iris_pop, SUM(e) AS epci_pop, SUM(i) / SUM(e) * 100 AS coverage_pct
FROM (SELECT epci_code, department_code, age, sex, SUM(population) AS i FROM x_iris_2024 GROUP BY ALL) a
JOIN (SELECT epci_code, department_code, age, sex, SUM(population) AS e FROM x_epci_2024 GROUP BY ALL) b
     USING (epci_code, department_code, age, sex)
GROUP BY 1 HAVING abs(SUM(i) / SUM(e) - 1) > 0.01
ORDER BY round(abs(SUM(i) / SUM(e) - 1), 9) DESC, epci_code LIMIT 20""", "iris_pop epci_pop coverage_pct")
for name, order, n in (("iris_dept_coverage", "ASC", 20), ("iris_dept_coverage_top", "DESC", 10)):
    q(name, f"""
SELECT department_code, SUM(p) AS dept_pop, SUM(i) AS iris_pop, SUM(i) / SUM(p) * 100 AS coverage_pct
FROM (SELECT department_code, age, sex, SUM(population) AS p FROM x_our_2024 GROUP BY ALL) d
LEFT JOIN (SELECT department_code, age, sex, SUM(population) AS i FROM x_iris_2024 GROUP BY ALL) a
     USING (department_code, age, sex)
GROUP BY 1 ORDER BY round(SUM(i) / SUM(p) * 100, 9) {order} NULLS LAST, department_code LIMIT {n}""",
      "dept_pop iris_pop coverage_pct")
q("code_match_rate", """
SELECT COUNT(*) FILTER (WHERE o AND c) AS matched, COUNT(*) FILTER (WHERE o AND NOT c) AS only_ours,
       COUNT(*) FILTER (WHERE c AND NOT o) AS only_census
FROM (SELECT iris_code, bool_or(ours) AS o, bool_or(NOT ours) AS c
      FROM (SELECT iris_code, true AS ours FROM x_iris_2022 UNION ALL SELECT iris_code, false FROM x_census_area) u
      GROUP BY 1) m""")
q("census_diff", """
SELECT department_code, our_pop, census_pop, (our_pop - census_pop) / nullif(census_pop, 0) * 100 AS diff_pct
FROM (SELECT department_code, SUM(p) AS our_pop, coalesce(SUM(census_pop), 0) AS census_pop
      FROM (SELECT iris_code, department_code, age, sex, SUM(population) AS p FROM x_iris_2022 GROUP BY ALL) o
      LEFT JOIN x_census_area USING (iris_code, age, sex) GROUP BY 1) t WHERE our_pop <> 0""",
  "our_pop census_pop diff_pct")
q("iris_outliers", """
SELECT iris_code, department_code, SUM(p) AS our_pop, SUM(census_pop) AS census_pop,
       abs(SUM(p) - SUM(census_pop)) AS abs_diff, (SUM(p) - SUM(census_pop)) / SUM(census_pop) * 100 AS pct_diff
FROM (SELECT iris_code, department_code, age, sex, SUM(population) AS p FROM x_iris_2022 GROUP BY ALL) o
JOIN x_census_area USING (iris_code, age, sex)
GROUP BY 1, 2 HAVING SUM(census_pop) > 10
ORDER BY round(abs(SUM(p) - SUM(census_pop)), 6) DESC, iris_code, department_code LIMIT 15""",
  "our_pop census_pop abs_diff pct_diff")
q("enrolment_match", """
SELECT COUNT(DISTINCT epci_code) AS n_epcis, CAST(SUM(enrolled) AS BIGINT) AS matched,
       (SELECT CAST(SUM(enrolled) AS BIGINT) FROM x_enrol) AS enrolled,
       SUM(enrolled) / CAST((SELECT SUM(enrolled) FROM x_enrol) AS DOUBLE) * 100 AS matched_pct FROM x_enrol_epci""",
  "matched_pct")
q("enrolment_ratio", """
SELECT epci_code, enrolled, pop_20_24, ratio_pct,
       CASE WHEN ratio_pct > 100 THEN 'high' WHEN ratio_pct < 10 THEN 'low' ELSE '' END AS flag
FROM (SELECT p.epci_code, coalesce(e, 0) AS enrolled, pop_20_24, coalesce(e, 0) / pop_20_24 * 100 AS ratio_pct
      FROM x_students p LEFT JOIN (SELECT epci_code, CAST(SUM(enrolled) AS BIGINT) AS e FROM x_enrol_epci GROUP BY 1) s
           ON s.epci_code = p.epci_code) r""", "pop_20_24 ratio_pct")
q("enrolment_national", """
SELECT (SELECT CAST(SUM(enrolled) AS BIGINT) FROM x_enrol_epci) AS enrolled, SUM(population) FILTER (WHERE age >= 20) AS pop_20_24,
       SUM(population) AS pop_15_24,
       (SELECT SUM(enrolled) FROM x_enrol_epci) / SUM(population) FILTER (WHERE age >= 20) * 100 AS ratio_pct
FROM x_level_epci WHERE year = 2022""", "pop_20_24 pop_15_24 ratio_pct")
q("top_enrolment", """
SELECT epci_code, department_code, CAST(SUM(enrolled) AS BIGINT) AS enrolled, any_value(pop_20_24) AS pop_20_24,
       SUM(enrolled) / any_value(pop_20_24) * 100 AS ratio_pct
FROM x_enrol_degree JOIN x_commune ON commune_code = com_id JOIN x_students USING (epci_code)
WHERE pop_20_24 > 100 GROUP BY 1, 2
ORDER BY round(SUM(enrolled) / any_value(pop_20_24) * 100, 9) DESC, epci_code, department_code LIMIT 20""", "pop_20_24 ratio_pct")
q("distinct_groups", "SELECT DISTINCT regroupement FROM x_enrol_row")
q("preview_rows", "SELECT least(COUNT(*), 10) AS n, least(COUNT(*), 10) AS members FROM x_level_epci")


# The full build reads base cells with the territories appended, anchors the
# departments and corrects the EPCI and area shares.
BLOCKS["x_base_census"] = BLOCKS["x_base"]
BLOCKS["x_anchored_bare"] = "SELECT * EXCLUDE (region_code) FROM x_anchored"
BLOCKS["x_full_epci"] = level("x_anchored", "x_blend_epci", "0.03", EPCI_GEO)
BLOCKS["x_full_canton"] = level(
    "x_anchored_bare", "x_ratio_canton", "0.05", "department_code, region_code, canton_code"
)
BLOCKS["x_full_iris"] = level(
    "x_anchored_bare", "x_blend_iris", "0.1", "department_code, region_code, epci_code, commune_code, iris_code"
)
OVERRIDES = {
    "full_build": {
        "x_base": """
SELECT * FROM x_base_census UNION ALL SELECT * FROM x_t976 UNION ALL SELECT * FROM x_t986
UNION ALL SELECT * FROM x_t988 UNION ALL SELECT * FROM x_t975"""
    }
}
q("full_build", " UNION ALL ".join(
    f"""SELECT '{lv}' AS level, year, department_code, region_code, COUNT(*) AS cells, SUM(population) AS population
FROM {t} GROUP BY ALL"""
    for lv, t in (("department", "x_anchored"), ("epci", "x_full_epci"), ("canton", "x_full_canton"), ("iris", "x_full_iris"))
), "population")


QUERIES["resumed_build"] = QUERIES["full_build"]
OVERRIDES["resumed_build"] = OVERRIDES["full_build"]


def _blocks(sql: str, blocks: dict[str, str]) -> list[str]:
    """Blocks a query needs, each after the ones it reads."""
    order: list[str] = []

    def add(text):
        for name in dict.fromkeys(re.findall(r"\bx_\w+", text)):
            if name not in order:
                add(blocks[name])
                if name not in order:
                    order.append(name)

    add(sql)
    return order


def oracle_sql() -> dict[str, str]:
    result = {}
    for name, (sql, columns) in QUERIES.items():
        known = BLOCKS | OVERRIDES.get(name, {})
        needed = _blocks(sql, known)
        text = "WITH " + ",\n".join(f"{b} AS ({known[b].strip()})" for b in needed) + "\n" if needed else ""
        if columns:
            # Nudged off decimal ties, like the Spark side.
            replaced = ", ".join(
                f'round("{c}", 12) AS "{c}"' if c in RATIOS else f'round("{c}" + CAST(1e-9 AS DOUBLE), 6) AS "{c}"'
                for c in columns.split()
            )
            sql = f"SELECT * REPLACE ({replaced}) FROM ({sql.strip()}) final_rows"
        result[name] = text + sql.strip()
    return result
