from censusloom.functions.codes import (
    age_band,
    clean_code,
    commune_of,
    decode_sex,
    department_of,
    iris_or_commune,
    usable_iris,
)
from censusloom.functions.frames import safe_ratio, share_within, single, union_all, unique
from censusloom.functions.measures import (
    age_label,
    age_window,
    birth_age,
    confidence,
    french_number,
    january,
    months_between_firsts,
    positive,
    sex_code,
    valid_cell,
    weight,
)
from censusloom.functions.sketch import merge, quantile_sketch, quantiles

__all__ = [n for n in dir() if not n.startswith("_")]
