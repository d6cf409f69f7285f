from censusloom.sources.external import (
    academic_year,
    estimates_long,
    read_enrolment,
    read_pyramid_csv,
    read_reference_pyramid,
    read_semicolon,
    reference_pyramid,
)
from censusloom.sources.levels import read_level
from censusloom.sources.lookups import commune_lookup, district_rows, read_cog, read_commune_records
from censusloom.sources.microdata import in_scope, read_birth_months, read_birth_records, read_census, read_columns, read_flows
from censusloom.sources.pyramids import bands_from_labels, expand_bands, pyramid_header, pyramid_unpivot

__all__ = [n for n in dir() if not n.startswith("_")]
