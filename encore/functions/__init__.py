"""Column functions (each returns a ``pyspark.sql.Column``)."""

from encore.functions.address import (city_from_address, city_or_derived, province_from_address,
                                      province_or_derived)
from encore.functions.dates import (check_day, day_minus, day_minus_col, day_of, normalise_time14,
                                    release_time, split_timestamp)
from encore.functions.scores import influence_columns, score_1d, score_period
from encore.functions.text import (album_name, auth_company, blank_if_null, join_ints, product_types,
                                   singer_field, string_length)

__all__ = [
    "album_name", "auth_company", "blank_if_null", "check_day", "city_from_address", "city_or_derived",
    "day_minus", "day_minus_col", "day_of", "influence_columns", "join_ints", "normalise_time14",
    "product_types", "province_from_address", "province_or_derived", "release_time", "score_1d",
    "score_period", "singer_field", "split_timestamp", "string_length",
]
