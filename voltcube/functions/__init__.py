from voltcube.functions.scalar import (  # noqa: F401
    band, clean_name, exact_mean, exact_mean_sql, gdp_class, half_decade, ieee_divide, nan_to_null, ne_keep_null,
    not_in_keep_null, pandemic_period, strip, to_decimal, to_int_rounded, zero_if_invalid,
)
