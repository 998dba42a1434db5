"""Scalar column expressions (JVM-side, whole-stage codegen friendly)."""

from panelforge.functions.coerce import (  # noqa: F401
    nan_to_null, to_double, coerce_double, to_date_lenient, standardize_date,
    standardize_date_text, year_to_date_text, timestamp_to_date_text, year_of,
    normalize_nulls,
)
from panelforge.functions.text import (  # noqa: F401
    clean_text, source_label, file_year, sha256, with_default, join_list,
)
from panelforge.functions.fmt import stars, fmt_coef, fmt_se, fmt_fixed  # noqa: F401
from panelforge.functions.columns import lower_names, resolve, rename  # noqa: F401
