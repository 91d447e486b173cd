"""Column expressions on text, URLs and JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def clean_text(column: str) -> Column:
    """Lower case, runs of white space as one space, none at either end."""
    return F.lower(F.trim(F.regexp_replace(F.col(column), r"\s+", " ")))


def url_host(column: str) -> Column:
    """Host part of a URL in lower case; null when the text is not a URL."""
    return F.lower(F.try_parse_url(F.col(column), F.lit("HOST")))


def json_field(column: str, path: str, data_type: str) -> Column:
    """Typed field of a JSON text; null for bad JSON, a missing field or a bad value."""
    return F.get_json_object(F.col(column), path).try_cast(data_type)
