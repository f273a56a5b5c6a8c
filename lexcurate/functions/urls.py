"""URL parts as columns, and the same rules as DuckDB SQL for the oracles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site(url: Column) -> Column:
    """Host after ``//`` in lower case without login, port and one leading ``www.``; null where there is none
    (null or empty url, no ``//``, empty host)."""
    authority = F.regexp_extract(F.lower(url), r"//([^/?#\\]*)", 1)
    host = F.regexp_replace(F.regexp_replace(authority, "^.*@", ""), ":[0-9]*$", "")
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def site_sql(url: str) -> str:
    """:func:`site` in DuckDB SQL."""
    return (
        rf"nullif(regexp_replace(regexp_replace(regexp_replace(regexp_extract(lower({url}), '//([^/?#\\]*)', 1), "
        r"'^.*@', ''), ':[0-9]*$', ''), '^www\.', ''), '')"
    )


def netloc(url: Column) -> Column:
    """Authority part as written: case, login and port kept, ``''`` without ``//``; null stays null."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def netloc_sql(url: str) -> str:
    return rf"regexp_extract({url}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1)"
