"""All queries of the library with their SQL."""

from __future__ import annotations

from .plans import areas, coast, fields, layers, raster, relational, risks, scoring, space  # noqa: F401  (they register their queries)
from .sqlpair import QUERIES, SQL


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict:
    return dict(SQL)
