"""All catalog queries by name."""

from __future__ import annotations

from skylane.plans import (  # noqa: F401  registration happens on import
    catalog_clean,
    catalog_joins,
    catalog_lake,
    catalog_streams,
    catalog_text,
)
from skylane.plans.registry import ORACLES, QUERIES, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
