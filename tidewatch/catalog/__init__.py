"""All registered queries."""

from tidewatch.catalog import base, detection, evaluation, rows, windows  # noqa: F401


def queries() -> dict:
    return dict(base.QUERIES)


def oracle_sql() -> dict:
    return dict(base.ORACLE)
