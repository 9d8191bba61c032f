"""Named queries and the SQL that states the same result."""

from __future__ import annotations

from minutesmith.plans import readers
from minutesmith.plans.queries import ALL, Query
from minutesmith.plans.sql import SQL


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (*ALL, *readers.ALL)}


def oracle_sql() -> dict[str, str]:
    return {**SQL, **readers.SQL}
