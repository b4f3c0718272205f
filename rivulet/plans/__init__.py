"""Named queries over the driver tables.

Each module registers ``key -> (builder, oracle_sql)``; ``builder(spark, sf_dir)``
returns a DataFrame and ``oracle_sql`` is the same result written in plain SQL
(DuckDB dialect) or ``None`` when only a row check is possible.
"""

from rivulet.plans.registry import REGISTRY, register  # noqa: F401
from rivulet.plans import gold, explore, cdc, silver, quality, table, streaming, history, discovery  # noqa: F401
