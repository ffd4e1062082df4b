"""Query catalogue: SURVEY section 2 keys -> Spark callables + DuckDB oracle SQL.

Every query reads the driver's tables through the derived fixture views and
runs over whole tables; the request is the reference back-test (knowledge time
2019-09-17T16:00Z, 13 training weeks, 100 records per curve) over every ship
date the processing plan selects.
"""

from hazardline.catalog.registry import ORACLE, QUERIES  # noqa: F401
from hazardline.catalog import core, training_ops, correction_ops, scalar_ops, io_ops  # noqa: F401,E402
