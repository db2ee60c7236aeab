"""DuckDB SQL for every query that SQL can express, keyed as the queries are."""

from .analytics import ANALYTICS
from .features import FEATURE_CHECKS
from .quality import QUALITY_CHECKS
from .rollup import ROLLUP_CHECKS
from .tables import TABLE_CHECKS

ORACLE = {**ANALYTICS, **FEATURE_CHECKS, **QUALITY_CHECKS, **TABLE_CHECKS, **ROLLUP_CHECKS}
