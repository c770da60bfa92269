"""What each logged response calls for."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Seconds to wait after a 429 without a Retry-After, and after a service 429.
DEFAULT_RETRY_AFTER = 1
SERVICE_WAIT = 2


def with_action(log: DataFrame) -> DataFrame:
    """Add `action` and, for a retry, `wait_s`.

    429 by application or method limit: retry after Retry-After. Any other 429: retry after the
    service wait, of which the random part is left out. 404: not_found. Other 4xx and 5xx: fail.
    All else: parse.
    """
    limited = F.col("status") == 429
    told = limited & F.coalesce(F.col("rate_limit_type").isin("application", "method"), F.lit(False))
    action = (
        F.when(told, "retry_after")
        .when(limited, "retry_service")
        .when(F.col("status") == 404, "not_found")
        .when(F.col("status") >= 400, "fail")
        .when(F.col("status").isNull(), "fail")
        .otherwise("parse")
    )
    wait = F.when(told, F.coalesce(F.col("retry_after"), F.lit(DEFAULT_RETRY_AFTER))).when(
        limited, F.lit(SERVICE_WAIT)
    )
    return log.withColumns({"action": action, "wait_s": wait.cast("int")})
