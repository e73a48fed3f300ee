"""SQL functions of the shop, registered in the session's catalog.

Their bodies are SQL, so the analyser puts them into the plan that calls them: they are
optimised with it, push filters down, and start no Python workers.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SCALAR = {
    "shop_item_total": "(quantity DECIMAL(10,2), unit_price DECIMAL(10,2)) RETURNS DECIMAL(20,2) "
                       "RETURN CAST(quantity * unit_price AS DECIMAL(20,2))",
    "shop_signed_value": "(kind STRING, value DECIMAL(10,2)) RETURNS DECIMAL(10,2) "
                         "RETURN CASE WHEN kind = 'DEBITO' THEN -abs(value) ELSE abs(value) END",
}
TABLE = {
    "shop_days": "(first DATE, last DATE) RETURNS TABLE (day DATE) "
                 "RETURN SELECT day FROM (SELECT explode(sequence(first, greatest(first, last), INTERVAL 1 DAY)) AS day) "
                 "WHERE day <= last",
}


def register(spark: SparkSession) -> list[str]:
    """Create the functions for this session; returns their names."""
    for name, body in {**SCALAR, **TABLE}.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return [*SCALAR, *TABLE]
