"""Money columns: ``NUMERIC(10, 2)`` in the shop tables.

Money is never summed as double. Casting to ``decimal(p, 2)`` rounds half
away from zero; under ANSI mode a value that does not fit raises.
"""

from __future__ import annotations

from pyspark.sql.types import DecimalType

# The declared money type and its limit.
MONEY = DecimalType(10, 2)
MONEY_LIMIT = 10 ** 8  # |value| >= 10^8 does not fit NUMERIC(10, 2)
# Sums and differences are carried at this precision in results.
MONEY_SUM = DecimalType(18, 2)
