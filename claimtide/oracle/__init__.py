"""The registered queries as DuckDB SQL, for checking.

Written apart from the Spark side and in another way: ranked rows instead of maxima,
a row-by-row LAG instead of term differences, filtered sums over decimals instead of
derived sums over cents, and a final roll-up that the Spark side shows to be needless.
"""

from claimtide.oracle.statements import oracle_sql

__all__ = ["oracle_sql"]
