"""Query catalog: importing this module registers every query.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame built from the library
operators; ``ORACLE[name]`` is independent DuckDB SQL over the same tables.
"""

from vintagelake.plans.registry import ORACLE, QUERIES, finalize, register  # noqa: F401
from vintagelake.plans.registry import HISTORY_START, OVERDRAFT_RUN_DATE, RUN_DATE_HISTORY  # noqa: F401
from vintagelake.plans import queries_aggs, queries_core, queries_marts, queries_rules  # noqa: E402,F401
