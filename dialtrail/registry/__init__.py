"""Named queries over the sample tables, with the SQL they must agree with."""

from dialtrail.registry.oracles import oracle_sql
from dialtrail.registry.named import queries

__all__ = ["oracle_sql", "queries"]
