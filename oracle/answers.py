"""All answers by query name."""

from oracle import game_queries, ice_queries, row_queries, source_queries

SQL: dict[str, str] = {**ice_queries.SQL, **row_queries.SQL, **source_queries.SQL, **game_queries.SQL}
