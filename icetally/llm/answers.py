"""DuckDB SQL for the queries of this subpackage that SQL can express over whole tables."""

from __future__ import annotations

from .centroids import CENTROIDS, DIMENSIONS, ROUNDS, SCALE, SEED


def clusters_sql(k: int = CENTROIDS, rounds: int = ROUNDS) -> str:
    """The rounds written out one after another over (vector, dimension) rows; no dictionaries."""
    steps = [f"""
    kept as materialized (
      select row_number() over () as n, vec_id, embedding from embeddings
      where len(embedding) = {DIMENSIONS} and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = {DIMENSIONS}),
    v as materialized (
      select n, d, cast(floor({SCALE} * cast(embedding[d] as double)) as bigint) as x
      from kept, (select unnest(range(1, {DIMENSIONS + 1})) as d)),
    first as materialized (
      select n, row_number() over (order by sha256('{SEED}:' || vec_id)) - 1 as cluster from kept
      qualify cluster < {k}),
    c0 as materialized (select cluster, d, x from first join v using (n))"""]
    for r in range(rounds + 1):
        steps.append(f"""
    a{r} as materialized (
      select n, cluster, distance from (
        select v.n, c.cluster, cast(sum((v.x - c.x) * (v.x - c.x)) as bigint) as distance
        from v join c{r} c using (d) group by all)
      qualify row_number() over (partition by n order by distance, cluster) = 1)""")
        if r < rounds:
            steps.append(f"""
    m{r} as materialized (
      select cluster, d, cast(sum(x) as bigint) as s, count(*) as k from a{r} join v using (n) group by all),
    c{r + 1} as materialized (
      select c.cluster, c.d, case when k is null then c.x else (s - ((s % k) + k) % k) // k end as x
      from c{r} c left join m{r} m on c.cluster = m.cluster and c.d = m.d)""")
    last = f"a{rounds}"
    return f"""with {",".join(steps)}
    select vec_id, cast(cluster as int) as cluster, distance,
      cast(sum(distance) over (partition by cluster) as bigint) as cluster_inertia,
      cast(sum(distance) over () as bigint) as inertia, centroid_sha256
    from {last} join kept using (n)
      join (select cluster, sha256(string_agg(cast(x as varchar), ',' order by d)) as centroid_sha256
            from c{rounds} group by cluster) using (cluster)"""


SQL: dict[str, str] = {"op13_centroid_clusters": clusters_sql()}
