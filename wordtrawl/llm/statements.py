"""DuckDB statements for the queries of this package that SQL can express, written apart from the Spark code."""

from __future__ import annotations


def centroid_rounds(k: int = 8, rounds: int = 10, size: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """Exact rounds over (vector, place) rows, one group of CTEs per round, every distance computed."""
    kept = (
        f"kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v"
        f" FROM embeddings WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)"
    )
    cells = "cells AS MATERIALIZED (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM kept)"
    start = (
        "c0 AS MATERIALIZED (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS place FROM (SELECT v,"
        f" row_number() OVER (ORDER BY sha256('{seed}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM kept QUALIFY c < {k}))"
    )
    ctes = [kept, cells, start]
    for i in range(rounds + 1):
        ctes.append(
            f"a{i} AS MATERIALIZED (SELECT r, c, d FROM (SELECT r, c, sum((cells.x - c{i}.x) * (cells.x - c{i}.x))::BIGINT AS d"
            f" FROM cells JOIN c{i} USING (place) GROUP BY r, c) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1)"
        )
        if i < rounds:
            # Division of integers rounds towards zero, so the remainder is made non-negative first.
            floored = "((s - ((s % n) + n) % n) // n)::BIGINT"
            ctes.append(
                f"m{i} AS (SELECT c, place, {floored} AS x FROM (SELECT c, place, sum(x) AS s, count(*) AS n FROM cells JOIN a{i} USING (r)"
                " GROUP BY c, place))"
            )
            ctes.append(f"c{i + 1} AS MATERIALIZED (SELECT o.c, o.place, coalesce(m.x, o.x) AS x FROM c{i} o LEFT JOIN m{i} m USING (c, place))")
    last = f"a{rounds}"
    ctes.append(f"per AS (SELECT c, sum(d)::BIGINT AS own FROM {last} GROUP BY c)")
    ctes.append(f"sha AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY place)) AS h FROM c{rounds} GROUP BY c)")
    return (
        f"WITH {', '.join(ctes)} SELECT vec_id, c::INTEGER AS cluster, d AS distance, own AS cluster_inertia,"
        f" (SELECT sum(d)::BIGINT FROM {last}) AS inertia, h AS centroid_sha256"
        f" FROM {last} JOIN kept USING (r) JOIN per USING (c) JOIN sha USING (c)"
    )
