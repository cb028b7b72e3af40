"""The isolation forest in SQL: drawn, grown level by level and walked by unrolled common table expressions."""

from __future__ import annotations

from forgeline import contracts as C
from forgeline.operators.iforest import DRAW_DIGITS, EULER_GAMMA


def forest_sql(source: str, key: str, features: list[str], trees: int = C.FOREST_TREES, max_samples: int = C.FOREST_MAX_SAMPLES,
               seed: int = C.FOREST_SEED, min_rows: int = C.MIN_ROWS_FOR_FOREST) -> str:
    """SELECT of the key, isolation_forest_score (unrounded) and is_isolation_forest_anomaly of every row of a relation."""
    levels = (max_samples - 1).bit_length()
    cols = [f"f{i}" for i in range(len(features))]
    values, low, high = ", ".join(cols), ", ".join(f"l{i}" for i in range(len(cols))), ", ".join(f"h{i}" for i in range(len(cols)))
    draw = lambda what: f"(('0x' || substr(md5('{seed}|' || tree || '|{what}|' || path), 1, {DRAW_DIGITS}))::BIGINT)"
    length = lambda n: (f"CASE WHEN {n} = 2 THEN 1.0::DOUBLE WHEN {n} > 2 THEN 2.0::DOUBLE * (ln({n} - 1.0::DOUBLE) + {EULER_GAMMA}::DOUBLE)"  # noqa: E731
                        f" - 2.0::DOUBLE * ({n} - 1.0::DOUBLE) / {n} ELSE 0.0::DOUBLE END")
    parts = [
        f"rows_ AS MATERIALIZED (SELECT {key} AS key, {', '.join(f'{f}::DOUBLE AS {c}' for f, c in zip(features, cols))} FROM {source})",
        f"size_ AS MATERIALIZED (SELECT count(*) AS n_rows, least({max_samples}, count(*)) AS psi, ceil(log2(greatest(2, least({max_samples}, count(*)))))::INT AS depth FROM rows_)",
        f"each_ AS MATERIALIZED (SELECT tree, '' AS path, key, {values} FROM rows_, (SELECT unnest(range({trees})) AS tree))",
        f"s0 AS MATERIALIZED (SELECT tree, path, key, {values} FROM each_, size_ QUALIFY row_number() OVER (PARTITION BY tree ORDER BY md5('{seed}|' || tree || '|row|' || key), key) <= psi)",
        f"w0 AS MATERIALIZED (SELECT tree, path, key, {values} FROM each_)"]
    ends = []
    for d in range(levels + 1):
        bounds = ", ".join(f"min({c}) AS l{i}, max({c}) AS h{i}" for i, c in enumerate(cols))
        parts.append(f"n{d} AS MATERIALIZED (SELECT tree, path, count(*) AS n, {bounds} FROM s{d} GROUP BY tree, path)")
        if d < levels:
            spread = f"list_filter(range({len(cols)}), lambda i: [{high}][i + 1] > [{low}][i + 1])"
            parts += [
                f"""p{d} AS MATERIALIZED (SELECT tree, path, feature, CASE WHEN t < hi THEN t ELSE lo END AS threshold FROM (
                    SELECT *, lo + {draw('split')}::DOUBLE / {16 ** DRAW_DIGITS}::DOUBLE * (hi - lo) AS t FROM (
                    SELECT tree, path, feature, [{low}][feature + 1] AS lo, [{high}][feature + 1] AS hi FROM (
                    SELECT *, spread[1 + {draw('feature')} % len(spread)] AS feature FROM (SELECT *, {spread} AS spread FROM n{d}, size_)
                    WHERE n > 1 AND len(spread) > 0 AND {d} < depth))))""",
                *(f"""{x}{d + 1} AS MATERIALIZED (SELECT tree, path || CASE WHEN [{values}][feature + 1] <= threshold THEN 'L' ELSE 'R' END AS path, key, {values}
                    FROM {x}{d} JOIN p{d} USING (tree, path))""" for x in "sw")]
        stopped = f"LEFT JOIN p{d} USING (tree, path) WHERE threshold IS NULL" if d < levels else ""
        ends.append(f"SELECT key, {d}::DOUBLE + {length('n')} AS len FROM w{d} JOIN n{d} USING (tree, path) {stopped}")
    return f"""
    WITH {', '.join(parts)},
    ends_ AS ({' UNION ALL '.join(ends)}),
    score_ AS (SELECT key, CASE WHEN any_value(n_rows) >= {min_rows}
        THEN 0.5::DOUBLE - pow(2.0::DOUBLE, -(sum(len) / {trees}) / ({length('any_value(psi)')})) END AS score
        FROM ends_, size_ GROUP BY key)
    SELECT key AS {key}, score AS isolation_forest_score, coalesce(score < 0, false) AS is_isolation_forest_anomaly FROM score_"""
