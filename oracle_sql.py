"""DuckDB oracle SQL for the registered queries.

Each builder returns one SQL statement over the pre-registered views
(``orders``, ``lineitem``, ``part``, ``documents``, ``events`` ...).  They are
written independently of the Spark code: brute-force CTEs, window
``row_number`` for the index, a cross join with the hash family, plain
self-joins for buckets.  Derived doubles are rounded to 6 decimals on both
sides.
"""

from __future__ import annotations

from corate.functions.hashing import DEFAULT_BANDS, DEFAULT_ROWS, hash_family, lsh_shape

# ---------------------------------------------------------------- fixtures

RATINGS_CTE = """
ratings AS (
  SELECT o_custkey AS user_id, p_brand || '|' || p_type AS item_id,
         CAST((CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) + 10*count(*) - 1) // (10*count(*)) AS INT) AS rating,
         CASE WHEN o_custkey % 50 = 0
                OR p_brand || '|' || p_type IN (SELECT min(p_brand || '|' || p_type) FROM part)
                OR CAST(sum(l_orderkey) AS BIGINT) % 10 = 0 THEN 1 ELSE 0 END AS val
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey
  GROUP BY o_custkey, p_brand, p_type
),
train AS (SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating FROM ratings WHERE val = 0),
valid AS (SELECT user_id, item_id, CAST(rating AS DOUBLE) AS rating FROM ratings WHERE val = 1)"""

DOC_PAIRS_CTE = r"""
doc_pairs AS (
  SELECT DISTINCT tok AS user_id, doc_id AS item_id
  FROM (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\p{L}\p{N}]+')) AS tok FROM documents)
)"""

EVENT_PAIRS_CTE = """
event_pairs AS (
  SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS user_id, user_id AS item_id
  FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL
)"""


def family_values(family=None) -> str:
    family = family or hash_family()
    rows = ", ".join(f"({h}, {a}, {b}, {p})" for h, (a, b, p) in enumerate(family))
    return f"fam(h, a, b, p) AS (SELECT CAST(h AS INT), CAST(a AS BIGINT), CAST(b AS BIGINT), CAST(p AS BIGINT) FROM (VALUES {rows}) t(h, a, b, p))"


def lsh_ctes(
    src: str,
    prefix: str,
    users_src: str | None = None,
    bands: int = DEFAULT_BANDS,
    rows: int = DEFAULT_ROWS,
) -> str:
    """CTEs ``{prefix}_idx, _bk, _sig, _bands, _cand, _jac`` for pair table ``src``.

    ``users_src`` is a query producing ``user_id`` (and optionally ``src_order``)
    that defines the user universe; default: the users of ``src``.
    """
    if users_src is None:
        idx = f"""{prefix}_idx AS (
  SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM {src})
)"""
    else:
        idx = f"""{prefix}_idx AS (
  SELECT user_id, row_number() OVER (ORDER BY src_order, user_id) - 1 AS idx
  FROM (SELECT user_id, min(src_order) AS src_order FROM ({users_src}) GROUP BY user_id)
)"""
    band_cols = ", ".join(f"max(CASE WHEN h % {rows} = {r} THEN v END) AS r{r}" for r in range(rows))
    band_eq = " AND ".join(f"x.r{r} = y.r{r}" for r in range(rows))
    return f"""{idx},
{prefix}_m AS (SELECT count(*) AS m FROM {prefix}_idx),
{prefix}_bk AS (SELECT DISTINCT s.item_id, i.idx FROM {src} s JOIN {prefix}_idx i ON s.user_id = i.user_id),
{prefix}_sig AS (
  SELECT bk.item_id, fam.h, min(((fam.a * bk.idx + fam.b) % fam.p) % m.m) AS v
  FROM {prefix}_bk bk CROSS JOIN fam CROSS JOIN {prefix}_m m GROUP BY bk.item_id, fam.h
),
{prefix}_bands AS (
  SELECT item_id, h // {rows} AS band, {band_cols}
  FROM {prefix}_sig WHERE h < {bands * rows} GROUP BY item_id, h // {rows}
),
{prefix}_cand AS (
  SELECT DISTINCT x.item_id AS id1, y.item_id AS id2
  FROM {prefix}_bands x JOIN {prefix}_bands y ON x.band = y.band AND {band_eq} AND x.item_id < y.item_id
),
{prefix}_iu AS (SELECT DISTINCT item_id, user_id FROM {src}),
{prefix}_size AS (SELECT item_id, count(*) AS n FROM {prefix}_iu GROUP BY item_id),
{prefix}_inter AS (
  SELECT c.id1, c.id2, count(*) AS inter
  FROM {prefix}_cand c JOIN {prefix}_iu a ON a.item_id = c.id1
  JOIN {prefix}_iu b ON b.item_id = c.id2 AND b.user_id = a.user_id
  GROUP BY c.id1, c.id2
),
{prefix}_jac AS (
  SELECT c.id1, c.id2,
         CAST(coalesce(i.inter, 0) AS DOUBLE) / CAST(s1.n + s2.n - coalesce(i.inter, 0) AS DOUBLE) AS similarity
  FROM {prefix}_cand c LEFT JOIN {prefix}_inter i ON i.id1 = c.id1 AND i.id2 = c.id2
  JOIN {prefix}_size s1 ON s1.item_id = c.id1 JOIN {prefix}_size s2 ON s2.item_id = c.id2
)"""


def recall_ctes(src: str, prefix: str, min_sim: float, users_src: str | None = None, recall: float = 0.98) -> str:
    """The hash family and LSH CTEs of the shape that the threshold and the recall ask for."""
    shape = lsh_shape(min_sim, recall)
    family = hash_family(max(shape.hashes, 120))
    return family_values(family) + ",\n" + lsh_ctes(src, prefix, users_src, shape.bands, shape.rows)


def exact_ctes(src: str, prefix: str) -> str:
    """``{prefix}_exact(id1, id2, similarity)``: every pair with a common user, brute force."""
    return f"""{prefix}_iu AS (SELECT DISTINCT item_id, user_id FROM {src}),
{prefix}_size AS (SELECT item_id, count(*) AS n FROM {prefix}_iu GROUP BY item_id),
{prefix}_exact AS (
  SELECT a.item_id AS id1, b.item_id AS id2,
         CAST(count(*) AS DOUBLE) / CAST(s1.n + s2.n - count(*) AS DOUBLE) AS similarity
  FROM {prefix}_iu a JOIN {prefix}_iu b ON a.user_id = b.user_id AND a.item_id < b.item_id
  JOIN {prefix}_size s1 ON s1.item_id = a.item_id JOIN {prefix}_size s2 ON s2.item_id = b.item_id
  GROUP BY a.item_id, b.item_id, s1.n, s2.n)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(c.strip() for c in ctes)


# ------------------------------------------------------------- statements


def sql_ratings_fixture() -> str:
    return with_(RATINGS_CTE) + "\nSELECT user_id, item_id, rating, val FROM ratings"


def sql_dense_index() -> str:
    return with_(DOC_PAIRS_CTE) + """
SELECT user_id AS id, row_number() OVER (ORDER BY user_id) - 1 AS idx
FROM (SELECT DISTINCT user_id FROM doc_pairs)"""


def sql_union_index() -> str:
    return with_(RATINGS_CTE) + """
SELECT user_id AS id, row_number() OVER (ORDER BY src_order, user_id) - 1 AS idx
FROM (SELECT user_id, min(src_order) AS src_order FROM (
        SELECT user_id, 0 AS src_order FROM train UNION ALL SELECT user_id, 1 AS src_order FROM valid)
      GROUP BY user_id)"""


def sql_baskets() -> str:
    return with_(DOC_PAIRS_CTE) + """,
idx AS (SELECT user_id, row_number() OVER (ORDER BY user_id) - 1 AS idx FROM (SELECT DISTINCT user_id FROM doc_pairs)),
bk AS (SELECT DISTINCT p.item_id, i.idx FROM doc_pairs p JOIN idx i ON p.user_id = i.user_id)
SELECT item_id, count(*) AS n_users, min(idx) AS min_idx, max(idx) AS max_idx, CAST(sum(idx) AS BIGINT) AS sum_idx
FROM bk GROUP BY item_id"""


def sql_minhash_signature() -> str:
    return with_(DOC_PAIRS_CTE, family_values(), lsh_ctes("doc_pairs", "d")) + """
SELECT item_id, h, CAST(v AS BIGINT) AS minhash FROM d_sig"""


def sql_lsh_candidates() -> str:
    return with_(DOC_PAIRS_CTE, family_values(), lsh_ctes("doc_pairs", "d")) + "\nSELECT id1, id2 FROM d_cand"


def sql_lsh_jaccard() -> str:
    return with_(DOC_PAIRS_CTE, family_values(), lsh_ctes("doc_pairs", "d")) + """
SELECT id1, id2, round(similarity, 6) AS similarity FROM d_jac"""


def sql_similar_pairs_docs(min_sim: float = 0.5) -> str:
    return with_(DOC_PAIRS_CTE, family_values(), lsh_ctes("doc_pairs", "d")) + f"""
SELECT id1, id2, round(similarity, 6) AS similarity FROM d_jac WHERE similarity >= {min_sim}"""


def sql_top_pairs_sorted(min_sim: float = 0.5) -> str:
    return with_(DOC_PAIRS_CTE, family_values(), lsh_ctes("doc_pairs", "d")) + f"""
SELECT id1 AS business_id_1, id2 AS business_id_2, round(similarity, 6) AS similarity,
       row_number() OVER (ORDER BY id1, id2) - 1 AS position
FROM d_jac WHERE similarity >= {min_sim}"""


def sql_similar_pairs_events(min_sim: float = 0.4) -> str:
    return with_(EVENT_PAIRS_CTE, family_values(), lsh_ctes("event_pairs", "e")) + f"""
SELECT id1, id2, round(similarity, 6) AS similarity FROM e_jac WHERE similarity >= {min_sim}"""


PURCHASES_CTE = """
purchases AS (SELECT DISTINCT o_custkey AS user_id, l_partkey AS item_id FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def sql_similar_pairs_purchases(min_sim: float = 0.1) -> str:
    return with_(PURCHASES_CTE, recall_ctes("purchases", "pu", 0.1)) + f"""
SELECT id1, id2, round(similarity, 6) AS similarity FROM pu_jac WHERE similarity >= {min_sim}"""


BRUTE_DOC_CTE = """
d_exact AS (
  SELECT a.item_id AS id1, b.item_id AS id2,
         CAST(count(*) AS DOUBLE) / CAST(s1.n + s2.n - count(*) AS DOUBLE) AS similarity
  FROM d_iu a JOIN d_iu b ON a.user_id = b.user_id AND a.item_id < b.item_id
  JOIN d_size s1 ON s1.item_id = a.item_id JOIN d_size s2 ON s2.item_id = b.item_id
  GROUP BY a.item_id, b.item_id, s1.n, s2.n
)"""


def sql_jaccard_exact(min_sim: float = 0.5) -> str:
    return with_(
        DOC_PAIRS_CTE,
        "d_iu AS (SELECT DISTINCT item_id, user_id FROM doc_pairs)",
        "d_size AS (SELECT item_id, count(*) AS n FROM d_iu GROUP BY item_id)",
        BRUTE_DOC_CTE,
    ) + f"""
SELECT id1, id2, round(similarity, 6) AS similarity FROM d_exact WHERE similarity >= {min_sim}"""


def sql_lsh_quality(min_sim: float = 0.5) -> str:
    return with_(DOC_PAIRS_CTE, family_values(), lsh_ctes("doc_pairs", "d"), BRUTE_DOC_CTE) + f""",
found AS (SELECT id1, id2 FROM d_jac WHERE similarity >= {min_sim}),
truth AS (SELECT id1, id2 FROM d_exact WHERE similarity >= {min_sim}),
counts AS (SELECT (SELECT count(*) FROM found) AS n_found, (SELECT count(*) FROM truth) AS n_truth,
                  (SELECT count(*) FROM found JOIN truth USING (id1, id2)) AS hits)
SELECT n_found, n_truth, hits,
       round(CASE WHEN n_found > 0 THEN hits / n_found END, 6) AS precision,
       round(CASE WHEN n_truth > 0 THEN hits / n_truth END, 6) AS recall
FROM counts"""


RATING_USERS = "SELECT user_id, 0 AS src_order FROM train UNION ALL SELECT user_id, 1 AS src_order FROM valid"


def sql_similar_pairs_ratings(min_sim: float = 0.2) -> str:
    return with_(RATINGS_CTE, recall_ctes("train", "r", 0.2, RATING_USERS)) + f"""
SELECT id1, id2, round(similarity, 6) AS similarity FROM r_jac WHERE similarity >= {min_sim}"""


# ------------------------------------------------------- collaborative filtering


def sim_expr(n="cnt", sa="sa", so="so", sao="sao", saa="saa", soo="soo", center="active") -> str:
    num = f"({n}*{sao} - {sa}*{so})"
    d1 = f"({n}*{saa} - {sa}*{sa})"
    d2 = f"({n}*{soo} - 2.0*{sa}*{so} + {sa}*{sa})" if center == "active" else f"({n}*{soo} - {so}*{so})"
    return (
        f"CASE WHEN {n} >= 2 AND {num} <> 0 AND {d1} > 0 AND {d2} > 0 "
        f"THEN {num} / (sqrt({d1}) * sqrt({d2})) END"
    )


def directed_sims_cte(name: str, pairs: str, ratings: str, center: str = "active") -> str:
    """``{name}(t, n, sim)``: similarity of target t vs neighbour n over common raters, brute force."""
    return f"""{name} AS (
  SELECT t, n, {sim_expr(center=center)} AS sim FROM (
    SELECT p.t, p.n, count(*) AS cnt, sum(a.rating) AS sa, sum(o.rating) AS so, sum(a.rating*o.rating) AS sao,
           sum(a.rating*a.rating) AS saa, sum(o.rating*o.rating) AS soo
    FROM {pairs} p JOIN {ratings} a ON a.item_id = p.t JOIN {ratings} o ON o.item_id = p.n AND o.user_id = a.user_id
    GROUP BY p.t, p.n))"""


def neighbour_ctes(prefix: str, pairs: str, ratings: str, targets: str) -> str:
    """``{prefix}_nb(target_id, neighbour_id, weight)`` with the placeholder rules."""
    return f"""{prefix}_tg AS (SELECT DISTINCT item_id AS t FROM {targets}),
{prefix}_pt AS (
  SELECT DISTINCT t, n FROM (SELECT id1 AS t, id2 AS n FROM {pairs} UNION ALL SELECT id2 AS t, id1 AS n FROM {pairs})
  WHERE t <> n AND t IN (SELECT item_id FROM {ratings}) AND t IN (SELECT t FROM {prefix}_tg)
),
{directed_sims_cte(prefix + "_sim", prefix + "_pt", ratings)},
{prefix}_nb AS (
  SELECT DISTINCT * FROM (
    SELECT p.t AS target_id, CASE WHEN s.sim IS NOT NULL THEN p.n ELSE p.t END AS neighbour_id,
           CASE WHEN s.sim IS NOT NULL THEN s.sim ELSE 1.0 END AS weight
    FROM {prefix}_pt p LEFT JOIN {prefix}_sim s ON s.t = p.t AND s.n = p.n
    UNION ALL
    SELECT t, t, 1.0 FROM {prefix}_tg WHERE t NOT IN (SELECT t FROM {prefix}_pt)))"""


STATS_CTES = """um AS (SELECT user_id, avg(rating) AS user_mean, count(*) AS user_n, sum(rating) AS user_sum FROM train GROUP BY user_id),
im AS (SELECT item_id, avg(rating) AS item_mean FROM train GROUP BY item_id),
gm AS (SELECT avg(rating) AS g FROM train),
keys AS (SELECT DISTINCT user_id, item_id FROM valid)"""

ITEM_PRED_CTES = """ipred AS (
  SELECT a.user_id, a.item_id,
    CASE WHEN um.user_mean IS NULL THEN coalesce(im.item_mean, (SELECT g FROM gm))
         WHEN a.n_entries = 0 OR (a.n_entries = 1 AND a.has_self = 1) THEN um.user_mean
         WHEN a.den IS NULL OR a.den = 0 OR abs(a.num) < 1e-9 THEN um.user_mean
         ELSE abs(a.num / a.den) END AS prediction
  FROM (
    SELECT l.user_id, l.item_id, count(l.neighbour_id) AS n_entries,
           max(CASE WHEN l.neighbour_id = l.item_id THEN 1 ELSE 0 END) AS has_self,
           sum(CASE WHEN tr.rating IS NOT NULL THEN l.weight * tr.rating END) AS num,
           sum(CASE WHEN tr.rating IS NOT NULL THEN abs(l.weight) END) AS den
    FROM (SELECT k.user_id, k.item_id, nb.neighbour_id, nb.weight FROM keys k LEFT JOIN i_nb nb ON nb.target_id = k.item_id) l
    LEFT JOIN train tr ON tr.user_id = l.user_id AND tr.item_id = l.neighbour_id
    GROUP BY l.user_id, l.item_id) a
  LEFT JOIN um ON um.user_id = a.user_id LEFT JOIN im ON im.item_id = a.item_id
)"""

SWAPPED = """strain AS (SELECT item_id AS user_id, user_id AS item_id, rating FROM train),
svalid AS (SELECT item_id AS user_id, user_id AS item_id, rating FROM valid)"""
SWAPPED_USERS = "SELECT user_id, 0 AS src_order FROM strain UNION ALL SELECT user_id, 1 AS src_order FROM svalid"

USER_PRED_CTES = """upred AS (
  SELECT a.user_id, a.item_id,
    CASE WHEN um.user_mean IS NULL THEN coalesce(im.item_mean, (SELECT g FROM gm))
         WHEN a.den IS NULL OR a.den = 0 OR abs(a.num) < 1e-9 THEN um.user_mean
         ELSE um.user_mean + a.num / a.den END AS prediction
  FROM (
    SELECT user_id, item_id,
           sum(CASE WHEN r IS NOT NULL AND vmean IS NOT NULL THEN weight * (r - vmean) END) AS num,
           sum(CASE WHEN r IS NOT NULL AND vmean IS NOT NULL THEN abs(weight) END) AS den
    FROM (
      SELECT l.user_id, l.item_id, l.weight, tr.rating AS r,
             CASE WHEN st.user_n > 1 THEN (st.user_sum - tr.rating) / (st.user_n - 1) END AS vmean
      FROM (SELECT k.user_id, k.item_id, nb.neighbour_id, nb.weight FROM keys k LEFT JOIN u_nb nb ON nb.target_id = k.user_id) l
      LEFT JOIN train tr ON tr.user_id = l.neighbour_id AND tr.item_id = l.item_id
      LEFT JOIN um st ON st.user_id = l.neighbour_id)
    GROUP BY user_id, item_id) a
  LEFT JOIN um ON um.user_id = a.user_id LEFT JOIN im ON im.item_id = a.item_id
)"""

MEAN_PRED_CTE = """mpred AS (
  SELECT k.user_id, k.item_id, coalesce(im.item_mean, um.user_mean, (SELECT g FROM gm)) AS prediction
  FROM keys k LEFT JOIN im ON im.item_id = k.item_id LEFT JOIN um ON um.user_id = k.user_id
)"""


def _item_based_ctes() -> list[str]:
    return [
        RATINGS_CTE,
        recall_ctes("train", "r", 0.2, RATING_USERS),
        "r_sp AS (SELECT id1, id2 FROM r_jac WHERE similarity >= 0.2)",
        neighbour_ctes("i", "r_sp", "train", "valid"),
        STATS_CTES,
        ITEM_PRED_CTES,
    ]


def _user_based_ctes() -> list[str]:
    return [
        RATINGS_CTE,
        SWAPPED,
        exact_ctes("strain", "s"),
        "s_sp AS (SELECT id1, id2 FROM s_exact WHERE similarity >= 0.25)",
        neighbour_ctes("u", "s_sp", "strain", "svalid"),
        STATS_CTES,
        USER_PRED_CTES,
    ]


def sql_exclude_pairs() -> str:
    return with_(RATINGS_CTE) + """
SELECT a.user_id, a.item_id, a.rating FROM (SELECT * FROM train UNION ALL SELECT * FROM valid) a
WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.user_id = a.user_id AND v.item_id = a.item_id)"""


def sql_swap_roles() -> str:
    return with_(RATINGS_CTE) + "\nSELECT item_id AS user_id, user_id AS item_id, rating FROM train"


def sql_user_mean() -> str:
    return with_(RATINGS_CTE) + """
SELECT user_id, round(avg(rating), 6) AS user_mean, count(*) AS user_n FROM train GROUP BY user_id"""


def sql_item_mean() -> str:
    return with_(RATINGS_CTE) + """
SELECT item_id, round(avg(rating), 6) AS item_mean FROM train GROUP BY item_id"""


def sql_similarity(center: str) -> str:
    return with_(
        RATINGS_CTE,
        recall_ctes("train", "r", 0.2, RATING_USERS),
        """r_dir AS (SELECT id1 AS t, id2 AS n FROM r_jac WHERE similarity >= 0.2
          UNION ALL SELECT id2 AS t, id1 AS n FROM r_jac WHERE similarity >= 0.2)""",
        directed_sims_cte("r_sim", "r_dir", "train", center),
    ) + "\nSELECT t AS target_id, n AS neighbour_id, round(sim, 6) AS similarity FROM r_sim"


def sql_neighbours() -> str:
    ctes = _item_based_ctes()[:4]
    return with_(*ctes) + "\nSELECT target_id, neighbour_id, round(weight, 6) AS weight FROM i_nb"


def sql_predict_item_based() -> str:
    return with_(*_item_based_ctes()) + "\nSELECT user_id, item_id, round(prediction, 6) AS prediction FROM ipred"


def sql_predict_user_based() -> str:
    return with_(*_user_based_ctes()) + "\nSELECT user_id, item_id, round(prediction, 6) AS prediction FROM upred"


def sql_predict_mean() -> str:
    return with_(RATINGS_CTE, STATS_CTES, MEAN_PRED_CTE) + (
        "\nSELECT user_id, item_id, round(prediction, 6) AS prediction FROM mpred"
    )


def _rmse(pred: str) -> str:
    return f"""
SELECT round(sqrt(avg((p.prediction - v.rating) * (p.prediction - v.rating))), 6) AS rmse, count(*) AS n
FROM {pred} p JOIN valid v ON v.user_id = p.user_id AND v.item_id = p.item_id"""


def sql_rmse_item_based() -> str:
    return with_(*_item_based_ctes()) + _rmse("ipred")


def sql_rmse_user_based() -> str:
    return with_(*_user_based_ctes()) + _rmse("upred")


def sql_rmse_mean() -> str:
    return with_(RATINGS_CTE, STATS_CTES, MEAN_PRED_CTE) + _rmse("mpred")


def sql_knn_items(k: int = 5) -> str:
    return with_(
        RATINGS_CTE,
        STATS_CTES,
        """cand AS (SELECT k.user_id, k.item_id, tr.item_id AS neighbour_id FROM keys k
                 JOIN train tr ON tr.user_id = k.user_id WHERE tr.item_id <> k.item_id)""",
        "kp AS (SELECT DISTINCT item_id AS t, neighbour_id AS n FROM cand)",
        directed_sims_cte("ks", "kp", "train"),
    ) + f"""
SELECT user_id, item_id, neighbour_id, round(similarity, 6) AS similarity, rank FROM (
  SELECT c.user_id, c.item_id, c.neighbour_id, s.sim AS similarity,
         row_number() OVER (PARTITION BY c.user_id, c.item_id ORDER BY s.sim DESC, c.neighbour_id DESC) AS rank
  FROM cand c JOIN ks s ON s.t = c.item_id AND s.n = c.neighbour_id WHERE s.sim IS NOT NULL)
WHERE rank <= {k}"""


def sql_knn_users() -> str:
    return with_(
        RATINGS_CTE,
        STATS_CTES,
        SWAPPED,
        """cand AS (SELECT k.user_id, k.item_id, tr.user_id AS neighbour_id FROM keys k
                 JOIN train tr ON tr.item_id = k.item_id WHERE tr.user_id <> k.user_id)""",
        "kp AS (SELECT DISTINCT user_id AS t, neighbour_id AS n FROM cand)",
        directed_sims_cte("ks", "kp", "strain"),
    ) + """
SELECT user_id, item_id, neighbour_id, round(similarity, 6) AS similarity,
       row_number() OVER (PARTITION BY user_id, item_id ORDER BY similarity DESC, neighbour_id DESC) AS rank
FROM (SELECT c.user_id, c.item_id, c.neighbour_id, s.sim AS similarity
      FROM cand c JOIN ks s ON s.t = c.user_id AND s.n = c.neighbour_id WHERE s.sim IS NOT NULL)"""


def _quality(found: str, exact: str, min_sim: float) -> str:
    return f""",
found AS (SELECT id1, id2 FROM {found} WHERE similarity >= {min_sim}),
truth AS (SELECT id1, id2 FROM {exact} WHERE similarity >= {min_sim}),
counts AS (SELECT (SELECT count(*) FROM found) AS n_found, (SELECT count(*) FROM truth) AS n_truth,
                  (SELECT count(*) FROM found JOIN truth USING (id1, id2)) AS hits)
SELECT n_found, n_truth, hits,
       round(CASE WHEN n_found > 0 THEN hits / n_found END, 6) AS precision,
       round(CASE WHEN n_truth > 0 THEN hits / n_truth END, 6) AS recall
FROM counts"""


def sql_lsh_quality_ratings(min_sim: float = 0.2) -> str:
    lsh = recall_ctes("train", "r", min_sim, RATING_USERS)
    return with_(RATINGS_CTE, lsh, exact_ctes("train", "x")) + _quality("r_jac", "x_exact", min_sim)


def sql_lsh_quality_purchases(min_sim: float = 0.1) -> str:
    lsh = recall_ctes("purchases", "pu", min_sim)
    return with_(PURCHASES_CTE, lsh, exact_ctes("purchases", "x")) + _quality("pu_jac", "x_exact", min_sim)


def sql_lsh_quality_users(min_sim: float = 0.25) -> str:
    lsh = recall_ctes("strain", "s", min_sim, SWAPPED_USERS)
    return with_(RATINGS_CTE, SWAPPED, lsh, exact_ctes("strain", "x")) + _quality("s_jac", "x_exact", min_sim)


def sql_similar_users(min_sim: float = 0.25) -> str:
    return with_(RATINGS_CTE, SWAPPED, exact_ctes("strain", "s")) + f"""
SELECT id1, id2, round(similarity, 6) AS similarity FROM s_exact WHERE similarity >= {min_sim}"""


def sql_recommend_als() -> str:
    return with_(RATINGS_CTE, KNOWN_KEYS) + "\nSELECT user_id, item_id, 1 AS n FROM known"


KNOWN_KEYS = """known AS (
  SELECT DISTINCT user_id, item_id FROM valid
  WHERE user_id IN (SELECT user_id FROM train) AND item_id IN (SELECT item_id FROM train)
)"""


def sql_als_scores() -> str:
    return with_(RATINGS_CTE, KNOWN_KEYS) + "\nSELECT user_id, item_id, true AS is_product FROM known"


def sql_als_factors() -> str:
    return with_(RATINGS_CTE) + "\nSELECT DISTINCT user_id, true AS solves FROM train"


def sql_rmse_als() -> str:
    return with_(RATINGS_CTE, KNOWN_KEYS) + """
SELECT count(*) AS n, true AS below_user_means FROM known k JOIN valid v ON v.user_id = k.user_id AND v.item_id = k.item_id"""


def sql_als_item_factors() -> str:
    return with_(RATINGS_CTE) + "\nSELECT DISTINCT item_id, true AS solves FROM train"


def sql_als_objective() -> str:
    return with_(RATINGS_CTE) + """
SELECT iterations, true AS falls, (SELECT count(*) FROM train) AS n_ratings FROM (VALUES (1), (9), (27)) t(iterations)"""


def _estimate(found: str, src: str, min_sim: float, sample: int = 200, z: float = 1.96) -> str:
    return f""",
e_iu AS (SELECT DISTINCT item_id, user_id FROM {src}),
e_size AS (SELECT item_id, count(*) AS n FROM e_iu GROUP BY item_id),
drawn AS (SELECT item_id FROM e_size ORDER BY md5(CAST(item_id AS VARCHAR)), item_id LIMIT {sample}),
shared AS (
  SELECT a.item_id AS a, b.item_id AS b, count(*) AS c
  FROM e_iu a JOIN e_iu b ON a.user_id = b.user_id AND a.item_id <> b.item_id
  WHERE a.item_id IN (SELECT item_id FROM drawn) GROUP BY 1, 2),
truth AS (
  SELECT DISTINCT least(a, b) AS id1, greatest(a, b) AS id2
  FROM shared JOIN e_size x ON x.item_id = a JOIN e_size y ON y.item_id = b WHERE c / (x.n + y.n - c) >= {min_sim}),
counts AS (
  SELECT (SELECT count(*) FROM drawn) AS n_items, count(*) AS n_truth, count(f.id1) AS hits
  FROM truth t LEFT JOIN (SELECT id1, id2 FROM {found} WHERE similarity >= {min_sim}) f ON f.id1 = t.id1 AND f.id2 = t.id2),
p AS (SELECT *, CASE WHEN n_truth > 0 THEN hits / n_truth END AS p, CAST(n_truth AS DOUBLE) AS n FROM counts)
SELECT n_items, n_truth, hits, round(p, 6) AS recall,
       round((p + {z} * {z} / (2 * n) - {z} * sqrt(p * (1 - p) / n + {z} * {z} / (4 * n * n))) / (1 + {z} * {z} / n), 6) AS low,
       round((p + {z} * {z} / (2 * n) + {z} * sqrt(p * (1 - p) / n + {z} * {z} / (4 * n * n))) / (1 + {z} * {z} / n), 6) AS high
FROM p"""


def sql_recall_estimate_docs(min_sim: float = 0.5) -> str:
    return with_(DOC_PAIRS_CTE, family_values(), lsh_ctes("doc_pairs", "d")) + _estimate("d_jac", "doc_pairs", min_sim)


def sql_recall_estimate_purchases(min_sim: float = 0.1) -> str:
    return with_(PURCHASES_CTE, recall_ctes("purchases", "pu", min_sim)) + _estimate("pu_jac", "purchases", min_sim)


def sql_csv_quarantine() -> str:
    return with_(RATINGS_CTE) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, item_id, rating, NULL AS reason, NULL AS line FROM train
UNION ALL
SELECT NULL, NULL, NULL, CASE user_id % 4 WHEN 0 THEN 'fields' WHEN 1 THEN 'fields' WHEN 2 THEN 'rating' ELSE 'id' END,
       CASE user_id % 4 WHEN 0 THEN user_id || ',' || item_id WHEN 1 THEN user_id || ',' || item_id || ',3,4'
            WHEN 2 THEN user_id || ',' || item_id || ',three' ELSE ' ,' || item_id || ',3' END
FROM valid"""


REPEATED_CTE = """
train AS (
  SELECT user_id, item_id, max(rating) AS rating FROM (
    SELECT o_custkey AS user_id, p_brand || '|' || p_type AS item_id, CAST(ceil(l_quantity / 10) AS DOUBLE) AS rating
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey) l
  WHERE NOT EXISTS (SELECT 1 FROM valid v WHERE v.user_id = l.user_id AND v.item_id = l.item_id)
  GROUP BY user_id, item_id)"""


def sql_repeated_ratings() -> str:
    ratings = RATINGS_CTE[: RATINGS_CTE.index("train AS")] + RATINGS_CTE[RATINGS_CTE.index("valid AS") :]
    ctes = [ratings + "," + REPEATED_CTE, *_item_based_ctes()[1:]]
    return with_(*ctes) + "\nSELECT user_id, item_id, round(prediction, 6) AS prediction FROM ipred"


def sql_csv_ratings() -> str:
    return with_(RATINGS_CTE) + "\nSELECT CAST(user_id AS VARCHAR) AS user_id, item_id || ', x' AS item_id, rating FROM train"


def sql_csv_pairs() -> str:
    return with_(RATINGS_CTE) + "\nSELECT CAST(user_id AS VARCHAR) AS user_id, item_id FROM train"


def sql_csv_truth(min_sim: float = 0.2) -> str:
    return with_(RATINGS_CTE, recall_ctes("train", "r", 0.2, RATING_USERS)) + f"""
SELECT id1, id2 FROM r_jac WHERE similarity >= {min_sim}"""


def sql_csv_predictions() -> str:
    # Through a decimal, so that a tie is one of the printed number and not of its binary form.
    return with_(RATINGS_CTE, STATS_CTES, MEAN_PRED_CTE) + """
SELECT CAST(user_id AS VARCHAR) AS user_id, item_id AS business_id,
       CAST(CAST(round(CAST(prediction AS DECIMAL(18, 13)), 2) AS DECIMAL(10, 2)) AS VARCHAR) AS prediction
FROM mpred"""


ORACLE = {
    "ratings_fixture": sql_ratings_fixture(),
    "dense_index": sql_dense_index(),
    "union_index": sql_union_index(),
    "baskets": sql_baskets(),
    "minhash_signature": sql_minhash_signature(),
    "lsh_candidates": sql_lsh_candidates(),
    "lsh_jaccard": sql_lsh_jaccard(),
    "similar_pairs_docs": sql_similar_pairs_docs(),
    "top_pairs_sorted": sql_top_pairs_sorted(),
    "similar_pairs_events": sql_similar_pairs_events(),
    "similar_pairs_ratings": sql_similar_pairs_ratings(),
    "similar_pairs_purchases": sql_similar_pairs_purchases(),
    "jaccard_exact": sql_jaccard_exact(),
    "lsh_quality": sql_lsh_quality(),
    "exclude_pairs": sql_exclude_pairs(),
    "swap_roles": sql_swap_roles(),
    "user_mean": sql_user_mean(),
    "item_mean": sql_item_mean(),
    "similarity_active": sql_similarity("active"),
    "similarity_own": sql_similarity("own"),
    "neighbours": sql_neighbours(),
    "predict_item_based": sql_predict_item_based(),
    "predict_user_based": sql_predict_user_based(),
    "predict_mean": sql_predict_mean(),
    "knn_items": sql_knn_items(),
    "knn_users": sql_knn_users(),
    "rmse_item_based": sql_rmse_item_based(),
    "rmse_user_based": sql_rmse_user_based(),
    "rmse_mean": sql_rmse_mean(),
    "lsh_quality_ratings": sql_lsh_quality_ratings(),
    "als_explicit": sql_als_scores(),
    "als_implicit": sql_als_scores(),
    "als_explicit_factors": sql_als_factors(),
    "als_implicit_factors": sql_als_factors(),
    "rmse_als": sql_rmse_als(),
    "als_explicit_item_factors": sql_als_item_factors(),
    "als_implicit_item_factors": sql_als_item_factors(),
    "als_objective": sql_als_objective(),
    "recall_estimate_docs": sql_recall_estimate_docs(),
    "recall_estimate_purchases": sql_recall_estimate_purchases(),
    "csv_quarantine": sql_csv_quarantine(),
    "recommend_item": sql_predict_item_based(),
    "recommend_mean": sql_rmse_mean(),
    "recommend_user": sql_predict_user_based(),
    "recommend_als": sql_recommend_als(),
    "similar_users": sql_similar_users(),
    "lsh_quality_users": sql_lsh_quality_users(),
    "lsh_quality_purchases": sql_lsh_quality_purchases(),
    "repeated_ratings": sql_repeated_ratings(),
    "csv_ratings": sql_csv_ratings(),
    "csv_pairs": sql_csv_pairs(),
    "csv_truth": sql_csv_truth(),
    "csv_predictions": sql_csv_predictions(),
}
