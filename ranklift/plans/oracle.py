"""DuckDB reference SQL for every checkable query.

The correctness gate runs these next to the Spark queries on the raw tables
(``lineitem orders part customer embeddings`` views). Each query is assembled
from named CTE fragments; ``build(final, needs)`` pulls in the fragments a query
depends on, in dependency order. Doubles are rounded to 6 dp on both sides.
"""

from __future__ import annotations

from ..config import RunConfig, Window

CFG = RunConfig()
K = CFG.k

# name -> (sql body, dependencies)
FRAGMENTS: dict[str, tuple[str, tuple[str, ...]]] = {}


def frag(name: str, body: str, *deps: str) -> None:
    FRAGMENTS[name] = (body, deps)


def build(final: str, *needs: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in FRAGMENTS[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    ctes = ",\n".join(f"{n} AS (\n{FRAGMENTS[n][0]}\n)" for n in order)
    return f"WITH {ctes}\n{final}"


def r6(expr: str) -> str:
    return f"round({expr}, 6)"


# ---------------------------------------------------------------- fixtures
_DIRT = "(o.o_orderkey % 97)"
_Q = "(lower(trim(o.o_orderpriority)) || ' ' || CAST(o.o_orderkey % 40 AS VARCHAR))"
_USER = f"""CASE {_DIRT} WHEN 0 THEN NULL WHEN 1 THEN 'null' WHEN 2 THEN '' WHEN 3 THEN 'undefined'
              ELSE 'U' || CAST(o.o_custkey AS VARCHAR) END"""
_QUERY = f"CASE {_DIRT} WHEN 5 THEN ' a ' WHEN 8 THEN '  ' || upper({_Q}) || '  ' ELSE {_Q} END"
_COPIES = f"JOIN (VALUES (1), (2)) dup(c) ON dup.c = 1 OR {_DIRT} = 9"

frag(
    "cart_events",
    f"""SELECT strftime(o.o_orderdate, '%Y%m%d') AS event_dt,
       {_USER} AS userid,
       'C' || CAST(o.o_orderkey AS VARCHAR) AS correlation_id,
       {_QUERY} AS search_query,
       CASE {_DIRT} WHEN 4 THEN '(not set)' ELSE 'I' || CAST(l.l_partkey AS VARCHAR) END AS item_id,
       CASE {_DIRT} WHEN 6 THEN CAST(-1 AS DOUBLE) ELSE CAST(l.l_linenumber - 1 AS DOUBLE) END AS item_list_index,
       CASE {_DIRT} WHEN 7 THEN CAST(NULL AS DOUBLE) ELSE l.l_extendedprice END AS price,
       p.p_name AS item_name
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN part p ON l.l_partkey = p.p_partkey
{_COPIES}""",
)

frag(
    "result_rows",
    """SELECT r.orderkey, r.partkey,
       row_number() OVER (PARTITION BY r.orderkey ORDER BY r.sort_key, r.partkey) AS position
FROM (
  SELECT l_orderkey AS orderkey, l_partkey AS partkey, CAST(l_linenumber AS BIGINT) AS sort_key FROM lineitem
  UNION ALL
  SELECT o_orderkey, (o_orderkey * 31 + t.i * 17) % (SELECT count(*) FROM part), 10 + t.i
  FROM orders CROSS JOIN range(1, 7) t(i)
) r""",
)

frag(
    "search_results",
    f"""SELECT CAST(o.o_orderdate AS DATE) AS SCL_CREATED_DATE,
       {_USER} AS customer_id,
       'C' || CAST(o.o_orderkey AS VARCHAR) AS correlation_id,
       {_QUERY} AS request_term,
       CAST(r.partkey AS VARCHAR) AS response_item_number,
       CASE {_DIRT} WHEN 4 THEN '(not set)' ELSE 'I' || CAST(r.partkey AS VARCHAR) END AS response_sku,
       CAST(r.position AS DOUBLE) AS response_position,
       p.p_name AS response_name
FROM result_rows r JOIN orders o ON r.orderkey = o.o_orderkey
LEFT JOIN part p ON r.partkey = p.p_partkey
{_COPIES}""",
    "result_rows",
)

frag(
    "user_factors",
    """SELECT 'U' || CAST(c.c_custkey AS VARCHAR) AS id, CAST(e.embedding AS DOUBLE[]) AS features
FROM customer c JOIN embeddings e ON e.vec_id = c.c_custkey % (SELECT count(*) FROM embeddings)
WHERE c.c_custkey % 10 <> 0""",
)

frag(
    "item_factors",
    """SELECT 'I' || CAST(p.p_partkey AS VARCHAR) AS id, CAST(e.embedding AS DOUBLE[]) AS features
FROM part p JOIN embeddings e ON e.vec_id = (p.p_partkey * 3 + 1) % (SELECT count(*) FROM embeddings)
WHERE p.p_partkey % 20 <> 0""",
)

frag(
    "rerank_requests",
    """SELECT request_id, userid, list(item ORDER BY position) AS products
FROM (
  SELECT r.orderkey AS request_id, 'U' || CAST(o.o_custkey AS VARCHAR) AS userid,
         'I' || CAST(r.partkey AS VARCHAR) AS item, min(r.position) AS position
  FROM result_rows r JOIN orders o ON r.orderkey = o.o_orderkey
  WHERE 'U' || CAST(o.o_custkey AS VARCHAR) IN (SELECT id FROM user_factors)
    AND 'I' || CAST(r.partkey AS VARCHAR) IN (SELECT id FROM item_factors)
  GROUP BY 1, 2, 3
) GROUP BY request_id, userid""",
    "result_rows",
    "user_factors",
    "item_factors",
)

# ---------------------------------------------------------------- cleaning
ONE_DAY = "20000203"


def _cleaning_frags(prefix: str, window: Window) -> None:
    frag(
        f"{prefix}cart_adds",
        f"""SELECT DISTINCT CAST(strptime(event_dt, '%Y%m%d') AS DATE) AS fecha,
       lower(trim(search_query)) AS search_query, userid, correlation_id,
       item_id AS a2c_itemid, CAST(item_list_index AS DOUBLE) AS a2c_position
FROM cart_events
WHERE event_dt BETWEEN '{window.start}' AND '{window.end}'
  AND userid NOT IN ('null', '', 'undefined')
  AND item_id NOT IN ('null', '', '(not set)')
  AND correlation_id NOT IN ('null', '')
  AND search_query NOT IN ('null', '')
  AND length(trim(search_query)) >= 3
  AND item_list_index >= 0""",
        "cart_events",
    )
    frag(
        f"{prefix}impressions",
        f"""SELECT SCL_CREATED_DATE AS fecha, customer_id AS userid, correlation_id,
       response_sku AS imp_itemid, CAST(response_position AS DOUBLE) - 1.0 AS imp_position
FROM search_results
WHERE SCL_CREATED_DATE BETWEEN DATE '{window.start_iso}' AND DATE '{window.end_iso}'
  AND customer_id NOT IN ('null', '', 'undefined')
  AND correlation_id NOT IN ('null', '')
  AND length(trim(request_term)) >= 3""",
        "search_results",
    )


_cleaning_frags("", CFG.replay)
_cleaning_frags("day_", Window(ONE_DAY, ONE_DAY))

# ---------------------------------------------------------------- affinity


def _affinity_frags(prefix: str, start: str, end: str) -> None:
    frag(
        f"{prefix}_uid",
        f"""SELECT userid, item_id AS itemid, CAST(strptime(event_dt, '%Y%m%d') AS DATE) AS event_day,
       CAST(1 AS BIGINT) AS interaccion, count(*) AS n_items, sum(price) AS total_price
FROM cart_events
WHERE event_dt BETWEEN '{start}' AND '{end}'
  AND userid IS NOT NULL AND userid NOT IN ('null', '')
  AND item_id IS NOT NULL AND item_id NOT IN ('(not set)', 'null', '')
GROUP BY 1, 2, 3""",
        "cart_events",
    )
    frag(
        f"{prefix}_totals",
        f"""SELECT userid, event_day, sum(n_items) AS n_total_items_per_day, sum(total_price) AS n_total_price_per_day
FROM {prefix}_uid GROUP BY 1, 2""",
        f"{prefix}_uid",
    )
    frag(
        f"{prefix}_weights",
        f"""SELECT m.userid, m.itemid, m.interaccion, m.n_items, m.total_price,
       t.n_total_items_per_day, t.n_total_price_per_day, m.event_day,
       CAST(m.n_items AS DOUBLE) / NULLIF(CAST(t.n_total_items_per_day AS DOUBLE), 0) AS weight_items,
       m.total_price / NULLIF(t.n_total_price_per_day, 0) AS weight_price
FROM {prefix}_uid m LEFT JOIN {prefix}_totals t ON m.userid = t.userid AND m.event_day = t.event_day""",
        f"{prefix}_uid",
        f"{prefix}_totals",
    )
    frag(
        f"{prefix}_matrix",
        f"""SELECT userid, itemid, affinity_score AS rating FROM (
  SELECT userid, itemid, 1.0 + sum(weight_items) + sum(weight_price) AS affinity_score
  FROM {prefix}_weights WHERE interaccion = 1 GROUP BY 1, 2
) WHERE affinity_score IS NOT NULL""",
        f"{prefix}_weights",
    )


def matrix_stats_select(matrix: str, window: Window) -> str:
    return f"""SELECT DATE '{window.end_iso}' - DATE '{window.start_iso}' AS n_days,
       count(DISTINCT userid) AS n_users, count(DISTINCT itemid) AS n_items,
       count(DISTINCT userid) * count(DISTINCT itemid) AS n_cells, count(*) AS n_rows,
       round_even(100.0 * count(*) / (count(DISTINCT userid) * count(DISTINCT itemid)), 2) AS density_pct
FROM {matrix}"""


_affinity_frags("train", CFG.train.start, CFG.train.end)
_affinity_frags("test", CFG.test.start, CFG.test.end)

# ---------------------------------------------------------------- sampling / replay
_GROUP = "fecha, userid, correlation_id, search_query, a2c_itemid"
_ON_GROUP = " AND ".join(f"a.{c} = b.{c}" for c in ["fecha", "userid", "correlation_id", "search_query", "a2c_itemid"])


def _h60(expr: str) -> str:
    return f"('0x' || substr(md5({expr}), 1, 15))::BIGINT"


frag(
    "numbered_adds",
    f"""SELECT *,
       row_number() OVER (PARTITION BY search_query
                          ORDER BY h, fecha, userid, correlation_id, a2c_itemid, a2c_position) AS rn,
       count(*) OVER (PARTITION BY search_query) AS len
FROM (SELECT *, {_h60("concat_ws('|', CAST(fecha AS VARCHAR), userid, correlation_id, a2c_itemid, CAST(CAST(floor(a2c_position) AS BIGINT) AS VARCHAR))")} AS h
      FROM cart_adds)""",
    "cart_adds",
)

frag(
    "sampled",
    f"""SELECT n.fecha, n.search_query, n.userid, n.correlation_id, n.a2c_itemid, n.a2c_position, d.draw
FROM (
  SELECT search_query, draw,
         1 + ({_h60("'" + str(CFG.sample_seed) + "|' || search_query || '|' || CAST(draw AS VARCHAR)")} % len) AS rn
  FROM (
    SELECT search_query, len, unnest(range(1, n + 1)) AS draw
    FROM (SELECT DISTINCT search_query, len,
                 CAST(floor(CAST(len AS DOUBLE) * CAST({CFG.sample_size!r} AS DOUBLE)) AS BIGINT) AS n
          FROM numbered_adds)
    WHERE n > 0
  )
) d JOIN numbered_adds n ON n.search_query = d.search_query AND n.rn = d.rn""",
    "numbered_adds",
)

frag(
    "top_q",
    f"""SELECT * FROM (
  SELECT search_query, count(userid) AS n_adds,
         row_number() OVER (ORDER BY count(userid) DESC, search_query) AS query_rank
  FROM sampled GROUP BY search_query
) WHERE query_rank <= {CFG.top_n_queries}""",
    "sampled",
)

frag(
    "merged",
    """SELECT i.fecha, i.userid, i.correlation_id, i.imp_itemid, i.imp_position,
       s.search_query, s.a2c_itemid, s.a2c_position
FROM impressions i
JOIN (SELECT * FROM sampled WHERE search_query IN (SELECT search_query FROM top_q)) s
  ON i.fecha = s.fecha AND i.userid = s.userid AND i.correlation_id = s.correlation_id""",
    "impressions",
    "sampled",
    "top_q",
)

_COLD = "repeat([CAST(-1 AS DOUBLE)], (SELECT max(len(features)) FROM item_factors))"


def _pair_score(metric: str, u: str, v: str) -> str:
    if metric == "dot_product":
        return f"list_inner_product({u}, {v})"
    return f"sqrt(list_sum(list_transform(list_zip({u}, {v}), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))"


def _key(metric: str, expr: str) -> str:
    return f"round({expr}, 9) DESC" if metric == "dot_product" else f"round({expr}, 9) ASC"


def _replay_frags(metric: str) -> None:
    s = "dot" if metric == "dot_product" else "euc"
    frag(
        f"predicted_{s}",
        f"""SELECT m.*, {_pair_score(metric, f"coalesce(u.features, {_COLD})", f"coalesce(it.features, {_COLD})")} AS prediction
FROM merged m LEFT JOIN user_factors u ON m.userid = u.id LEFT JOIN item_factors it ON m.imp_itemid = it.id""",
        "merged",
        "user_factors",
        "item_factors",
    )
    frag(
        f"ranked_{s}",
        f"""SELECT *,
       row_number() OVER (PARTITION BY {_GROUP} ORDER BY {_key(metric, "prediction")}, imp_position, imp_itemid) AS pred_rank,
       row_number() OVER (PARTITION BY {_GROUP} ORDER BY imp_position, imp_itemid) AS slot_rank
FROM predicted_{s}""",
        f"predicted_{s}",
    )
    frag(
        f"slots_{s}",
        f"""SELECT a.fecha, a.userid, a.correlation_id, a.search_query, a.a2c_itemid,
       a.pred_rank AS slot, a.imp_itemid AS predict_itemid, a.prediction, b.imp_position
FROM ranked_{s} a JOIN ranked_{s} b ON {_ON_GROUP} AND a.pred_rank = b.slot_rank""",
        f"ranked_{s}",
    )
    frag(
        f"shift_rows_{s}",
        f"""SELECT c.fecha, c.userid, c.correlation_id, c.search_query, c.a2c_itemid,
       c.current_pos, p.predict_pos, c.current_pos - p.predict_pos AS diff_pos
FROM (SELECT {_GROUP}, imp_position AS current_pos FROM merged WHERE imp_itemid = a2c_itemid) c
JOIN (SELECT {_GROUP}, imp_position AS predict_pos FROM slots_{s} WHERE predict_itemid = a2c_itemid) p
  ON c.fecha = p.fecha AND c.userid = p.userid AND c.correlation_id = p.correlation_id
 AND c.search_query = p.search_query AND c.a2c_itemid = p.a2c_itemid""",
        "merged",
        f"slots_{s}",
    )


_replay_frags("dot_product")
_replay_frags("euclidean_distance")


def improvement_select(source: str, mai_digits: int, by: str | None = None) -> str:
    keys = f"{by}, " if by else ""
    qs = ", ".join(
        f"{r6(f'quantile_cont(diff_pos, {q})')} AS {nm}"
        for q, nm in [(0.1, "q10"), (0.25, "q25"), (0.5, "q50"), (0.75, "q75"), (0.9, "q90")]
    )
    body = f"""SELECT {keys}count(*) AS n, {r6('avg(diff_pos)')} AS mean_diff, {qs},
       {r6('avg(current_pos)')} AS mean_current, {r6('avg(predict_pos)')} AS mean_predict,
       round_even(avg(diff_pos) / NULLIF(avg(current_pos), 0), {mai_digits}) AS mai,
       round_even(avg(diff_pos), 2) AS manip
FROM {source}"""
    return body + (f" GROUP BY {by}" if by else "")

# ---------------------------------------------------------------- vectors, rank metrics, rerank
frag(
    "test_known",
    """SELECT * FROM test_matrix
WHERE userid IN (SELECT id FROM user_factors) AND itemid IN (SELECT id FROM item_factors)""",
    "test_matrix",
    "user_factors",
    "item_factors",
)

frag(
    "known_vectors",
    """WITH m AS MATERIALIZED (SELECT userid, itemid, rating FROM test_matrix),
     us AS MATERIALIZED (SELECT id, features FROM user_factors),
     its AS MATERIALIZED (SELECT id, features FROM item_factors),
     mu AS MATERIALIZED (SELECT m.*, us.features AS uf FROM m JOIN us ON m.userid = us.id)
SELECT mu.userid, mu.itemid, mu.rating, mu.uf, its.features AS vf FROM mu JOIN its ON mu.itemid = its.id""",
    "test_matrix",
    "user_factors",
    "item_factors",
)

frag(
    "all_scores",
    """SELECT u.id AS userid, i.id AS itemid, list_inner_product(u.features, i.features) AS score,
       round(list_inner_product(u.features, i.features), 9) AS key, coalesce(t.rating, 0.0) AS gain
FROM (SELECT * FROM user_factors WHERE id IN (SELECT userid FROM test_known)) u
CROSS JOIN (SELECT * FROM item_factors WHERE id IN (SELECT itemid FROM test_known)) i
LEFT JOIN test_known t ON t.userid = u.id AND t.itemid = i.id""",
    "test_known",
)

frag(
    "pred_items",
    f"""SELECT userid, itemid, score, row_number() OVER (PARTITION BY userid ORDER BY key DESC, itemid) AS rank
FROM all_scores QUALIFY rank <= {K}""",
    "all_scores",
)

frag(
    "levels",
    f"""SELECT * FROM (
  SELECT userid, key AS level_key, n_items, gain_sum,
         coalesce(sum(n_items) OVER (PARTITION BY userid ORDER BY key DESC
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS level_start
  FROM (SELECT userid, key, count(*) AS n_items, sum(gain) AS gain_sum FROM all_scores GROUP BY 1, 2)
) WHERE level_start <= {K}""",
    "all_scores",
)

frag(
    "all_scores_euc",
    """SELECT u.id AS userid, i.id AS itemid, list_distance(u.features, i.features) AS score,
       -round(list_distance(u.features, i.features), 9) AS key, coalesce(t.rating, 0.0) AS gain
FROM (SELECT * FROM user_factors WHERE id IN (SELECT userid FROM test_known)) u
CROSS JOIN (SELECT * FROM item_factors WHERE id IN (SELECT itemid FROM test_known)) i
LEFT JOIN test_known t ON t.userid = u.id AND t.itemid = i.id""",
    "test_known",
)

frag(
    "pred_items_euc",
    f"""SELECT userid, itemid, score, row_number() OVER (PARTITION BY userid ORDER BY key DESC, itemid) AS rank
FROM all_scores_euc QUALIFY rank <= {K}""",
    "all_scores_euc",
)

frag(
    "levels_euc",
    f"""SELECT * FROM (
  SELECT userid, key AS level_key, n_items, gain_sum,
         coalesce(sum(n_items) OVER (PARTITION BY userid ORDER BY key DESC
                                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + 1 AS level_start
  FROM (SELECT userid, key, count(*) AS n_items, sum(gain) AS gain_sum FROM all_scores_euc GROUP BY 1, 2)
) WHERE level_start <= {K}""",
    "all_scores_euc",
)

frag(
    "disc",
    f"""SELECT j, 1.0 / log2(j + 1) AS d, sum(1.0 / log2(j + 1)) OVER (ORDER BY j) AS c
FROM range(1, {K} + 1) t(j)
UNION ALL SELECT 0, 0.0, 0.0""",
)

frag(
    "rel_topk",
    f"""SELECT userid, itemid, rating, row_number() OVER (PARTITION BY userid ORDER BY rating DESC, itemid) AS rank
FROM test_known QUALIFY rank <= {K}""",
    "test_known",
)

frag(
    "ndcg_users",
    f"""SELECT d.userid, d.dcg, coalesce(i.idcg, 0.0) AS idcg, coalesce(d.dcg / NULLIF(i.idcg, 0), 0.0) AS ndcg
FROM (
  SELECT l.userid, sum(l.gain_sum / l.n_items * (ce.c - cs.c)) AS dcg
  FROM levels l
  JOIN disc ce ON ce.j = least(l.level_start + l.n_items - 1, {K})
  JOIN disc cs ON cs.j = l.level_start - 1
  GROUP BY l.userid
) d LEFT JOIN (
  SELECT r.userid, sum(r.rating * dd.d) AS idcg FROM rel_topk r JOIN disc dd ON dd.j = r.rank GROUP BY r.userid
) i ON d.userid = i.userid""",
    "levels",
    "disc",
    "rel_topk",
)

frag(
    "ndcg_users_euc",
    f"""SELECT d.userid, d.dcg, coalesce(i.idcg, 0.0) AS idcg, coalesce(d.dcg / NULLIF(i.idcg, 0), 0.0) AS ndcg
FROM (
  SELECT l.userid, sum(l.gain_sum / l.n_items * (ce.c - cs.c)) AS dcg
  FROM levels_euc l
  JOIN disc ce ON ce.j = least(l.level_start + l.n_items - 1, {K})
  JOIN disc cs ON cs.j = l.level_start - 1
  GROUP BY l.userid
) d LEFT JOIN (
  SELECT r.userid, sum(r.rating * dd.d) AS idcg FROM rel_topk r JOIN disc dd ON dd.j = r.rank GROUP BY r.userid
) i ON d.userid = i.userid""",
    "levels_euc",
    "disc",
    "rel_topk",
)

frag(
    "hits",
    """SELECT p.userid, p.rank, p.itemid, CASE WHEN r.itemid IS NULL THEN 0 ELSE 1 END AS hit
FROM pred_items p LEFT JOIN rel_topk r ON p.userid = r.userid AND p.itemid = r.itemid""",
    "pred_items",
    "rel_topk",
)

frag(
    "hits_euc",
    """SELECT p.userid, p.rank, p.itemid, CASE WHEN r.itemid IS NULL THEN 0 ELSE 1 END AS hit
FROM pred_items_euc p LEFT JOIN rel_topk r ON p.userid = r.userid AND p.itemid = r.itemid""",
    "pred_items_euc",
    "rel_topk",
)

frag(
    "ap_users",
    """SELECT userid, CAST(sum(hit) AS BIGINT) AS n_hits,
       coalesce(sum(prec * hit) / NULLIF(sum(hit), 0), 0.0) AS ap
FROM (SELECT *, sum(hit) OVER (PARTITION BY userid ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / rank AS prec
      FROM hits)
GROUP BY userid""",
    "hits",
)

frag(
    "ap_users_euc",
    """SELECT userid, CAST(sum(hit) AS BIGINT) AS n_hits,
       coalesce(sum(prec * hit) / NULLIF(sum(hit), 0), 0.0) AS ap
FROM (SELECT *, sum(hit) OVER (PARTITION BY userid ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) / rank AS prec
      FROM hits_euc)
GROUP BY userid""",
    "hits_euc",
)

frag(
    "recall_users",
    """SELECT r.userid, r.n_relevant, coalesce(h.n_hits, 0) AS n_hits, coalesce(h.n_hits, 0) / r.n_relevant AS recall
FROM (SELECT userid, count(*) AS n_relevant FROM rel_topk GROUP BY userid) r
LEFT JOIN (SELECT userid, CAST(sum(hit) AS BIGINT) AS n_hits FROM hits GROUP BY userid) h ON r.userid = h.userid""",
    "rel_topk",
    "hits",
)

frag(
    "recall_users_euc",
    """SELECT r.userid, r.n_relevant, coalesce(h.n_hits, 0) AS n_hits, coalesce(h.n_hits, 0) / r.n_relevant AS recall
FROM (SELECT userid, count(*) AS n_relevant FROM rel_topk GROUP BY userid) r
LEFT JOIN (SELECT userid, CAST(sum(hit) AS BIGINT) AS n_hits FROM hits_euc GROUP BY userid) h ON r.userid = h.userid""",
    "rel_topk",
    "hits_euc",
)

frag(
    "whole_requests",
    """SELECT request_id, userid, list(item ORDER BY position) AS products
FROM (
  SELECT r.orderkey AS request_id, 'U' || CAST(o.o_custkey AS VARCHAR) AS userid,
         'I' || CAST(r.partkey AS VARCHAR) AS item, min(r.position) AS position
  FROM result_rows r JOIN orders o ON r.orderkey = o.o_orderkey
  GROUP BY 1, 2, 3
) GROUP BY request_id, userid""",
    "result_rows",
)

frag(
    "whole_exploded",
    """SELECT request_id, userid, unnest(products) AS itemid, unnest(range(len(products))) AS pos
FROM whole_requests""",
    "whole_requests",
)

frag(
    "req_exploded",
    """SELECT request_id, userid, unnest(products) AS itemid, unnest(range(len(products))) AS pos
FROM rerank_requests""",
    "rerank_requests",
)


def rerank_sql(metric: str, whole: bool = False) -> str:
    """``whole``: all requests, with a null score, last, where a vector is missing."""
    requests, join = ("whole_exploded", "LEFT JOIN") if whole else ("req_exploded", "JOIN")
    if metric == "list_norm":
        s = ("list_inner_product(u.features, i.features) / (sqrt(list_inner_product(u.features, u.features))"
             " * sqrt(sum(list_inner_product(i.features, i.features)) OVER (PARTITION BY e.request_id)))")
        order = "DESC"
    elif metric == "per_item_length":
        s, order = "list_inner_product(u.features, i.features) / sqrt(list_inner_product(i.features, i.features))", "DESC"
    elif metric == "dot_product":
        s, order = "list_inner_product(u.features, i.features)", "DESC"
    elif metric == "cosine":
        s, order = "list_cosine_similarity(u.features, i.features)", "DESC"
    else:
        s, order = "sqrt(list_sum(list_transform(list_zip(u.features, i.features), lambda p: (p[1] - p[2]) * (p[1] - p[2]))))", "ASC"
    return build(
        f"""SELECT request_id, userid, CAST(row_number() OVER (PARTITION BY request_id ORDER BY round(score, 9) {order} NULLS LAST, pos) AS BIGINT) AS rank,
       itemid, {r6('score')} AS score
FROM (SELECT e.request_id, e.userid, e.itemid, e.pos, {s} AS score
      FROM {requests} e {join} user_factors u ON e.userid = u.id {join} item_factors i ON e.itemid = i.id)""",
        requests,
        "user_factors",
        "item_factors",
    )
