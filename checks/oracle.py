"""SQL twins of the registered queries, written for DuckDB."""

from __future__ import annotations

_EVENTS = """ev AS (
  SELECT event_id, ts, CAST(user_id AS INTEGER) AS user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
  FROM events)"""

_LOG = """log AS (
  SELECT event_id, concat_ws('.', (n >> 24) & 255, (n >> 16) & 255, (n >> 8) & 255, n & 255) AS ip
  FROM (SELECT event_id, 16777216::BIGINT + event_id * 11 + user_id % 7 AS n FROM events)),
nums AS (
  SELECT event_id, ip,
    split_part(ip, '.', 1)::BIGINT * 16777216 + split_part(ip, '.', 2)::BIGINT * 65536
    + split_part(ip, '.', 3)::BIGINT * 256 + split_part(ip, '.', 4)::BIGINT AS ip_num
  FROM log)"""

_RANGES = """ranges AS (
  SELECT 16777216::BIGINT + s_suppkey * 1024 AS lo,
         16777216::BIGINT + s_suppkey * 1024 + 699 + (s_suppkey % 5) * 100 AS hi,
         concat_ws('-', r_name, n_name, s_name, s_nationkey, n_regionkey) AS location
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_LOCATED = f"""{_LOG}, {_RANGES},
located AS (
  SELECT event_id, location FROM (
    SELECT event_id, location,
           row_number() OVER (PARTITION BY event_id ORDER BY hi - lo, lo, location) AS rn
    FROM nums JOIN ranges ON ip_num BETWEEN lo AND hi)
  WHERE rn = 1)"""

_VECS = "v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings)"


def _pairwise(value: str) -> str:
    return f"""WITH {_VECS},
    p AS (SELECT a.id AS a, a.e AS x, b.e AS y FROM v a JOIN v b ON b.id = a.id + 1)
    SELECT a, round({value}, 6) AS value FROM p"""


_CENTRED = "list_transform({0}, lambda t: t - ({1}))"
_MEAN_BOTH = "(list_sum(x) + list_sum(y)) / (len(x) + len(y))"

_TOP = """top AS (
  SELECT base, item, sim, rank FROM (
    SELECT a.id AS base, b.id AS item, round(list_cosine_similarity(a.e, b.e), 10) AS sim,
           row_number() OVER (PARTITION BY a.id
             ORDER BY round(list_cosine_similarity(a.e, b.e), 10) DESC, b.id) AS rank
    FROM v a JOIN v b ON a.id <> b.id)
  WHERE rank <= 6)"""

_TOP_OUT = "SELECT base, item, sim, CAST(rank AS INTEGER) AS rank FROM top"

_MEANS = """means AS (
  SELECT label, list(m ORDER BY d) AS c FROM (
    SELECT label, d, avg(x) AS m FROM (
      SELECT label, unnest(e) AS x, unnest(range(len(e))) AS d FROM v)
    GROUP BY label, d)
  GROUP BY label),
assigned AS (
  SELECT id, label AS cluster, dist FROM (
    SELECT v.id, means.label, list_distance(v.e, means.c) AS dist,
           row_number() OVER (PARTITION BY v.id
             ORDER BY round(list_distance(v.e, means.c), 10), means.label) AS rn
    FROM v CROSS JOIN means)
  WHERE rn = 1)"""

_BEHAVIOURS = f"""{_EVENTS},
beh AS (
  SELECT user_id, k AS item_id, CASE event_type WHEN 'view' THEN '浏览' WHEN 'click' THEN '收藏'
         WHEN 'purchase' THEN '评价' ELSE event_type END AS operation
  FROM ev)"""


def _score(name: str, source: str, view: float, collect: float, evaluate: float) -> str:
    return f"""{name} AS (
  SELECT user_id, item_id,
         count(*) FILTER (operation = '浏览') * {view}::DOUBLE
         + count(*) FILTER (operation = '收藏') * {collect}::DOUBLE
         + count(*) FILTER (operation = '评价') * {evaluate}::DOUBLE AS score
  FROM {source} GROUP BY user_id, item_id)"""


_SCORES = f"{_BEHAVIOURS}, {_score('scores', 'beh', 1.15, 1.55, 1.30)}"
_STREAM = f"{_BEHAVIOURS}, {_score('scores', 'beh', 0.15, 0.55, 0.30)}"

_OWN_LISTS = """best AS (
  SELECT user_id, item_id, row_number() OVER (
    PARTITION BY user_id ORDER BY round(score, 6) DESC, item_id) AS rank
  FROM own),
lists AS (
  SELECT CAST(user_id AS VARCHAR) AS key, string_agg(item_id, ',' ORDER BY rank) AS value
  FROM best WHERE rank <= 7 GROUP BY user_id)"""

_CHANGES = f"""{_EVENTS},
typed AS (
  SELECT event_id, CAST(k AS BIGINT) AS sid, CASE event_type WHEN 'signup' THEN 'add'
         WHEN 'error' THEN 'delete' WHEN 'purchase' THEN 'update' ELSE event_type END AS type
  FROM ev),
changes AS (
  SELECT sid, arg_max(type, event_id) AS type FROM typed
  WHERE type IN ('add', 'delete', 'update') GROUP BY sid)"""

_CANDIDATES = f"""{_STREAM}, {_VECS}, {_TOP},
cand AS (
  SELECT user_id, item, max(sim * score) AS weight
  FROM scores JOIN top ON top.base = scores.item_id GROUP BY user_id, item),
ranked AS (
  SELECT user_id, item, weight, row_number() OVER (
    PARTITION BY user_id ORDER BY round(weight, 10) DESC, item) AS rank
  FROM cand)"""

_FINE_STATE = f"""{_EVENTS},
state AS (
  SELECT 'profile' AS namespace, concat(user_id, ':', k) AS key,
         arg_max(k, (ts, event_id)) AS value, arg_max(event_id, (ts, event_id)) AS seq, max(ts) AS written
  FROM ev GROUP BY user_id, k)"""

_TEXT_MESSAGES = f"""{_EVENTS},
msg AS (
  SELECT event_id, CASE event_type
    WHEN 'view' THEN concat(user_id, ',浏览,', k)
    WHEN 'click' THEN concat(user_id, ',收藏,', k, ',')
    WHEN 'purchase' THEN concat(' ', user_id::BIGINT + 3000000000, ',评价,', k, ' ')
    WHEN 'signup' THEN '  '
    ELSE concat(user_id, ',浏览') END AS value
  FROM ev),
parts AS (
  SELECT event_id, trim(value) AS t, string_split(regexp_replace(trim(value), ',+$', ''), ',') AS f
  FROM msg),
judged AS (
  SELECT event_id, f, CASE WHEN t = '' THEN 'blank' WHEN len(f) <> 3 THEN 'arity' END AS reject_reason
  FROM parts),
parsed AS (
  SELECT event_id,
    CASE WHEN reject_reason IS NULL THEN CAST(f[1] AS BIGINT) END AS user_id,
    CASE WHEN reject_reason IS NULL THEN f[2] END AS operation,
    CASE WHEN reject_reason IS NULL THEN CAST(f[3] AS BIGINT) END AS item_id,
    reject_reason
  FROM judged)"""

_FACTORS = f"""{_SCORES},
items AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS f FROM embeddings),
dims AS (
  SELECT user_id, d, sum(score * x) / sum(score) AS m FROM (
    SELECT user_id, score, unnest(f) AS x, unnest(range(len(f))) AS d
    FROM scores JOIN items ON items.id = item_id WHERE score > 0)
  GROUP BY user_id, d),
users AS (SELECT user_id AS id, list(m ORDER BY d) AS f FROM dims GROUP BY user_id),
rated_all AS (
  SELECT u.id AS user_id, i.id AS item_id, list_inner_product(u.f, i.f) AS rating FROM users u CROSS JOIN items i)"""


def _recommended(base: str, other: str, n: int, where: str) -> str:
    return f"""b AS (
          SELECT {base}, {other}, rating, row_number() OVER (
            PARTITION BY {base} ORDER BY round(rating, 10) DESC, {other}) AS rank
          FROM rated_all r WHERE {where})
        SELECT {base}, {other}, round(rating, 10) AS rating, CAST(rank AS INTEGER) AS rank FROM b WHERE rank <= {n}"""


ORACLE: dict[str, str] = {
    "ip_to_num": f"""WITH {_LOG}
        SELECT n.event_id, CASE WHEN event_type NOT IN ('error', 'signup') THEN ip_num ELSE -1 END AS ip_num
        FROM nums n JOIN events e ON e.event_id = n.event_id""",
    "ip_location": f"""WITH {_LOCATED}
        SELECT n.event_id, ip, ip_num, coalesce(location, '') AS location FROM nums n LEFT JOIN located l ON l.event_id = n.event_id""",
    "ip_location_count": f"""WITH {_LOCATED}
        SELECT location, count(*) AS ip_count FROM located GROUP BY location""",
    "sim_cosine": _pairwise("list_cosine_similarity(x, y)"),
    "sim_pearson": _pairwise(
        f"list_cosine_similarity({_CENTRED.format('x', 'list_avg(x)')}, {_CENTRED.format('y', 'list_avg(y)')})"
    ),
    "sim_adjusted_cosine": _pairwise(
        f"list_cosine_similarity({_CENTRED.format('x', _MEAN_BOTH)}, {_CENTRED.format('y', _MEAN_BOTH)})"
    ),
    "sim_euclidean": _pairwise("list_distance(x, y)"),
    "topn_cosine": f"WITH {_VECS}, {_TOP} {_TOP_OUT}",
    "topn_pearson": f"""WITH c AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
        v AS (SELECT id, {_CENTRED.format('x', 'list_avg(x)')} AS e FROM c), {_TOP} {_TOP_OUT}""",
    "topn_euclidean": f"""WITH {_VECS} SELECT base, item, round(dist, 10) AS dist, CAST(rank AS INTEGER) AS rank FROM (
        SELECT a.id AS base, b.id AS item, list_distance(a.e, b.e) AS dist, row_number() OVER (
          PARTITION BY a.id ORDER BY round(list_distance(a.e, b.e), 10), b.id) AS rank
        FROM v a JOIN v b ON a.id <> b.id) WHERE rank <= 6""",
    "nearest_euclidean": f"""WITH {_VECS}, q AS (SELECT id, e FROM v WHERE id = (SELECT min(id) FROM v))
        SELECT v.id AS item, round(list_distance(v.e, q.e), 10) AS dist FROM v JOIN q ON v.id <> q.id
        ORDER BY round(list_distance(v.e, q.e), 10), v.id LIMIT 6""",
    "nearest_pearson": f"""WITH {_VECS},
        c AS (SELECT id, {_CENTRED.format('e', 'list_avg(e)')} AS e FROM v),
        q AS (SELECT id, e FROM c WHERE id = (SELECT min(id) FROM v))
        SELECT c.id AS item, round(list_cosine_similarity(c.e, q.e), 10) AS sim FROM c JOIN q ON c.id <> q.id
        ORDER BY round(list_cosine_similarity(c.e, q.e), 10) DESC, c.id LIMIT 6""",
    "topn_encode": f"""WITH {_VECS}, {_TOP}
        SELECT base, string_agg(format('{{}}:{{:.10f}}', item, sim), ',' ORDER BY rank) AS value FROM top GROUP BY base""",
    "topn_decode": f"WITH {_VECS}, {_TOP} {_TOP_OUT}",
    "cluster_nearest": f"""WITH {_VECS}
        SELECT label, base, item, round(dist, 10) AS dist, CAST(rank AS INTEGER) AS rank FROM (
          SELECT a.label, a.id AS base, b.id AS item, list_distance(a.e, b.e) AS dist, row_number() OVER (
            PARTITION BY a.id ORDER BY round(list_distance(a.e, b.e), 10), b.id) AS rank
          FROM v a JOIN v b ON a.label = b.label AND a.id <> b.id) WHERE rank <= 3""",
    "nearest_centroid": f"""WITH {_VECS}, {_MEANS}
        SELECT id AS vec_id, cluster, round(dist, 10) AS distance FROM assigned""",
    "wssse": f"WITH {_VECS}, {_MEANS} SELECT round(sum(dist * dist), 4) AS wssse FROM assigned",
    "cluster_sizes": f"WITH {_VECS}, {_MEANS} SELECT cluster, count(*) AS n_items FROM assigned GROUP BY cluster",
    "feature_vector": """SELECT p_partkey AS schoolid,
          CASE WHEN bad THEN -1 ELSE p_size::DOUBLE END AS f0, CASE WHEN bad THEN -1 ELSE length(p_type)::DOUBLE END AS f1,
          CASE WHEN bad THEN -1 ELSE p_retailprice END AS f2,
          CASE WHEN bad THEN -1 ELSE regexp_extract(p_brand, '#([0-9]+)', 1)::DOUBLE END AS f3,
          CASE WHEN bad THEN -1 ELSE length(p_name)::DOUBLE END AS f4, CASE WHEN bad THEN 'fee' ELSE '' END AS rejected
        FROM (SELECT *, p_partkey % 11 = 0 AS bad FROM part)""",
    "scan_catalog_table": """SELECT p_partkey AS schoolid, p_name AS schoolname, p_size AS locationid,
        p_retailprice AS zs FROM part""",
    "json_fields": f"WITH {_CHANGES} SELECT event_id, type, sid FROM typed",
    "cells_unpivot": """SELECT c_custkey::VARCHAR AS rowkey, 'hfile-fy' AS family, qualifier, value FROM (
          SELECT c_custkey, 'c_name' AS qualifier, c_name AS value FROM customer
          UNION ALL SELECT c_custkey, 'c_nationkey', c_nationkey::VARCHAR FROM customer
          UNION ALL SELECT c_custkey, 'c_acctbal', c_acctbal::VARCHAR FROM customer
          UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer)
        WHERE value IS NOT NULL""",
    "cells_sorted": """SELECT rowkey, 'hfile-fy' AS family, qualifier, value,
          row_number() OVER (ORDER BY rowkey, qualifier) - 1 AS position
        FROM (SELECT s_suppkey::VARCHAR AS rowkey, 's_name' AS qualifier, s_name AS value FROM supplier
          UNION ALL SELECT s_suppkey::VARCHAR, 's_nationkey', s_nationkey::VARCHAR FROM supplier
          UNION ALL SELECT s_suppkey::VARCHAR, 's_acctbal', s_acctbal::VARCHAR FROM supplier)
        WHERE value IS NOT NULL""",
    "parse_behaviour": f"""WITH {_TEXT_MESSAGES}
        SELECT event_id, coalesce(user_id, -1) AS user_id, coalesce(item_id, -1) AS item_id,
               coalesce(operation, '') AS operation, coalesce(reject_reason, '') AS reject_reason
        FROM parsed""",
    "parse_indexed_rating": f"""WITH {_EVENTS}
        SELECT event_id,
          CASE WHEN good THEN user_id::BIGINT + CASE event_type WHEN 'purchase' THEN 3000000000 ELSE 0 END ELSE -1 END AS user_id,
          CASE WHEN good THEN k::BIGINT ELSE -1 END AS item_id, CASE WHEN good THEN event_id ELSE -1 END AS index,
          CASE WHEN good THEN 1.5::DOUBLE ELSE -1 END AS score,
          CASE event_type WHEN 'error' THEN 'arity' WHEN 'signup' THEN 'number' ELSE '' END AS reject_reason
        FROM (SELECT *, event_type NOT IN ('error', 'signup') AS good FROM ev)""",
    "score_offline": f"WITH {_SCORES} SELECT user_id, item_id, round(score, 6) AS score FROM scores",
    "score_stream": f"""WITH {_TEXT_MESSAGES}, good AS (SELECT * FROM parsed WHERE reject_reason IS NULL),
        {_score('scores', 'good', 0.15, 0.55, 0.30)}
        SELECT user_id, item_id, round(score, 6) AS score FROM scores""",
    "user_profile": f"""WITH {_SCORES}
        SELECT user_id, CAST(item_id // 1024 AS BIGINT) AS page,
               string_agg(format('{{}}:{{:.2f}}', item_id, score), ',' ORDER BY item_id) AS items
        FROM scores GROUP BY user_id, item_id // 1024""",
    "ratings_split": f"""WITH {_SCORES}, b AS (
          SELECT user_id, item_id, CAST((user_id::BIGINT * 31 + item_id) % 10 AS INTEGER) AS bucket FROM scores)
        SELECT *, CASE WHEN bucket < 6 THEN 'train' WHEN bucket < 8 THEN 'validation' ELSE 'test' END AS part FROM b""",
    "rating_index": f"""WITH {_SCORES}
        SELECT user_id, item_id, row_number() OVER (ORDER BY user_id, item_id) - 1 AS index FROM scores""",
    "rmse": f"""WITH {_SCORES}, b AS (SELECT *, (user_id::BIGINT * 31 + item_id) % 10 AS bucket FROM scores),
        m AS (SELECT user_id, avg(score) AS p FROM b WHERE bucket < 6 GROUP BY user_id)
        SELECT round(sqrt(avg((p - score) * (p - score))), 6) AS rmse
        FROM b JOIN m ON b.user_id = m.user_id WHERE bucket IN (6, 7)""",
    "unseen_candidates": f"""WITH {_EVENTS},
        cat AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS position FROM embeddings),
        seen AS (SELECT DISTINCT user_id, position FROM ev
          JOIN cat ON cat.vec_id = CASE WHEN user_id % 25 = 7 THEN k + 10000000 ELSE k END),
        unseen AS (
          SELECT u.user_id, cat.position FROM (SELECT DISTINCT user_id FROM ev) u CROSS JOIN cat
          ANTI JOIN seen s ON s.user_id = u.user_id AND s.position = cat.position),
        runs AS (
          SELECT user_id, position, position - row_number() OVER (PARTITION BY user_id ORDER BY position) AS run
          FROM unseen)
        SELECT user_id, min(position) AS first, max(position) AS last FROM runs GROUP BY user_id, run""",
    "user_item_list": f"WITH {_SCORES}, own AS (SELECT * FROM scores), {_OWN_LISTS} SELECT * FROM lists",
    "kv_upsert": f"""WITH {_EVENTS}, w AS (
          SELECT user_id::VARCHAR AS key, k AS value, ts, event_id AS seq FROM ev
          UNION ALL SELECT c_custkey::VARCHAR, c_nationkey, TIMESTAMP '2000-01-01 00:00:00', 0 FROM customer)
        SELECT 'profile' AS namespace, key, arg_max(value, (ts, seq))::VARCHAR AS value,
               arg_max(seq, (ts, seq)) AS seq
        FROM w GROUP BY key""",
    "kv_ttl_live": f"""WITH {_FINE_STATE} SELECT namespace, key, value::VARCHAR AS value, seq FROM state
        WHERE written + INTERVAL 7 DAY > TIMESTAMP '2024-01-30 00:00:00'""",
    "kv_delete": f"""WITH {_FINE_STATE} SELECT namespace, key, value::VARCHAR AS value, seq FROM state
        WHERE key NOT IN (SELECT concat(user_id, ':', k) FROM ev WHERE event_type = 'error')""",
    "realtime_cb": f"WITH {_CANDIDATES} SELECT user_id, item, round(weight, 6) AS weight, rank FROM ranked",
    "realtime_cb_limited": f"""WITH {_CANDIDATES}
        SELECT user_id::VARCHAR AS key, string_agg(item, ',' ORDER BY rank) AS value
        FROM ranked WHERE rank <= 7 GROUP BY user_id""",
    "realtime_als": f"""WITH {_SCORES}, own AS (SELECT * FROM scores), {_OWN_LISTS},
        last AS (SELECT user_id::VARCHAR AS key, arg_max(event_type, event_id) AS kind FROM ev GROUP BY user_id)
        SELECT last.key, CASE WHEN kind <> 'error' THEN value ELSE '0,1,2' END AS value
        FROM last JOIN lists ON lists.key = last.key""",
    "latest_changes": f"WITH {_CHANGES} SELECT sid, type FROM changes",
    "topn_for_subset": f"""WITH {_CHANGES}, {_VECS}, {_TOP} {_TOP_OUT}
        WHERE base IN (SELECT sid FROM changes WHERE type = 'update')""",
    "topn_apply_add": f"WITH {_VECS}, {_TOP} {_TOP_OUT}",
    "topn_apply_delete": f"""WITH {_CHANGES}, {_VECS}, {_TOP},
        gone AS (SELECT sid FROM changes WHERE type = 'delete'),
        kept AS (
          SELECT base, string_agg(format('{{}}:{{:.10f}}', item, sim), ',' ORDER BY rank) AS value
          FROM top WHERE item NOT IN (SELECT sid FROM gone) GROUP BY base)
        SELECT v.id AS base, coalesce(value, '') AS value FROM v LEFT JOIN kept ON kept.base = v.id
        WHERE v.id NOT IN (SELECT sid FROM gone)""",
    "topn_apply_update": f"WITH {_VECS}, {_TOP} {_TOP_OUT}",
    "topn_delete_then_update": f"""WITH {_CHANGES}, {_VECS},
        gone AS (SELECT sid FROM changes WHERE type = 'delete'),
        moved AS (SELECT sid FROM changes WHERE type = 'update'),
        old AS (SELECT id, CASE WHEN id IN (SELECT sid FROM moved) THEN list_reverse(e) ELSE e END AS e FROM v),
        firsts AS (SELECT base, item, sim FROM (
          SELECT a.id AS base, b.id AS item, round(list_cosine_similarity(a.e, b.e), 10) AS sim, row_number() OVER (
            PARTITION BY a.id ORDER BY round(list_cosine_similarity(a.e, b.e), 10) DESC, b.id) AS rank
          FROM old a JOIN old b ON a.id <> b.id) WHERE rank <= 6),
        held AS (SELECT * FROM firsts WHERE base NOT IN (SELECT sid FROM gone) AND item NOT IN (SELECT sid FROM gone)
          AND base NOT IN (SELECT sid FROM moved)),
        limits AS (SELECT base, count(*) AS size, min(sim) AS sim, arg_max(item, (-sim, item)) AS item FROM held GROUP BY base),
        live AS (SELECT * FROM v WHERE id NOT IN (SELECT sid FROM gone)),
        offers AS (SELECT a.id AS base, b.id AS item, round(list_cosine_similarity(a.e, b.e), 10) AS sim
          FROM live a JOIN live b ON a.id <> b.id),
        new AS (SELECT o.* FROM offers o JOIN limits l ON l.base = o.base
          WHERE o.item IN (SELECT sid FROM moved) AND (o.sim > l.sim OR o.sim = l.sim AND o.item <= l.item)),
        kept AS (SELECT base, item, sim FROM held WHERE item NOT IN (SELECT sid FROM moved) UNION ALL SELECT * FROM new),
        short AS (SELECT l.base FROM limits l LEFT JOIN kept k ON k.base = l.base GROUP BY l.base, l.size
          HAVING count(k.item) < l.size),
        rebuild AS (SELECT base FROM short UNION SELECT id FROM live WHERE id IN (SELECT sid FROM moved)),
        ranked AS (
          SELECT base, item, sim, row_number() OVER (PARTITION BY base ORDER BY sim DESC, item) AS rank, size
          FROM (SELECT k.*, l.size FROM kept k JOIN limits l ON l.base = k.base WHERE k.base NOT IN (SELECT base FROM rebuild)
            UNION ALL SELECT *, 6 FROM offers WHERE base IN (SELECT base FROM rebuild)))
        SELECT base, item, sim, CAST(rank AS INTEGER) AS rank FROM ranked WHERE rank <= size""",
    "query_log_tables": f"""WITH {_EVENTS}
        SELECT event_id AS query_id, CASE WHEN event_type = 'click' THEN concat('db', k) ELSE '' END AS database, t AS "table",
          t = '' AS unsupported
        FROM (SELECT event_id, event_type, k, unnest(CASE event_type WHEN 'view' THEN ['part', 'supplier']
          WHEN 'click' THEN ['region'] WHEN 'purchase' THEN ['orders', 'lineitem'] WHEN 'signup' THEN ['supplier']
          ELSE CASE k % 13 WHEN 1 THEN ['part'] WHEN 2 THEN ['lineitem'] WHEN 7 THEN ['part'] WHEN 8 THEN ['part', 'supplier']
            WHEN 9 THEN ['region', 'nation'] WHEN 12 THEN ['supplier'] ELSE [''] END END) AS t FROM ev)""",
    "query_log_columns": f"""WITH {_EVENTS}
        SELECT event_id AS query_id, split_part(c, '.', 1) AS "table", split_part(c, '.', 2) AS "column", c = '' AS unsupported
        FROM (SELECT event_id, unnest(CASE event_type
            WHEN 'view' THEN ['part.p_brand', 'part.p_type', 'supplier.s_name']
            WHEN 'click' THEN ['region.r_regionkey', 'region.r_name']
            WHEN 'purchase' THEN ['orders.o_orderkey', 'lineitem.l_quantity']
            WHEN 'signup' THEN ['supplier.s_name']
            ELSE CASE k % 13 WHEN 1 THEN ['part.p_size'] WHEN 8 THEN ['part.p_name'] WHEN 9 THEN ['region.r_name', 'nation.n_name']
              WHEN 12 THEN ['supplier.s_name'] WHEN 2 THEN ['lineitem.l_quantity', 'lineitem.l_extendedprice']
              WHEN 7 THEN ['part.p_partkey', 'part.p_name', 'part.p_brand', 'part.p_type', 'part.p_size', 'part.p_retailprice']
              ELSE [''] END END) AS c FROM ev)""",
    "als_predict": f"""WITH {_FACTORS}
        SELECT s.user_id, s.item_id, round(rating, 8) AS prediction FROM scores s
        JOIN rated_all r ON r.user_id = s.user_id AND r.item_id = s.item_id""",
    "als_topn_unseen": f"""WITH {_FACTORS}, {_recommended('user_id', 'item_id', 7, """
          item_id IN (SELECT item_id FROM scores) AND NOT EXISTS (
            SELECT 1 FROM scores s WHERE s.user_id = r.user_id AND s.item_id = r.item_id)""")}""",
    "als_items_for_user": f"""WITH {_FACTORS}, {_recommended('user_id', 'item_id', 10, 'user_id = (SELECT min(user_id) FROM scores)')}""",
    "als_users_for_item": f"""WITH {_FACTORS}, {_recommended('item_id', 'user_id', 10, 'item_id = (SELECT min(item_id) FROM scores)')}""",
    "als_users_for_items": f"""WITH {_FACTORS}, {_recommended('item_id', 'user_id', 10, 'true')}""",
    "als_named": f"""WITH {_FACTORS}, b AS (
          SELECT user_id, item_id, rating, row_number() OVER (
            PARTITION BY user_id ORDER BY round(rating, 10) DESC, item_id) AS rank FROM rated_all)
        SELECT user_id, item_id, round(rating, 10) AS rating, CAST(rank AS INTEGER) AS rank, p_name AS name,
          concat(p_name, ',', format('{{:.6f}}', round(rating, 10))) AS label
        FROM b JOIN part ON p_partkey = item_id WHERE rank <= 10""",
    "als_similar_items": f"""WITH {_VECS}
        SELECT base, item, sim, CAST(rank AS INTEGER) AS rank FROM (
          SELECT a.id AS base, b.id AS item, round(list_cosine_similarity(a.e, b.e), 10) AS sim, row_number() OVER (
            PARTITION BY a.id ORDER BY round(list_cosine_similarity(a.e, b.e), 10) DESC, b.id) AS rank
          FROM v a JOIN v b ON a.id <> b.id) WHERE rank <= 10""",
    "topn_adjusted_cosine": f"""WITH {_VECS}, p AS (SELECT a.id AS base, b.id AS item, a.e AS x, b.e AS y FROM v a JOIN v b ON a.id <> b.id),
        s AS (SELECT base, item, round(list_cosine_similarity(
          {_CENTRED.format('x', _MEAN_BOTH)}, {_CENTRED.format('y', _MEAN_BOTH)}), 10) AS sim FROM p)
        SELECT base, item, sim, CAST(rank AS INTEGER) AS rank FROM (
          SELECT *, row_number() OVER (PARTITION BY base ORDER BY sim DESC, item) AS rank FROM s) WHERE rank <= 6""",
    "catalog_ddl": """WITH c AS (
          SELECT l_orderkey, l_linenumber AS position, concat('part_', l_partkey) AS name,
                 CASE l_returnflag WHEN 'A' THEN 'string' WHEN 'N' THEN 'double' ELSE 'bigint' END AS type
          FROM lineitem)
        SELECT concat('order_', l_orderkey) AS "table",
               concat('create table order_', l_orderkey, ' (  ',
                 string_agg(concat(name, '  ', type), ',' ORDER BY position, name, type), '  );') AS ddl
        FROM c GROUP BY l_orderkey""",
}
ORACLE |= {f"{name}_vector": ORACLE[name] for name in ("sim_cosine", "sim_pearson", "sim_adjusted_cosine", "sim_euclidean")}


def _als_rank_two(iterations: int, reg: float) -> str:
    """Alternating least squares with two factors; two by two systems are solved by their determinant."""
    unit = "('0x' || substr(md5('als-42-{}-' || item_id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 / sqrt(2.0)"
    steps = [f"i0 AS (SELECT item_id AS id, {unit.format(0)} AS a, {unit.format(1)} AS b FROM (SELECT DISTINCT item_id FROM scores))"]
    half = """{new} AS (SELECT id, (x * q - y * p) / (o * q - p * p) AS a, (y * o - x * p) / (o * q - p * p) AS b FROM (
      SELECT {mine} AS id, sum(a * a) + {reg} * count(*) AS o, sum(a * b) AS p, sum(b * b) + {reg} * count(*) AS q,
        sum(score * a) AS x, sum(score * b) AS y FROM scores JOIN {old} ON {other} = id GROUP BY {mine}))"""
    for n in range(1, iterations + 1):
        steps.append(half.format(new=f"u{n}", mine="user_id", other="item_id", old=f"i{n - 1}", reg=reg))
        steps.append(half.format(new=f"i{n}", mine="item_id", other="user_id", old=f"u{n}", reg=reg))
    return f"""WITH {_SCORES}, {', '.join(steps)}
        SELECT 'user' AS kind, id, round(a, 6) AS f0, round(b, 6) AS f1 FROM u{iterations}
        UNION ALL SELECT 'item', id, round(a, 6), round(b, 6) FROM i{iterations}"""


ORACLE["als_block_factors"] = _als_rank_two(2, 0.1)


def _lloyd(k: int, steps: int) -> str:
    """Lloyd steps from the items with the least hashes, and what their clusters cost with the last centres."""
    unit = "('0x' || substr(md5('kmeans-42-' || id), 1, 13))::BIGINT"
    parts = [f"""c0 AS (SELECT (row_number() OVER (ORDER BY h, id) - 1)::INTEGER AS c, e FROM (
      SELECT id, e, {unit} AS h FROM v ORDER BY h, id LIMIT {k}))"""]
    near = """n{0} AS (SELECT id, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
      SELECT id, c, list_sum(list_transform(range(1, len(v.e) + 1), lambda i: (v.e[i] - c{0}.e[i]) * (v.e[i] - c{0}.e[i]))) AS d
      FROM v, c{0}) GROUP BY id)"""
    for n in range(steps):
        parts.append(near.format(n))
        parts.append(f"""c{n + 1} AS (SELECT c, list(m ORDER BY i) AS e FROM (
          SELECT c, i, avg(x) AS m FROM (SELECT n{n}.c, unnest(v.e) AS x, unnest(range(len(v.e))) AS i FROM n{n} JOIN v USING (id))
          GROUP BY c, i) GROUP BY c UNION ALL SELECT c, e FROM c{n} WHERE c NOT IN (SELECT c FROM n{n}))""")
    parts.append(near.format(steps))
    return f"WITH {_VECS}, {', '.join(parts)} SELECT c AS cluster, count(*) AS n_items, round(sum(d), 6) AS cost FROM n{steps} GROUP BY c"


ORACLE["kmeans_bounded"] = _lloyd(5, 3)
#: The same rows, found by bounds.
ORACLE |= {f"{name}_bounds": ORACLE[name] for name in ("topn_cosine", "topn_euclidean", "cluster_nearest", "als_topn_unseen")}
ORACLE |= {f"{name}_sweep": ORACLE[name] for name in ("ip_location", "ip_location_count")}
