"""Evaluation views over the input tables as portable SQL, for the checks."""

# Order matters only for readers: each view may use the ones above it.
VIEW_SQL: dict[str, str] = {
    "w_line": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
  ORDER BY l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus) AS rn
  FROM lineitem) t WHERE rn = 1""",
    "w_det_gt": """SELECT l_orderkey AS image_id, l_linenumber AS gt_idx, l_returnflag AS label,
  CAST(l_partkey % 40 AS DOUBLE) AS x1, CAST(l_suppkey % 40 AS DOUBLE) AS y1,
  CAST(l_partkey % 40 AS DOUBLE) + 10 + l_quantity AS x2, CAST(l_suppkey % 40 AS DOUBLE) + 10 + l_quantity AS y2,
  (l_partkey % 11 = 0) AS is_ignored, l_linestatus AS stratum FROM w_line""",
    "w_det_inf": """SELECT image_id, gt_idx * 10 AS inf_idx,
  CASE WHEN (gt_idx + CAST(x1 AS INT)) % 6 = 0
       THEN CASE label WHEN 'A' THEN 'N' WHEN 'N' THEN 'R' ELSE 'A' END ELSE label END AS label,
  x1 + (gt_idx % 4) AS x1, y1 + (gt_idx % 3) AS y1, x2 + (gt_idx % 4) AS x2, y2 + (gt_idx % 3) AS y2,
  CAST((image_id * 31 + gt_idx * 17 + CAST(x1 AS INT) * 7) % 1000 AS DOUBLE) / 1000 AS score, stratum
FROM w_det_gt WHERE (CAST(y1 AS INT) + gt_idx) % 9 <> 0
UNION ALL
SELECT image_id, gt_idx * 10 + 1, label, x1 + 2, y1 + 60, x2 + 2, y2 + 60,
  CAST((image_id * 13 + gt_idx * 29) % 1000 AS DOUBLE) / 1000, stratum
FROM w_det_gt WHERE CAST(x1 AS INT) % 5 = 0""",
    "w_cls": """SELECT l_orderkey AS order_id, l_linenumber AS line, l_returnflag AS gt,
  CASE l_partkey % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'N' WHEN 2 THEN 'R' ELSE l_returnflag END AS pred,
  CAST((l_orderkey * 7 + l_linenumber * 13) % 100 AS DOUBLE) / 100 AS score, l_linestatus AS stratum FROM lineitem""",
    "w_bin": """SELECT l.doc_id, l.quality = 1 AS gt,
  CAST((d.n_chars * 7 + l.quality * 400) % 1000 AS DOUBLE) / 1000 AS score, d.lang AS stratum
FROM labels l JOIN documents d ON l.doc_id = d.doc_id""",
    "w_reg": """SELECT l_orderkey AS order_id, l_linenumber AS line, l_extendedprice AS gt,
  l_extendedprice * 0.9 + l_quantity * 10 - l_discount * 100 AS pred, l_quantity AS weight, l_returnflag AS stratum
FROM lineitem""",
    "w_dp": """SELECT o_orderkey AS id, c_mktsegment AS segment, o_orderpriority AS priority, o_totalprice AS price
FROM orders JOIN customer ON o_custkey = c_custkey""",
    "w_res": """SELECT 'a' AS model, CAST(NULL AS VARCHAR) AS eval_config, id, CAST(id % 97 AS DOUBLE) / 97 AS score,
  id % 3 AS tp, id % 2 AS fp, id % 5 AS fn FROM w_dp
UNION ALL
SELECT 'b', '{"threshold": 0.5}', id, CAST(id % 89 AS DOUBLE) / 89, (id + 1) % 3, (id + 1) % 2, (id + 2) % 5
FROM w_dp WHERE id % 3 <> 0""",
    "w_ver": """SELECT 1 AS version, id, segment, price FROM w_dp WHERE id % 4 <> 0
UNION ALL SELECT 2, id, segment, CASE WHEN id % 10 = 1 THEN price + 1 ELSE price END FROM w_dp WHERE id % 4 <> 1
UNION ALL SELECT 3, id, segment, price FROM w_dp WHERE id % 4 <> 2""",
    "w_txt": """SELECT a.conv_id, a.turn, lower(a.text) AS ref, lower(b.text) AS cand
FROM conversations a JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1""",
    "w_seg": """SELECT 'ref' AS side, user_id AS recording, event_type AS speaker, event_id,
  CAST(event_id % 500 AS DOUBLE) AS s, event_id % 500 + 1 + value / 20 AS e FROM events
UNION ALL
SELECT 'hyp', user_id, CASE WHEN event_id % 7 = 0 THEN 'view' ELSE event_type END, event_id,
  event_id % 500 + CAST(event_id % 3 AS DOUBLE) / 4, event_id % 500 + 1 + value / 20 + CAST(event_id % 4 AS DOUBLE) / 4
FROM events WHERE event_id % 11 <> 0""",
    "w_pix": """SELECT e.vec_id AS image_id, u.pos AS pos, CAST(u.v AS DOUBLE) AS v, CAST(n.embedding[u.pos + 1] AS DOUBLE) AS v_next
FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings) u
JOIN embeddings e ON e.vec_id = u.vec_id LEFT JOIN embeddings n ON n.vec_id = e.vec_id + 1""",
    "w_mask": """SELECT image_id, pos, v > 0 AS gt, least(1.0, greatest(0.0, 0.5 + 2 * v_next)) AS prob,
  least(255.0, greatest(0.0, 128 + 512 * v)) AS intensity FROM w_pix""",
    "w_pair": """SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS is_match,
  list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))
  / sqrt(list_dot_product(CAST(a.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[]))
       * list_dot_product(CAST(b.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[]))) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id > a.vec_id AND b.vec_id <= a.vec_id + 20""",
    "w_sim": """SELECT q.vec_id AS query_id, c.vec_id AS item_id, q.label = c.label AS relevant,
  list_dot_product(CAST(q.embedding AS DOUBLE[]), CAST(c.embedding AS DOUBLE[])) AS sim
FROM embeddings q JOIN embeddings c ON q.vec_id <> c.vec_id""",
}
