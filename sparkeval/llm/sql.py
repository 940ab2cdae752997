"""SQL text shared by the checks of several queries."""

from sparkeval.llm import license_scan

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def words(table: str, key: str) -> str:
    """Rows (key, w): the words of each text as a list."""
    return f"SELECT {key}, regexp_extract_all({LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM {table}"


def shingles(words_cte: str, key: str, width: int) -> str:
    """Rows (key, s): the distinct runs of ``width`` words; a shorter text is one shingle."""
    return f"""
    SELECT DISTINCT {key}, s FROM (
      SELECT {key}, unnest([array_to_string(w[i : i + {width - 1}], ' ') for i in range(1, greatest(len(w) - {width - 1}, 1) + 1)]) AS s
      FROM {words_cte} WHERE len(w) > 0)"""


LEAKS = f"""
WITH dw AS ({words('documents', 'doc_id')}), iw AS ({words('benchmark', 'item_id')}),
d AS ({shingles('dw', 'doc_id', 5)}), i AS ({shingles('iw', 'item_id', 5)}),
n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY item_id),
shared AS (SELECT doc_id, item_id, count(*) AS n_shared FROM d JOIN i USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment FROM shared JOIN n USING (item_id) WHERE 5 * n_shared >= 4 * n_item
"""

NEAR_DUPLICATES = f"""
WITH RECURSIVE dw AS ({words('documents', 'doc_id')}),
s AS MATERIALIZED (SELECT doc_id, hash(s) AS s FROM ({shingles('dw', 'doc_id', 2)})),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
df AS (SELECT s, count(*) AS df FROM s GROUP BY s),
r AS MATERIALIZED (SELECT doc_id, s, n, row_number() OVER (PARTITION BY doc_id ORDER BY df, s) AS k FROM s JOIN df USING (s) JOIN n USING (doc_id)),
p AS MATERIALIZED (SELECT doc_id, s, n FROM r WHERE k <= n - ceil(0.8 * n) + 1),
c AS MATERIALIZED (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb FROM p a JOIN p b ON a.s = b.s AND a.doc_id < b.doc_id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
e AS MATERIALIZED (SELECT a, b FROM c JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.s = x.s GROUP BY a, b, na, nb HAVING 100 * count(*) >= 80 * (na + nb - count(*))),
g AS MATERIALIZED (SELECT a, b FROM e UNION SELECT b, a FROM e),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, g.b FROM reach JOIN g ON g.a = reach.b),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN comp USING (doc_id) LEFT JOIN n ON n.doc_id = d.doc_id
"""

LINES = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS place FROM documents WHERE text IS NOT NULL),
w AS (SELECT doc_id, place, line, list_distinct(regexp_extract_all(lower(line), '[^\\x20\\x09-\\x0D]+')) AS w FROM l),
f AS MATERIALIZED (SELECT w, min((doc_id, place)) AS first, row_number() OVER (ORDER BY min((doc_id, place))) AS id FROM (SELECT list_sort(w) AS w, doc_id, place FROM w WHERE len(w) > 0) GROUP BY w),
t AS MATERIALIZED (SELECT id, len(w) AS n, unnest(w) AS t FROM f),
df AS (SELECT t, count(*) AS df FROM t GROUP BY t),
r AS (SELECT id, n, t, row_number() OVER (PARTITION BY id ORDER BY df, t) AS k FROM t JOIN df USING (t)),
p AS MATERIALIZED (SELECT id, n, t FROM r WHERE k <= n - (4 * n + 4) // 5 + 1),
c AS (SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b ON a.t = b.t AND a.id < b.id AND 5 * least(a.n, b.n) >= 4 * greatest(a.n, b.n)),
gone AS (SELECT DISTINCT c.b AS id FROM c JOIN f x ON x.id = c.a JOIN f y ON y.id = c.b
  WHERE 5 * len(list_intersect(x.w, y.w)) >= 4 * (len(x.w) + len(y.w) - len(list_intersect(x.w, y.w)))),
kept AS (SELECT first[1] AS doc_id, first[2] AS place FROM f WHERE id NOT IN (SELECT id FROM gone)),
marked AS (SELECT w.doc_id, w.place, line, len(w) > 0 AS worded, kept.place IS NOT NULL AS kept FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id AND kept.place = w.place)
SELECT d.doc_id, count(*) FILTER (worded) AS n_lines, count(*) FILTER (worded AND NOT kept) AS n_removed,
  CASE WHEN any_value(d.text) IS NOT NULL THEN coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (kept OR NOT worded), '') END AS text
FROM documents d LEFT JOIN marked m ON m.doc_id = d.doc_id GROUP BY d.doc_id
"""

INFILL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS w, sha256('1:' || doc_id) AS h FROM documents),
c AS (SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t),
p AS (
  SELECT doc_id, text, n, array_to_string(w[1 : least(h1 % (n + 1), h2 % (n + 1))], '') AS prefix,
    array_to_string(w[least(h1 % (n + 1), h2 % (n + 1)) + 1 : greatest(h1 % (n + 1), h2 % (n + 1))], '') AS middle,
    array_to_string(w[greatest(h1 % (n + 1), h2 % (n + 1)) + 1 :], '') AS suffix,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM c)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM p
"""

VARIANTS = """
WITH RECURSIVE table_ AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_prepend(x, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps),
r AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{C0}-\\x{FF}]+')) AS run
  FROM documents),
b AS (SELECT run, hex(encode(id || ':' || run)) AS bytes FROM r WHERE length(run) >= 5),
h AS (
  SELECT run, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(bytes) // 2), lambda i: ('0x' || bytes[2 * i + 1 : 2 * i + 2])::BIGINT)),
    lambda c, x: xor(c >> 8, steps[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM b, table_),
o AS (SELECT CASE WHEN h % 97 = 0 THEN substring(run, 1, (h % length(run))::BIGINT) || substring(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM h),
w AS MATERIALIZED (SELECT word, count(*) AS n FROM o WHERE length(word) >= 5 GROUP BY word HAVING count(*) >= 3),
cut AS MATERIALIZED (SELECT word, n, i, substring(word, 1, i - 1) || substring(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS MATERIALIZED (
  SELECT DISTINCT a.word, a.n, b.word AS other, b.n AS m FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT a.word, a.n, w.word, w.n FROM cut a JOIN w ON w.word = a.rest
  UNION SELECT w.word, w.n, a.word, a.n FROM cut a JOIN w ON w.word = a.rest),
best AS (SELECT word, count(*) AS n_near, min((-m, other)) AS best FROM near GROUP BY word),
f AS MATERIALIZED (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best[1] >= 2 * n THEN best[2] END AS form, CASE WHEN -best[1] >= 2 * n THEN -best[1] END AS form_n FROM w LEFT JOIN best USING (word)),
chain AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT chain.word, f.word, f.form FROM chain JOIN f ON f.word = chain.next)
SELECT word, form, root, n, n_near, form_n FROM f JOIN (SELECT word, root FROM chain WHERE next IS NULL) USING (word)
"""


def licenses(phrases: tuple, templates: tuple, percent: int) -> str:
    """Phrases word for word, and templates by counting the distinct words of every block that starts at one of them."""
    p = ", ".join(f"('{label}', {notice.split()})" for label, notice in phrases)
    t = ", ".join(f"({i}, '{label}', {notice.split()}, {license_scan.block_width(notice)}, {license_scan.needed(notice, percent)})" for i, (label, notice) in enumerate(templates))
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
pos AS MATERIALIZED (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
phrase(label, words) AS (VALUES {p}),
base AS (SELECT pos.doc_id, label, i - 1 AS place FROM pos JOIN phrase ON words[1] = word JOIN d USING (doc_id) WHERE w[i : i + len(words) - 1] = words),
template(id, label, words, width, need) AS (VALUES {t}),
tw AS (SELECT DISTINCT id, unnest(words) AS word FROM template),
hit AS MATERIALIZED (SELECT doc_id, id, i, word FROM pos JOIN tw USING (word)),
many AS (SELECT doc_id, id FROM hit JOIN template USING (id) GROUP BY doc_id, id, need HAVING count(DISTINCT word) >= need),
run AS (
  SELECT a.doc_id, a.id, a.i, count(DISTINCT b.word) AS k FROM (SELECT hit.* FROM hit JOIN many USING (doc_id, id)) a JOIN template USING (id)
  JOIN hit b ON b.doc_id = a.doc_id AND b.id = a.id AND b.i BETWEEN a.i AND a.i + width - 1 GROUP BY a.doc_id, a.id, a.i),
found AS (
  SELECT doc_id, label, NULL AS place, k / len(list_distinct(words)) AS score FROM run JOIN template USING (id) WHERE k >= need
  UNION ALL SELECT doc_id, label, place, 1.0 FROM base),
per AS (
  SELECT doc_id, count(place) AS n_base, min(place) AS first_word, max(place) AS last_word, max(score) AS score,
    array_to_string(list_sort(list(DISTINCT label) FILTER (place IS NOT NULL)), ',') AS base_labels, array_to_string(list_sort(list(DISTINCT label)), ',') AS labels
  FROM found GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels, coalesce(score, 0.0)::DOUBLE AS score
FROM d LEFT JOIN per USING (doc_id)
"""


LICENSES = licenses(license_scan.PHRASES, license_scan.TEMPLATES, license_scan.PERCENT)
