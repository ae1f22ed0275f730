"""DuckDB SQL for the registered queries, written independently of the operators.

Tokens are made here by splitting and stripping word by word, PageRank by the
jump-and-missing-mass formula, and retrieval by set operations.
"""

from __future__ import annotations

from .functions.numeric import RATE_EDGES
from .operators.evaluation import PARTS, POISSON_1, poisson_steps
from .operators.linear_classifier import ERROR, MAX_DOCS
from .workload import SHARD_DOCS

STRIP = "regexp_extract(lower(w), '(?s)[a-z](.*[a-z])?')"
RAW = r"list_filter(regexp_split_to_array(text, '[ \t\n\r\f]+'), lambda w: w <> '')"


def _stripped(words: str) -> str:
    return f"list_filter(list_transform({words}, lambda w: {STRIP}), lambda w: w <> '')"


LINES = """lines AS (
  SELECT doc_id AS docno, unnest(l) AS text, unnest(range(len(l))) AS line_no
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""
WORDS = f"words AS (SELECT doc_id, unnest({_stripped(RAW)}) AS w FROM documents)"
PREFIXES = """prefixes AS (
  SELECT substr(w, 1, 2) AS prefix, count(*) AS n FROM words WHERE length(w) >= 2 GROUP BY 1)"""


def _line_words(words: str) -> str:
    return f"""{LINES}, line_words AS (
  SELECT docno, line_no, unnest(list_distinct({words})) AS w
  FROM (SELECT docno, line_no, {RAW} AS r FROM lines)),
df AS (SELECT w, count(*) AS n FROM line_words GROUP BY w)"""


def _both(words: str) -> str:
    return f"""{_line_words(words)}, half AS (
  SELECT a.w AS x, b.w AS y, count(*) AS n
  FROM line_words a JOIN line_words b ON a.docno = b.docno AND a.line_no = b.line_no AND a.w < b.w
  GROUP BY ALL), both_orders AS (
  SELECT x, y, n FROM half UNION ALL SELECT y, x, n FROM half)"""


def _pmi(words: str) -> str:
    return f"""{_both(words)}, pmi AS (
  SELECT p.x, p.y, p.n, (SELECT count(*) FROM lines)::DOUBLE * p.n / (dx.n::DOUBLE * dy.n::DOUBLE) AS lift
  FROM both_orders p JOIN df dx ON dx.w = p.x JOIN df dy ON dy.w = p.y WHERE p.n >= 10)"""


WHOLE = _stripped("r")
FIRST_100 = f"list_concat({_stripped('r[1:99]')}, {_stripped('r[100:]')}[1:1])"
PMI = _pmi(WHOLE)
PMI_ROWS = "SELECT x, y, n, round(log10(lift), 9) AS pmi FROM pmi"


def _bigram(tag: str, least: int) -> str:
    return f"""t{tag} AS (SELECT t FROM (SELECT {_stripped(RAW)} AS t FROM lines) WHERE len(t) >= {least}),
  c{tag} AS (SELECT a, b, count(*) AS n FROM (
      SELECT unnest(t[1:len(t)-1]) AS a, unnest(t[2:len(t)]) AS b FROM t{tag}) GROUP BY ALL),
  m{tag} AS (SELECT a, sum(n)::BIGINT AS total FROM c{tag} GROUP BY a),
  f{tag} AS (SELECT a, b, n::DOUBLE / total AS f FROM c{tag} JOIN m{tag} USING (a))"""


POSTINGS = f"""postings AS (
  SELECT w AS term, doc_id AS docno, count(*)::INTEGER AS tf FROM words GROUP BY ALL)"""
INDEX = f"{WORDS}, {POSTINGS}"


def _has(term: str) -> str:
    return f"SELECT docno FROM postings WHERE term = '{term}'"


NESTED = f"(({_has('the')}) INTERSECT ({_has('of')})) UNION ({_has('de')})"
GRAPH = """goods AS (
  SELECT s_suppkey * 4 AS id FROM supplier UNION ALL SELECT p_partkey * 4 + 1 FROM part),
nodes AS (SELECT id FROM goods UNION ALL SELECT n_nationkey::BIGINT * 4 + 2 FROM nation),
edges AS (
  SELECT l_suppkey * 4 AS src, l_partkey * 4 + 1 AS dst FROM lineitem
  UNION ALL SELECT l_partkey * 4 + 1, l_suppkey * 4 FROM lineitem WHERE l_returnflag = 'R'
  UNION ALL SELECT s_suppkey * 4, s_nationkey::BIGINT * 4 + 2 FROM supplier)"""


def _ranks(sources: tuple[int, ...], iterations: int) -> str:
    """Personalized PageRank unrolled: push, sum, then jump and missing mass."""
    values = ", ".join(f"({s})" for s in sources)
    parts = [GRAPH, f"sources AS (SELECT * FROM (VALUES {values}) v(source))", """
outdeg AS (SELECT src, count(*) AS d FROM edges GROUP BY src),
r0 AS (SELECT source, id, CASE WHEN id = source THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS p
       FROM nodes, sources)"""]
    for i in range(iterations):
        parts.append(f"""
m{i} AS MATERIALIZED (
  SELECT s.source, s.id, coalesce(sum(r.p / d), 0.0) AS m
  FROM r0 s LEFT JOIN edges e ON e.dst = s.id LEFT JOIN outdeg o ON o.src = e.src
  LEFT JOIN r{i} r ON r.id = e.src AND r.source = s.source GROUP BY s.source, s.id),
lost{i} AS (SELECT source, 1.0 - sum(m) AS missing FROM m{i} GROUP BY source),
r{i + 1} AS MATERIALIZED (
  SELECT source, id, CASE WHEN id = source THEN 0.15 + 0.85 * (m + missing) ELSE 0.85 * m END AS p
  FROM m{i} JOIN lost{i} USING (source))""")
    return ",".join(parts)


LABELLED = f"""labelled AS (
  SELECT doc_id, CASE WHEN quality = 0 THEN 'spam' ELSE 'ham' END AS label,
    CASE WHEN quality = 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS y, lang AS model_id, {_stripped(RAW)} AS features
  FROM documents JOIN labels USING (doc_id)),
occ AS (
  SELECT model_id, doc_id, y, feature, count(*) AS k
  FROM (SELECT model_id, doc_id, y, unnest(features) AS feature FROM labelled) GROUP BY ALL)"""
EPOCH_1 = f"""{LABELLED}, w1 AS (
  SELECT model_id, feature, sum(0.002::DOUBLE * k * (y - 0.5)) AS weight FROM occ GROUP BY ALL)"""
EVERY = f"""everyone AS (
  SELECT doc_id, CASE quality WHEN 0 THEN 'spam' WHEN 1 THEN 'ham' END AS label, {_stripped(RAW)} AS features
  FROM documents LEFT JOIN labels USING (doc_id)),
seen AS (
  SELECT doc_id, feature, count(*) AS k FROM (SELECT doc_id, unnest(features) AS feature FROM everyone) GROUP BY ALL)"""
ONE_SCORE = f"""{LABELLED}, {EVERY}, w AS (
  SELECT feature, sum(0.002::DOUBLE * k * (y - 0.5)) AS weight FROM occ GROUP BY ALL),
scored AS (
  SELECT doc_id, label, coalesce(sum(k * weight), 0.0) AS score, coalesce(sum(abs(k * weight)), 0.0) AS size
  FROM everyone LEFT JOIN seen USING (doc_id) LEFT JOIN w USING (feature) GROUP BY ALL)"""
COMPARABLE = "printf('%.11e', score)::DOUBLE AS score"


def _sign(score: str = "score", size: str = "size") -> str:
    """A score is 0 within the float error of its terms' sum."""
    return f"CASE WHEN abs({score}) <= {ERROR!r}::DOUBLE * {size} THEN 0 ELSE sign({score})::INTEGER END"


def _label(sign: str) -> str:
    return f"CASE WHEN {sign} > 0 THEN 'spam' ELSE 'ham' END AS pred"


def _sequence(sequences: str) -> str:
    """Sequential training: a step of the recursion takes the next document of every sequence.

    ``sequences`` has (seq, nth, doc_id, y), nth from 1.  The row (-1, '') counts the steps.
    """
    return f"""{LABELLED}, seqs AS ({sequences}),
step_features AS (
  SELECT seq, nth, feature, y, k FROM seqs
  JOIN (SELECT doc_id, feature, sum(k) AS k FROM occ GROUP BY ALL) USING (doc_id)),
trained(seq, feature, weight, nth) USING KEY (seq, feature) AS (
  SELECT -1::BIGINT, ''::VARCHAR, 0.0::DOUBLE, 0::BIGINT
  UNION
  SELECT * FROM (
    WITH now AS (SELECT max(nth) + 1 AS nth FROM trained),
    doc AS (
      SELECT f.seq, f.feature, f.y, f.k, coalesce(r.weight, 0.0) AS weight, f.nth
      FROM step_features f JOIN now USING (nth)
      LEFT JOIN recurring.trained r ON r.seq = f.seq AND r.feature = f.feature),
    p AS (SELECT seq, 1.0 / (1.0 + exp(-sum(k * weight))) AS p FROM doc GROUP BY seq)
    SELECT seq, feature, weight + 0.002::DOUBLE * k * (y - p), nth FROM doc JOIN p USING (seq)
    UNION ALL SELECT -1, '', 0.0, nth FROM now WHERE nth <= (SELECT max(nth) FROM seqs))),
weights AS (SELECT seq, feature, weight FROM trained WHERE seq >= 0)"""
LENGTH = """preds AS (
  SELECT doc_id, lang, CASE WHEN quality = 0 THEN 'spam' ELSE 'ham' END AS label,
    floor((1000 - n_chars) / 50.0::DOUBLE) AS score,
    CASE WHEN floor((1000 - n_chars) / 50.0::DOUBLE) > 0 THEN 'spam' ELSE 'ham' END AS pred
  FROM documents JOIN labels USING (doc_id))"""


def _roca(preds: str, by: str = "") -> str:
    """All spam and ham pairs compared, per distinct score."""
    keys, using = (f"{by}, ", f"h.{by} = s.{by}") if by else ("", "true")
    return f"""per_score AS (
  SELECT {keys}score, count(*) FILTER (label = 'spam') AS s, count(*) FILTER (label = 'ham') AS h
  FROM {preds} WHERE label IS NOT NULL GROUP BY ALL),
totals AS (SELECT {keys}sum(h)::BIGINT AS hams, sum(s)::BIGINT AS spams FROM per_score GROUP BY ALL),
wrong AS (
  SELECT {'h.' + keys if by else ''}sum(h.h * s.s * CASE WHEN s.score < h.score THEN 1.0
      WHEN s.score = h.score THEN 0.5 ELSE 0.0 END::DOUBLE) AS inv
  FROM per_score h JOIN per_score s ON {using} GROUP BY ALL)
SELECT {keys}hams, spams, round(100.0 * CASE WHEN inv = 0 THEN 0.5 ELSE inv END
    / nullif(hams::DOUBLE * spams, 0), DIGITS) AS one_minus_roca
FROM totals {f'JOIN wrong USING ({by})' if by else ', wrong'}"""


SHIPPED = "l_shipdate >= DATE '1998-03-01' AND l_shipdate < DATE '1998-04-01'"
SHIPPED_15 = "l_shipdate >= DATE '1998-03-15' AND l_shipdate < DATE '1998-03-16'"
MONTHLY = """monthly AS (
  SELECT strftime(l_shipdate, '%Y-%m') AS month, n_name AS nation, count(*) AS n
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey WHERE c_nationkey IN (3, 24) GROUP BY ALL)"""

_T3, _T2 = _bigram("3", 3), _bigram("2", 2)
_EDGES = str(list(RATE_EDGES)) + "::DOUBLE[]"
_RATE_BUCKET = f"least(len(list_filter({_EDGES}, lambda e: e < {{r}})), {len(RATE_EDGES) - 1})::INTEGER"
_DRAWS = str([repr(c) for c in POISSON_1]).replace("'", "") + "::DOUBLE[]"
_TABLES = " ".join(f"WHEN {bit} THEN {poisson_steps(1 << bit)!r}" for bit in range(PARTS + 1))
_DRAWN = f"""alike AS (SELECT score, label, pred, count(*) AS n FROM preds GROUP BY ALL),
parts AS (
  SELECT score, label, pred, range AS bit, 0 AS nth FROM alike, range({PARTS}) WHERE (n >> range) & 1 = 1
  UNION ALL SELECT score, label, pred, {PARTS}, unnest(range(1, n // {1 << PARTS} + 1)) FROM alike),
tables AS (SELECT range AS bit, CASE range {_TABLES} END AS steps FROM range({PARTS + 1})),
keyed AS (
  SELECT range AS rep, score, label, pred, bit, ('0x' || md5(concat_ws(':', score::VARCHAR, (label = 'spam')::VARCHAR,
    (label <> pred)::VARCHAR, range::VARCHAR, '0', bit::VARCHAR, nth::VARCHAR))[1:13])::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
  FROM parts, range(100)),
drawn AS (SELECT rep, score, label, pred, len(list_filter(steps, lambda c: c <= u)) AS n FROM keyed JOIN tables USING (bit)),
per_score AS (
  SELECT rep, score, coalesce(sum(n) FILTER (label = 'spam'), 0) AS s, coalesce(sum(n) FILTER (label = 'ham'), 0) AS h,
    coalesce(sum(n) FILTER (label = 'spam' AND pred = 'ham'), 0) AS fn,
    coalesce(sum(n) FILTER (label = 'ham' AND pred = 'spam'), 0) AS fp
  FROM drawn WHERE n > 0 GROUP BY ALL)"""


def _revenue(ordered: str, shipped: str) -> str:
    return f"""SELECT c_name, o_orderkey, round(sum(l_extendedprice * (1 - l_discount)), 4) AS revenue,
  o_orderdate, o_orderpriority
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
WHERE o_orderdate < DATE '{ordered}' AND l_shipdate >= DATE '{shipped}'
GROUP BY c_name, o_orderkey, o_orderdate, o_orderpriority ORDER BY revenue DESC, o_orderkey LIMIT 10"""


_Q3 = f"""SELECT l_orderkey, p_name, s_name FROM lineitem
JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
WHERE {SHIPPED_15} ORDER BY l_orderkey, p_name, s_name LIMIT 20"""
_VOTE = f"""WITH {EPOCH_1}, {EVERY}, spine AS (
  SELECT doc_id, label, m.model_id FROM everyone, (SELECT DISTINCT model_id FROM w1) m),
scored AS (
  SELECT s.doc_id, label, s.model_id, coalesce(sum(k * weight), 0.0) AS score, coalesce(sum(abs(k * weight)), 0.0) AS size
  FROM spine s LEFT JOIN seen o ON o.doc_id = s.doc_id
  LEFT JOIN w1 m ON m.feature = o.feature AND m.model_id = s.model_id GROUP BY ALL),
votes AS (SELECT doc_id, label, sum({_sign()})::BIGINT AS score FROM scored GROUP BY doc_id, label)
SELECT doc_id, label, score, {_label('score')} FROM votes"""
_SHARDS = f"(SELECT greatest(1, (count(*) + {SHARD_DOCS - 1}) // {SHARD_DOCS}) FROM labelled)"
_SHARD = f"(('0x' || md5(doc_id::VARCHAR)[1:15])::BIGINT % {_SHARDS})"
_RUNS = f"""SELECT range AS seq, doc_id, y, row_number() OVER (PARTITION BY range
  ORDER BY md5(doc_id::VARCHAR || ':' || range::VARCHAR), doc_id) AS nth
  FROM (SELECT *, row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) AS place FROM labelled QUALIFY place <= {MAX_DOCS}), range(10)"""
_MODEL_NUMBERS = "models AS (SELECT model_id, row_number() OVER (ORDER BY model_id) AS seq FROM (SELECT DISTINCT model_id FROM labelled))"

_LAM = f"""WITH {LENGTH}, c AS (
  SELECT count(*) FILTER (label = 'ham') AS hams, count(*) FILTER (label = 'spam') AS spams,
    count(*) FILTER (label = 'ham' AND pred = 'spam') AS fp,
    count(*) FILTER (label = 'spam' AND pred = 'ham') AS fn FROM preds),
r AS (SELECT *, CASE WHEN fp = 0 THEN 0.5 WHEN fp = hams THEN hams - 0.5 ELSE fp END::DOUBLE / hams AS a,
  CASE WHEN fn = 0 THEN 0.5 WHEN fn = spams THEN spams - 0.5 ELSE fn END::DOUBLE / spams AS b FROM c)
SELECT hams, spams, fp, fn,
  round(100.0 / (1.0 + exp(-(ln(a / (1 - a)) + ln(b / (1 - b))) / 2)), 9) AS lam FROM r"""

ORACLES: dict[str, str] = {
    "q1_ship_count": f"SELECT count(*) AS n FROM lineitem WHERE {SHIPPED}",
    "q1_ship_count_year": "SELECT count(*) AS n FROM lineitem WHERE year(l_shipdate) = 1998",
    "q1_ship_count_day": f"SELECT count(*) AS n FROM lineitem WHERE {SHIPPED_15}",
    "q2_orders_shipped": f"""SELECT o_orderpriority, o_orderkey FROM orders
WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE {SHIPPED}) ORDER BY o_orderkey LIMIT 20""",
    "q3_part_supplier": _Q3,
    "q3_delimited": _Q3,
    "q4_orders_by_nation": f"""SELECT n_nationkey, n_name, count(DISTINCT o_orderkey) AS n FROM lineitem
JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey WHERE {SHIPPED} GROUP BY ALL ORDER BY n_nationkey""",
    "q5_monthly_shipments": f"WITH {MONTHLY} SELECT month, n, nation FROM monthly ORDER BY month, nation",
    "q5_relabelled": f"""WITH {MONTHLY} SELECT month, n,
  CASE nation WHEN 'NATION_3' THEN 'CANADA' ELSE 'UNITED STATES' END AS nation
FROM monthly ORDER BY month, nation""",
    "q5_pivot": f"""WITH {MONTHLY} SELECT month,
  coalesce(sum(n) FILTER (nation = 'NATION_3'), 0)::BIGINT AS "NATION_3",
  coalesce(sum(n) FILTER (nation = 'NATION_24'), 0)::BIGINT AS "NATION_24"
FROM monthly GROUP BY month ORDER BY month""",
    "q6_pricing": f"""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty,
  round(sum(l_extendedprice), 2) AS sum_base_price,
  round(sum(l_extendedprice * (1 - l_discount)), 4) AS sum_disc_price,
  round(sum(l_extendedprice * (1 - l_discount) * (1 + l_tax)), 2) AS sum_charge,
  round(avg(l_quantity), 6) AS avg_qty, round(avg(l_extendedprice), 6) AS avg_price,
  round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
FROM lineitem WHERE {SHIPPED} GROUP BY ALL""",
    "q7_top_revenue": _revenue("1998-03-15", "1998-03-16"),
    "q7_top_revenue_month": _revenue("1998-03-01", "1998-03-01"),
    "word_count": f"WITH {WORDS} SELECT w, count(*) AS n FROM words GROUP BY w",
    "prefix_count": f"WITH {WORDS}, {PREFIXES} SELECT * FROM prefixes",
    "prefix_lookup": f"WITH {WORDS}, {PREFIXES} SELECT * FROM prefixes WHERE prefix = 'li'",
    "top_prefixes": f"WITH {WORDS}, {PREFIXES} SELECT * FROM prefixes ORDER BY n DESC, prefix LIMIT 3",
    "line_df": f"WITH {_line_words(WHOLE)} SELECT w, n FROM df",
    "line_df_first100": f"WITH {_line_words(FIRST_100)} SELECT w, n FROM df",
    "line_lengths": f"WITH {LINES} SELECT length(text)::INTEGER AS chars, count(*) AS n FROM lines GROUP BY ALL",
    "line_numbers": f"""WITH {LINES} SELECT count(*) AS n, count(*) AS numbers, 0::BIGINT AS first,
  count(*) - 1 AS last FROM lines""",
    "line_count": f"WITH {LINES} SELECT count(*) AS n FROM lines",
    "map_sum": f"""SELECT source, neighbour, count(*) AS total
FROM (SELECT source, unnest({_stripped(RAW)}) AS neighbour FROM documents) GROUP BY ALL""",
    "bigram_pairs": f"""WITH {LINES}, {_T3}
SELECT a, b, f FROM f3 UNION ALL SELECT a, '*', total::DOUBLE FROM m3""",
    "bigram_stripes": f"WITH {LINES}, {_T2} SELECT a, b, f FROM f2",
    "bigram_reconcile": f"""WITH {LINES}, {_T3}, {_T2},
pairs AS (SELECT a, b, f FROM f3 UNION ALL SELECT a, '*', total::DOUBLE FROM m3),
compared AS (SELECT coalesce(p.a, s.a) AS a, coalesce(p.b, s.b) AS b, p.f AS value_a, s.f AS value_b,
  CASE WHEN s.a IS NULL THEN 'missing' WHEN p.a IS NULL THEN 'extra'
    WHEN floor(p.f * 100.0::DOUBLE) <> floor(s.f * 100.0::DOUBLE) THEN 'mismatch' END AS status
  FROM pairs p FULL JOIN f2 s ON p.a = s.a AND p.b = s.b)
SELECT * FROM compared WHERE status IS NOT NULL""",
    "cooccur": f"WITH {_both(WHOLE)} SELECT x, y, n FROM both_orders WHERE n >= 5",
    "pmi_pairs": f"WITH {PMI} {PMI_ROWS}",
    "pmi_pairs_first100": f"WITH {_pmi(FIRST_100)} {PMI_ROWS}",
    "pmi_stripes": f"WITH {PMI} SELECT x, y, round(log10(lift), 9) AS pmi FROM pmi",
    "pmi_top": f"WITH {PMI} {PMI_ROWS} WHERE x < y ORDER BY lift DESC, x, y LIMIT 10",
    "pmi_neighbors": f"WITH {PMI} {PMI_ROWS} WHERE x = 'the' ORDER BY lift DESC, y LIMIT 20",
    "pmi_neighbors_right": f"WITH {PMI} {PMI_ROWS} WHERE y = 'of' ORDER BY lift DESC, x LIMIT 20",
    "pair_stats": f"""WITH {PMI} SELECT count(*) AS ordered_pairs,
  count(*) FILTER (x < y) AS unordered_pairs FROM pmi""",
    "pmi_reconcile": f"""WITH {PMI} SELECT x, y, log10(lift) AS value_a, log10(lift) AS value_b,
  'mismatch' AS status FROM pmi WHERE false""",
    "pmi_reconcile_first100": f"""WITH a AS (WITH {PMI} {PMI_ROWS}), b AS (WITH {_pmi(FIRST_100)} {PMI_ROWS}),
compared AS (
  SELECT coalesce(a.x, b.x) AS x, coalesce(a.y, b.y) AS y, a.pmi AS value_a, b.pmi AS value_b,
    CASE WHEN b.x IS NULL THEN 'missing' WHEN a.x IS NULL THEN 'extra'
      WHEN floor(a.pmi * 100.0::DOUBLE) <> floor(b.pmi * 100.0::DOUBLE) THEN 'mismatch' END AS status
  FROM a FULL JOIN b ON a.x = b.x AND a.y = b.y)
SELECT * FROM compared WHERE status IS NOT NULL""",
    "term_freq": f"WITH {INDEX} SELECT * FROM postings",
    "postings": f"""WITH {INDEX} SELECT term, count(*) OVER (PARTITION BY term) AS df,
  docno // 256 AS block, docno, tf FROM postings""",
    "posting_gaps": f"""WITH {INDEX} SELECT term, docno // 256 AS block,
  (row_number() OVER (PARTITION BY term, docno // 256 ORDER BY docno))::INTEGER AS pos,
  docno - lag(docno, 1, 0) OVER (PARTITION BY term ORDER BY docno) AS gap, tf FROM postings""",
    "posting_gaps_decoded": f"WITH {INDEX} SELECT term, docno, tf FROM postings",
    "index_build": f"WITH {INDEX} SELECT term, count(*) AS df FROM postings GROUP BY term",
    "index_build_postings": f"WITH {INDEX} SELECT term, count(*) AS df FROM postings GROUP BY term",
    "index_table": f"""WITH {INDEX}, listed AS (SELECT term FROM postings
  UNION ALL SELECT unnest(list_distinct({_stripped(RAW)})) FROM benchmark)
SELECT 1 AS version, term, count(*) AS df FROM postings GROUP BY term
UNION ALL SELECT 2, term, count(*) FROM listed GROUP BY term""",
    "bool_flat": f"WITH {INDEX} SELECT docno FROM ({NESTED})",
    "bool_term": f"WITH {INDEX} {_has('the')}",
    "bool_and": f"WITH {INDEX} ({_has('the')}) INTERSECT ({_has('of')})",
    "bool_or": f"WITH {INDEX} ({_has('the')}) UNION ({_has('de')})",
    "bool_nested": f"WITH {INDEX} SELECT docno FROM ({NESTED})",
    "bool_batch": f"""WITH {INDEX}
SELECT 'nested' AS query_id, docno FROM ({NESTED})
UNION ALL SELECT 'narrow', docno FROM
  (({_has('the')}) INTERSECT ({_has('and')}) INTERSECT ({_has('de')}))
UNION ALL SELECT 'wide', docno FROM (({_has('les')}) UNION ({_has('un')}) UNION ({_has('der')}))
UNION ALL SELECT 'upper', docno FROM ({_has('the')})
UNION ALL SELECT 'extra', docno FROM ({_has('de')})""",
    "bool_batch_passages": f"""WITH {INDEX}, wanted AS (
  SELECT DISTINCT item_id AS query_id, unnest({_stripped(RAW)}) AS term FROM benchmark),
needed AS (SELECT query_id, count(*) AS terms FROM wanted GROUP BY query_id)
SELECT query_id, docno FROM wanted JOIN postings USING (term) JOIN needed USING (query_id)
GROUP BY query_id, docno, terms HAVING count(*) = terms""",
    "bool_fetch": f"""WITH {INDEX} SELECT docno::VARCHAR || chr(9)
  || CASE WHEN length(text) > 80 THEN substr(text, 1, 80) || '...' ELSE text END AS line
FROM documents JOIN ({NESTED}) hits ON docno = doc_id""",
    "bool_fetch_whole": f"""WITH {INDEX} SELECT docno::VARCHAR || chr(9) || text AS line
FROM documents JOIN ({NESTED}) hits ON docno = doc_id""",
    "graph_stats": f"""WITH {GRAPH} SELECT (SELECT count(*) FROM nodes) AS num_nodes,
  count(*) AS num_edges, count(DISTINCT src) AS num_active_nodes FROM edges""",
    "graph_validate": f"""WITH {GRAPH}, listed AS (SELECT id FROM goods
  UNION ALL SELECT s_suppkey * 4 FROM supplier WHERE s_acctbal < 0)
SELECT (SELECT count(*) FROM (SELECT id FROM listed GROUP BY id HAVING count(*) > 1)) AS dup_nodes,
  (SELECT count(DISTINCT dst) FROM edges WHERE dst NOT IN (SELECT id FROM listed)) AS missing_structure""",
    "ppr_start": f"WITH {_ranks((4, 13), 0)} SELECT source::BIGINT AS source, id, p FROM r0",
    "ppr_resume": f"WITH {_ranks((4, 8, 13), 3)} SELECT source::BIGINT AS source, id, round(p, 10) AS p FROM r3",
    "ppr_single": f"WITH {_ranks((4,), 3)} SELECT source::BIGINT AS source, id, round(p, 10) AS p FROM r3",
    "ppr_adjacency": f"WITH {_ranks((4,), 3)} SELECT source::BIGINT AS source, id, round(p, 10) AS p FROM r3",
    "ppr_multi": f"WITH {_ranks((4, 8, 13), 3)} SELECT source::BIGINT AS source, id, round(p, 10) AS p FROM r3",
    "ppr_top": f"""WITH {_ranks((4, 13), 3)}, numbered AS (
  SELECT source::BIGINT AS source, (row_number() OVER (PARTITION BY source
    ORDER BY printf('%.9e', p)::DOUBLE DESC, id))::INTEGER AS rank, id, p FROM r3 WHERE p > 0)
SELECT source, rank, id, round(p, 10) AS p FROM numbered WHERE rank <= 20""",
    "ppr_mass": f"""WITH {_ranks((4, 13), 3)}
SELECT source::BIGINT AS source, round(sum(m), 10) AS mass, round(greatest(1.0 - sum(m), 0.0), 10) AS missing
FROM m2 GROUP BY source""",
    "train_batch": f"""WITH {EPOCH_1}, scored AS (
  SELECT model_id, doc_id, sum(k * weight) AS score FROM occ JOIN w1 USING (model_id, feature) GROUP BY ALL),
step AS (
  SELECT model_id, feature, sum(0.002::DOUBLE * k * (y - 1.0 / (1.0 + exp(-score)))) AS g
  FROM occ JOIN scored USING (model_id, doc_id) GROUP BY ALL)
SELECT model_id, feature, round(weight + g, 9) AS weight FROM w1 JOIN step USING (model_id, feature)""",
    "train_batch_text": f"""WITH {LABELLED} SELECT 'all' AS model_id, feature,
  round(sum(0.002::DOUBLE * k * (y - 0.5)), 9) AS weight FROM occ GROUP BY feature""",
    "train_sgd": f"""WITH RECURSIVE {_sequence(f"""SELECT seq, doc_id, y,
  row_number() OVER (PARTITION BY seq ORDER BY doc_id) AS nth FROM labelled JOIN models USING (model_id)
  QUALIFY nth <= {MAX_DOCS}""").replace("seqs AS (", _MODEL_NUMBERS + ", seqs AS (", 1)}
SELECT model_id, feature, round(weight, 9) AS weight FROM weights JOIN models USING (seq)""",
    "train_sgd_sharded": f"""WITH RECURSIVE {_sequence(f"""SELECT {_SHARD} AS seq, doc_id, y,
  row_number() OVER (PARTITION BY {_SHARD} ORDER BY doc_id) AS nth FROM labelled""")}
SELECT 'all' AS model_id, feature, round(sum(weight) / {_SHARDS}, 9) AS weight FROM weights GROUP BY feature""",
    "shuffled_order": """SELECT range AS seed, doc_id, row_number() OVER (
  PARTITION BY range ORDER BY md5(doc_id::VARCHAR || ':' || range::VARCHAR), doc_id) - 1 AS position FROM documents, range(2)""",
    "train_runs": f"""WITH RECURSIVE {_sequence(_RUNS)}, preds AS (
  SELECT seq, label, printf('%.11e', sum(score))::DOUBLE AS score FROM (
    SELECT seq, doc_id, label, 0.0::DOUBLE AS score FROM labelled, (SELECT DISTINCT seq FROM weights)
    UNION ALL SELECT seq, doc_id, label, k * weight FROM labelled
      JOIN (SELECT doc_id, feature, sum(k) AS k FROM occ GROUP BY ALL) USING (doc_id) JOIN weights USING (feature))
  GROUP BY seq, doc_id, label),
rocas AS (WITH {_roca("preds", "seq").replace("round(", "(").replace(", DIGITS)", ")")})
SELECT count(*) AS runs, round(min(one_minus_roca), 6) AS low, round(max(one_minus_roca), 6) AS high,
  round(avg(one_minus_roca), 6) AS mean FROM rocas""",
    "score": f"WITH {ONE_SCORE} SELECT doc_id, label, round(score, 6) AS score, {_label(_sign())} FROM scored",
    "ensemble_average": f"""WITH {EPOCH_1}, {EVERY}, scored AS (
  SELECT d.doc_id, label, coalesce(sum(k * weight), 0.0) AS score, coalesce(sum(abs(k * weight)), 0.0) AS size
  FROM everyone d LEFT JOIN seen o ON o.doc_id = d.doc_id LEFT JOIN w1 m ON m.feature = o.feature GROUP BY ALL)
SELECT doc_id, label, round(score, 6) AS score,
  round(score / (SELECT count(DISTINCT model_id) FROM w1), 6) AS mean, {_label(_sign())} FROM scored""",
    "ensemble_vote": _VOTE,
    "ensemble_vote_text": _VOTE,
    "one_minus_roca": f"WITH {LENGTH}, {_roca('preds')}".replace("DIGITS", "9"),
    "one_minus_roca_by_language": f"WITH {LENGTH}, {_roca('preds', 'lang')}".replace("DIGITS", "9"),
    "one_minus_roca_model": (
        f"WITH {ONE_SCORE}, preds AS (SELECT label, {COMPARABLE} FROM scored), {_roca('preds')}"
    ).replace("DIGITS", "6"),
    "lam_text": _LAM,
    "lam": _LAM,
    "operating_points": f"""WITH {LENGTH}, per_score AS (
  SELECT score, count(*) FILTER (label = 'spam') AS s, count(*) FILTER (label = 'ham') AS h
  FROM preds GROUP BY score),
t AS (SELECT sum(s)::DOUBLE AS spams, sum(h)::DOUBLE AS hams FROM per_score),
run AS (SELECT score, sum(s) OVER (ORDER BY score) AS ss, sum(h) OVER (ORDER BY score) AS hh FROM per_score),
rates AS (SELECT score, CASE WHEN ss = 0 THEN 0.5 ELSE ss END::DOUBLE / spams AS fn,
  CASE WHEN hams = hh THEN 0.5 ELSE hams - hh END::DOUBLE / hams AS fp FROM run, t),
points AS (
  SELECT 'fp_at_fn' AS kind, {_RATE_BUCKET.format(r='fn')} AS bucket, arg_max(fp, score) AS rate
  FROM rates GROUP BY ALL
  UNION ALL SELECT 'fn_at_fp', {_RATE_BUCKET.format(r='fp')} AS bucket, arg_min(fn, score)
  FROM rates GROUP BY 1, 2)
SELECT kind, bucket, ({_EDGES})[bucket + 1] AS edge, round(rate, 9) AS rate FROM points""",
    "resampled_points": f"""WITH {LENGTH}, {_DRAWN},
totals AS (SELECT rep, sum(s)::DOUBLE AS spams, sum(h)::DOUBLE AS hams FROM per_score GROUP BY rep),
run AS (SELECT rep, score, sum(s) OVER w AS ss, sum(h) OVER w AS hh FROM per_score WINDOW w AS (PARTITION BY rep ORDER BY score)),
rates AS (SELECT rep, score, CASE WHEN ss = 0 THEN 0.5 ELSE ss END::DOUBLE / spams AS fn,
  CASE WHEN hams = hh THEN 0.5 ELSE hams - hh END::DOUBLE / hams AS fp FROM run JOIN totals USING (rep)),
points AS (
  SELECT rep, 'fp_at_fn' AS kind, {_RATE_BUCKET.format(r='fn')} AS bucket, arg_max(fp, score) AS rate
  FROM rates GROUP BY ALL
  UNION ALL SELECT rep, 'fn_at_fp', {_RATE_BUCKET.format(r='fp')} AS bucket, arg_min(fn, score)
  FROM rates GROUP BY 1, 2, 3),
logits AS (SELECT kind, bucket, ln(least(rate, 1 - 1e-9) / (1 - least(rate, 1 - 1e-9))) AS l FROM points)
SELECT kind, bucket, ({_EDGES})[bucket + 1] AS edge, count(*) AS reps, round(1.0 / (1.0 + exp(-avg(l))), 9) AS rate
FROM logits GROUP BY kind, bucket""",
    "roca_ci": f"""WITH {LENGTH}, drawn AS (
  SELECT rep, score, label, pred, len(list_filter({_DRAWS}, lambda c: c <= u)) AS n FROM (
    SELECT range AS rep, score, label, pred,
      ('0x' || md5(doc_id::VARCHAR || ':' || range::VARCHAR || ':0')[1:13])::BIGINT::DOUBLE / 4503599627370496.0::DOUBLE AS u
    FROM preds, range(100))),
per_score AS (
  SELECT rep, score, sum(n) FILTER (label = 'spam') AS s, sum(n) FILTER (label = 'ham') AS h,
    sum(n) FILTER (label = 'spam' AND pred = 'ham') AS fn, sum(n) FILTER (label = 'ham' AND pred = 'spam') AS fp
  FROM drawn WHERE n > 0 GROUP BY ALL),
sums AS (SELECT rep, sum(s)::DOUBLE AS s, sum(h)::DOUBLE AS h, coalesce(sum(fn), 0)::DOUBLE AS fn, coalesce(sum(fp), 0)::DOUBLE AS fp
  FROM per_score GROUP BY rep),
wrong AS (
  SELECT h.rep, sum(h.h::DOUBLE * s.s::DOUBLE * CASE WHEN s.score < h.score THEN 1.0 ELSE 0.5 END::DOUBLE) AS inv
  FROM per_score h JOIN per_score s ON h.rep = s.rep AND s.score <= h.score GROUP BY h.rep),
per_rep AS (
  SELECT CASE WHEN inv = 0 THEN 0.5 ELSE inv END / (s * h) AS r,
    CASE WHEN fp = 0 THEN 0.5 WHEN fp = h THEN h - 0.5 ELSE fp END / h AS a,
    CASE WHEN fn = 0 THEN 0.5 WHEN fn = s THEN s - 0.5 ELSE fn END / s AS b FROM sums JOIN wrong USING (rep)),
spread AS (
  SELECT stddev_samp(ln(r / (1 - r))) AS roca_sd, stddev_samp((ln(a / (1 - a)) + ln(b / (1 - b))) / 2) AS lam_sd FROM per_rep),
estimates AS (
  SELECT 'one_minus_roca' AS metric, one_minus_roca AS estimate, roca_sd AS sd
  FROM (WITH {_roca('preds').replace('round(', '(').replace(', DIGITS)', ')').replace('per_score', 'per_score_once')}), spread
  UNION ALL SELECT 'lam', lam, lam_sd FROM (
    WITH c AS (SELECT count(*) FILTER (label = 'ham') AS hams, count(*) FILTER (label = 'spam') AS spams,
      count(*) FILTER (label = 'ham' AND pred = 'spam') AS fp, count(*) FILTER (label = 'spam' AND pred = 'ham') AS fn FROM preds),
    r AS (SELECT CASE WHEN fp = 0 THEN 0.5 WHEN fp = hams THEN hams - 0.5 ELSE fp END::DOUBLE / hams AS a,
      CASE WHEN fn = 0 THEN 0.5 WHEN fn = spams THEN spams - 0.5 ELSE fn END::DOUBLE / spams AS b FROM c)
    SELECT 100.0 / (1.0 + exp(-(ln(a / (1 - a)) + ln(b / (1 - b))) / 2)) AS lam FROM r), spread)
SELECT metric, round(estimate, 6) AS estimate,
  round(100.0 / (1.0 + exp(-(ln(estimate / (100 - estimate)) - 1.96 * sd))), 6) AS low,
  round(100.0 / (1.0 + exp(-(ln(estimate / (100 - estimate)) + 1.96 * sd))), 6) AS high FROM estimates""",
}
