"""The same results in SQL, one text per query that SQL can express."""

from __future__ import annotations

from furlong import fixed_values as fixed

# white space as the text functions understand it
SPACE = r"[\s\x0b\x{85}\p{Z}]"
WORD = r"[\p{L}\p{N}_]"


def plain(column: str) -> str:
    """Entities of the flat pages decoded, the ampersand last."""
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
        column = f"replace({column}, '{entity}', '{char}')"
    return column


def first_match(column: str, pattern: str) -> str:
    return f"nullif(regexp_extract({column}, '{pattern}', 1), '')"


PART_CODE = """CAST(coalesce(CASE regexp_extract({name}, 'widget|bolt|gear')
    WHEN 'widget' THEN 0 WHEN 'bolt' THEN 1 WHEN 'gear' THEN 2 END, -1) AS TINYINT)"""

YEN = "format('{:,}', CAST(floor(o_totalprice) AS BIGINT))"

LINKS = r"""
links AS (
    SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 1)) AS href,
           unnest(regexp_extract_all(html, '<a href="([^"]*)">([^<]*)</a>', 2)) AS raw_text,
           unnest(range(len(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')))) AS link_no
    FROM pages
)"""

SIDES = """
w AS (SELECT user_id, max(value) AS win_payout FROM events WHERE event_type = 'purchase' GROUP BY 1),
p AS (SELECT user_id, max(value) AS place_payout FROM events WHERE event_type = 'signup' GROUP BY 1),
payouts AS (SELECT user_id, win_payout, place_payout FROM w FULL JOIN p USING (user_id))
"""

# the two runners of a rendered race page, before the trainer join
RUNNERS = f"""
base AS (
    SELECT *, strftime(o_orderdate, '%Y%m%d') AS race_date, CAST(o_orderkey AS VARCHAR) AS race_id,
           substring(o_orderpriority, 1, 1) AS digit, CAST(floor(o_totalprice) AS INTEGER) AS price,
           day(o_orderdate) - 15 AS diff, CAST(o_custkey AS VARCHAR) AS cust
    FROM orders
),
runners AS (
    SELECT b.*, n, CAST(n AS VARCHAR) AS no,
        CASE WHEN n = 1 THEN '1' WHEN o_orderstatus = 'F' THEN '中止' ELSE '2' END AS rank,
        CASE WHEN n = 1 THEN 'h' || cust ELSE 'p' || digit END AS horse_id,
        CASE WHEN n = 1 THEN '馬' || cust ELSE '星' || digit END AS horse_name,
        CASE WHEN n = 1 THEN '480(' || CASE WHEN diff >= 0 THEN '+' ELSE '' END || CAST(diff AS VARCHAR) || ')'
             ELSE '480(0)' END AS horse_weight_and_diff,
        CASE WHEN n = 1 THEN diff ELSE 0 END AS weight_diff,
        digit || CASE WHEN o_orderstatus = 'O' THEN '' ELSE CAST(n AS VARCHAR) END AS trainer,
        CASE WHEN o_orderstatus = 'P' THEN '2歳新馬' ELSE '3歳未勝利' END AS race_name,
        CASE WHEN o_orderstatus = 'O' THEN '芝2000m(右)' ELSE 'ダ1400m(左)' END AS distance
    FROM base b, (VALUES (1), (2)) t(n)
)"""

# Lines, labels and the share of label 1 in each cell of two flags.
FLAG_CELLS = """
flags AS (SELECT l_quantity > 25 AS large, l_discount > 0.05 AS cheap,
                 CAST(CASE WHEN l_extendedprice * (1 - l_discount) > 40000 THEN 1 ELSE 0 END AS DOUBLE) AS label FROM lineitem),
cells AS (SELECT large, cheap, count(*) AS n, avg(label) AS p FROM flags GROUP BY 1, 2)"""



def boosting_round(before: str, after: str) -> str:
    """One round on the four cells: the root is split by ``large``, each side by ``cheap`` if that gains."""
    shrunk = "sign({0}) * greatest(abs({0}) - 0.5, 0)"
    return f"""
{after}_sums AS (SELECT *, n / (1 + exp(-f)) - pos AS g, n * exp(-f) / (1 + exp(-f)) ** 2 AS h FROM {before}),
{after}_cells AS (SELECT *, sum(g) OVER side AS sg, sum(h) OVER side AS sh, ({shrunk.format("g")}) ** 2 / (h + 3) AS worth
                  FROM {after}_sums WINDOW side AS (PARTITION BY large)),
{after}_gains AS (SELECT *, sum(worth) OVER (PARTITION BY large) - ({shrunk.format("sg")}) ** 2 / (sh + 3) AS gain FROM {after}_cells),
{after} AS (SELECT large, cheap, n, pos,
                   f - 0.3 * CASE WHEN gain > 0 THEN ({shrunk.format("g")}) / (h + 3) ELSE ({shrunk.format("sg")}) / (sh + 3) END AS f
            FROM {after}_gains)"""


def hash_share(text: str) -> str:
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) / CAST(4503599627370496 AS DOUBLE)"


def drawn(name: str, kind: str, low: float, high: float) -> str:
    u = hash_share(f"'0:' || trial || ':{name}'")
    if kind == "int":
        return f"CAST(least({low} + floor({u} * {high - low + 1}), {high}) AS INTEGER) AS {name}"
    if kind == "log":
        return f"round(exp(ln({low}::DOUBLE) + {u} * (ln({high}::DOUBLE) - ln({low}::DOUBLE))), 9) AS {name}"
    return f"{low}::DOUBLE + {u} * {high - low} AS {name}"


DRAWS = ", ".join(drawn(name, *how) for name, how in fixed.LEAF_WISE_SEARCH.items())

ORACLE: dict[str, str] = {
    "feature_build": f"""
WITH typed AS (
    SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, {PART_CODE.format(name="p_name")} AS part_code,
           CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS brand_no
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
    WHERE o_orderstatus NOT IN ('P') AND NOT contains(p_name, 'ring')
), means AS (SELECT l_partkey, avg(l_quantity) AS mean FROM typed GROUP BY 1)
SELECT t.*, round(mean, 6) AS mean, round(l_quantity - mean, 6) AS dev FROM typed t LEFT JOIN means USING (l_partkey)""",
    "typed_select": """
SELECT p_partkey, CAST(CAST(p_size AS VARCHAR) AS INTEGER) AS size_int,
       CAST(CAST(p_retailprice AS VARCHAR) AS DOUBLE) AS price_double, CAST(p_size AS FLOAT) AS size_float,
       CASE WHEN p_size = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
FROM part""",
    "rename_project": "SELECT s_suppkey AS trainer_id, s_name AS trainer_name, s_acctbal AS balance FROM supplier",
    "add_literals": "SELECT *, '20240106' AS race_date, CAST(NULL AS VARCHAR) AS race_name FROM supplier",
    "regex_first_int": r"""
SELECT p_partkey, CAST(nullif(regexp_extract(p_brand, '(\p{Nd}+)', 1), '') AS INTEGER) AS brand_no,
       CAST(nullif(regexp_extract(p_type, '(\p{Nd}+)', 1), '') AS INTEGER) AS type_no
FROM part""",
    "regex_anchored_int": r"""
SELECT o_orderkey, CAST(nullif(regexp_extract(o_orderpriority, '^(\p{Nd}+)', 1), '') AS INTEGER) AS priority,
       CAST(nullif(regexp_extract(o_orderstatus, '^(\p{Nd}+)', 1), '') AS INTEGER) AS status_no
FROM orders""",
    "regex_signed_paren": r"""
SELECT doc_id, nullif(regexp_extract(text, '\(([-+\p{Nd}]+)\)', 1), '') AS number FROM documents""",
    "label_encode": f"""SELECT p_partkey, {PART_CODE.format(name="nullif(p_name, 'red bolt')")} AS code FROM part""",
    "trim_unicode": """
SELECT c_custkey, c_name AS name, CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_mktsegment || c_name END AS labelled
FROM customer""",
    "strip_split_positional": """
SELECT p_partkey, p_brand AS start_at, CAST(p_size AS VARCHAR) AS distance,
       CASE WHEN p_size > 10 THEN replace(p_name, ' ', '') END AS weather,
       CASE WHEN p_size > 30 THEN replace(p_type, ' ', '') END AS field_condition
FROM part""",
    "replace_extract_all": """
SELECT o_orderkey, CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) || '|' ||
       array_to_string(regexp_extract_all(o_orderpriority, '[0-9]+'), '|') AS digits
FROM orders""",
    "dict_encode": """
WITH r AS (
    SELECT l_orderkey, l_linenumber, 's' || CAST(l_suppkey AS VARCHAR) AS supplier, nullif(l_returnflag, 'N') AS flag
    FROM lineitem
),
s AS (SELECT supplier, row_number() OVER (ORDER BY supplier) - 1 AS supplier_cat FROM (SELECT DISTINCT supplier FROM r)),
f AS (SELECT flag, row_number() OVER (ORDER BY flag) - 1 AS flag_cat FROM (SELECT DISTINCT flag FROM r WHERE flag IS NOT NULL))
SELECT r.*, supplier_cat, flag_cat FROM r LEFT JOIN s USING (supplier) LEFT JOIN f USING (flag)""",
    "filter_not_contains": """
SELECT * FROM (SELECT p_partkey, nullif(p_name, 'red bolt') AS p_name FROM part) WHERE NOT contains(p_name, 'ring')""",
    "filter_not_in": """
SELECT * FROM (SELECT o_orderkey, nullif(o_orderstatus, 'O') AS o_orderstatus FROM orders) WHERE o_orderstatus NOT IN ('P')""",
    "stored_code_encode": """
WITH codes AS (SELECT l_partkey, row_number() OVER (ORDER BY l_partkey) - 1 AS code
               FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_shipdate < TIMESTAMP '1993-01-01'))
SELECT l_orderkey, l_linenumber, l_partkey, code AS l_partkey_cat
FROM lineitem LEFT JOIN codes USING (l_partkey) WHERE l_shipdate >= TIMESTAMP '1993-01-01'""",
    "filter_date_between": """
SELECT * FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS race_date FROM orders)
WHERE race_date BETWEEN '19960101' AND '19961231'""",
    "time_split": """
SELECT o_orderkey, race_date, CASE WHEN race_date BETWEEN '19960101' AND '19981231' THEN 'train'
                                   WHEN race_date > '19981231' THEN 'valid' END AS split
FROM (SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS race_date FROM orders)""",
    "name_join_fanout": f"""
WITH {LINKS},
items AS (
    SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="[^"]*">([^<]*)</a>', 1)) AS raw_text,
           CAST(unnest(range(len(regexp_extract_all(html, '<li><a ')))) AS INTEGER) AS item_no
    FROM pages
)
SELECT i.page_id, i.item_no, {plain("i.raw_text")} AS name, {first_match("l.href", f"/({WORD}+)")} AS name_id
FROM items i LEFT JOIN links l ON i.page_id = l.page_id AND {plain("i.raw_text")} = {plain("l.raw_text")}""",
    "name_join_dedup": """
SELECT l_orderkey, l_linenumber, 'S' || CAST(l_suppkey AS VARCHAR) AS name,
       min(l_partkey) OVER (PARTITION BY l_orderkey, l_suppkey) AS part_id
FROM lineitem""",
    "full_outer_payout": f"WITH {SIDES} SELECT * FROM payouts",
    "left_join_payout": f"""
WITH {SIDES}
SELECT event_id, user_id, event_type, win_payout, place_payout FROM events LEFT JOIN payouts USING (user_id)""",
    "group_mean_join_dev": """
WITH r AS (
    SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag <> 'N' THEN l_partkey END AS horse_id, l_quantity FROM lineitem
), m AS (SELECT horse_id, avg(l_quantity) AS mean FROM r GROUP BY 1)
SELECT r.*, round(mean, 6) AS mean, round(l_quantity - mean, 6) AS dev FROM r LEFT JOIN m USING (horse_id)""",
    "stored_mean_join": """
WITH m AS (SELECT l_partkey, avg(l_quantity) AS mean FROM lineitem WHERE l_shipdate < TIMESTAMP '1998-01-01' GROUP BY 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, round(mean, 6) AS mean, round(l_quantity - mean, 6) AS dev
FROM lineitem LEFT JOIN m USING (l_partkey) WHERE l_shipdate >= TIMESTAMP '1998-01-01'""",
    "missing_worklist_anti": "SELECT DISTINCT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
    "tiered_lookup": """
WITH local AS (SELECT doc_id, text FROM documents WHERE lang = 'en' AND text <> '')
SELECT doc_id, text FROM local
UNION ALL SELECT doc_id, 'stored ' || text FROM documents WHERE lang <> 'de' AND doc_id NOT IN (SELECT doc_id FROM local)""",
    "collect_list_by_date": """
WITH r AS (
    SELECT strftime(o_orderdate, '%Y%m%d') AS race_date, o_custkey,
           row_number() OVER (PARTITION BY o_orderdate ORDER BY o_custkey) - 1 AS place
    FROM orders
)
SELECT race_date, CAST(place // 10000 AS INTEGER) AS part, string_agg(CAST(o_custkey AS VARCHAR), ' ' ORDER BY place) AS ids
FROM r GROUP BY 1, 2""",
    "vertical_concat": """
SELECT c_nationkey AS nation, c_acctbal AS balance FROM customer
UNION ALL SELECT s_nationkey, s_acctbal FROM supplier
UNION ALL SELECT c_nationkey, c_acctbal FROM customer""",
    "explode_zip": """
SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS horse_number, CAST(floor(o_totalprice) AS INTEGER) AS payout FROM orders
UNION ALL SELECT o_orderkey, substring(o_orderpriority, 1, 1), 150 FROM orders
UNION ALL SELECT o_orderkey, o_orderstatus, 1330 FROM orders""",
    "url_param_extract": f"""
SELECT page_id, {first_match("url", f"page=({WORD}+)")} AS page_no,
       {first_match("url", "^https?://[^/]+/([a-z]+)/")} AS lang, {first_match("url", f"/[a-z]+/({WORD}+)")} AS path_id
FROM pages""",
    "href_extract": f"""
WITH {LINKS}
SELECT page_id, CAST(link_no AS INTEGER) AS link_no, {plain("raw_text")} AS name,
       {first_match("href", f"/({WORD}+)")} AS link_id
FROM links""",
    "link_extract": f"""
WITH {LINKS}
SELECT page_id, {plain("raw_text")} AS name, {first_match("href", f"/({WORD}+)")} AS link_id
FROM links WHERE regexp_matches(href, '/{WORD}')""",
    "list_item_ids": f"""
WITH items AS (
    SELECT page_id, unnest(regexp_extract_all(html, '<li><a href="([^"]*)">', 1)) AS href,
           CAST(unnest(range(len(regexp_extract_all(html, '<li><a ')))) AS INTEGER) AS item_no
    FROM pages
)
SELECT page_id, item_no, {first_match("href", f"/({WORD}+)")} AS item_id FROM items""",
    "page_info_extract": f"""
SELECT page_id, {first_match("html", '<html lang="([^"]*)"')} AS lang,
       regexp_replace({plain(first_match("html", "<title>([^<]*)</title>"))}, '^{SPACE}+|{SPACE}+$', '', 'g') AS title,
       regexp_replace({plain(first_match("html", "<h1>([^<]*)</h1>"))}, '^{SPACE}+|{SPACE}+$', '', 'g') AS heading
FROM pages""",
    "first_table_extract": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "card_table_extract": "SELECT p_partkey, p_name AS horse_name, CAST(p_size AS VARCHAR) AS frame FROM part",
    "class_table_union": """
SELECT c_custkey, 'name' AS field, c_name AS value FROM customer
UNION ALL SELECT c_custkey, 'segment', '<&> ' || c_mktsegment FROM customer
UNION ALL SELECT c_custkey, 'nation', CAST(c_nationkey AS VARCHAR) FROM customer""",
    "horse_history_rows": f"""
SELECT o_orderkey, {", ".join(f"'c{i} ' || o_orderkey AS \"{name}\"" for i, name in enumerate(fixed.HISTORY_COLUMNS))}
FROM orders""",
    "horse_profile_rows": """
SELECT c_custkey, CAST(0 AS INTEGER) AS row_no, 'item|entry' AS cells FROM customer
UNION ALL SELECT c_custkey, CAST(1 AS INTEGER), 'name|' || c_name FROM customer""",
    "path_keys": """
SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS race_date, CAST(o_orderkey AS VARCHAR) AS race_id FROM orders""",
    "assembled_vector": """
SELECT CAST(l_linenumber AS DOUBLE) AS l_linenumber, CASE WHEN l_quantity < 40 THEN CAST(l_quantity AS DOUBLE) ELSE -1e6 END AS small,
       CAST(l_tax AS DOUBLE) AS l_tax, count(*) AS n
FROM lineitem GROUP BY ALL""",
    "gbt_flags": f"""
WITH {FLAG_CELLS},
first AS (SELECT large, cheap, n, p, 2 * p - 1 AS f FROM cells),
second AS (SELECT large, cheap, n, p, f + 0.1 * (p * 4 / (1 + exp(2 * f)) - (1 - p) * 4 / (1 + exp(-2 * f))) AS f FROM first),
scored AS (SELECT large, cheap, n * p AS pos, n * (1 - p) AS neg, 1 / (1 + exp(-2 * f)) AS score FROM second),
pairs AS (SELECT sum(a.pos * b.neg * CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END)
                 / sum(a.pos * b.neg) AS auc FROM scored a, scored b)
SELECT label, round(score, 9) AS score, count(*) AS n, CAST(2 AS INTEGER) AS depth, round(any_value(auc), 9) AS auc
FROM flags JOIN scored USING (large, cheap), pairs GROUP BY 1, 2""",
    "importance_flags": f"""
WITH {FLAG_CELLS},
total AS (SELECT sum(n * p) / sum(n) AS m FROM cells),
pair AS (SELECT sum(n * (p - m) ** 2) AS gain FROM cells, total),
one AS (SELECT 'large' AS feature, sum(n * (p - m) ** 2) AS gain
        FROM (SELECT large, sum(n) AS n, sum(n * p) / sum(n) AS p FROM cells GROUP BY 1), total
        UNION ALL SELECT 'cheap', sum(n * (p - m) ** 2)
        FROM (SELECT cheap, sum(n) AS n, sum(n * p) / sum(n) AS p FROM cells GROUP BY 1), total),
root AS (SELECT max(gain) AS gain FROM one)
SELECT feature, round(CASE WHEN one.gain = root.gain THEN root.gain ELSE pair.gain - root.gain END / pair.gain, 9) AS gain,
       CASE WHEN one.gain = root.gain THEN 1.0 ELSE 2.0 END::DOUBLE AS weight
FROM one, root, pair""",
    "calendar_dates": """
SELECT o_orderkey, CAST(1 AS INTEGER) AS link_no, strftime(o_orderdate, '%Y%m%d') AS race_date FROM orders""",
    "day_race_ids": """
SELECT strftime(o_orderdate, '%Y%m%d') AS race_date, CAST(1 AS INTEGER) AS item_no, CAST(o_orderkey AS VARCHAR) AS race_id
FROM orders""",
    "day_work_list": """
SELECT DISTINCT strftime(o_orderdate, '%Y%m%d') AS race_date, CAST(o_orderkey AS VARCHAR) AS race_id
FROM orders WHERE o_orderstatus <> 'F'""",
    "race_result_build": f"""
WITH {RUNNERS}
SELECT rank, no AS frame, no AS horse_number, horse_name,
       CASE WHEN o_orderstatus = 'F' THEN '牡' ELSE '牝' END || digit AS gender_age, '5' || no || '.0' AS total_weight,
       '騎' || no AS jockey_name, '1:2' || no || '.0' AS goal_time, CAST(NULL AS VARCHAR) AS goal_diff, no AS popular,
       no || '.5' AS odds, '35.1' AS last_3f_time, '1-1' AS corner_rank, '美浦師' || trainer AS trainer_name,
       horse_weight_and_diff, race_id, race_date, digit || 'R' AS race_number, race_name, digit || ':10発走' AS start_at,
       distance, '天候:晴' AS weather, CASE WHEN o_orderstatus <> 'F' THEN '馬場:良' END AS field_condition,
       horse_id, 'j' || no AS jockey_id, 't' || trainer AS trainer_id, '美浦' AS trainer_label,
       CASE WHEN n = 1 THEN price END AS win_payout, CASE WHEN n = 1 THEN price ELSE 150 END AS place_payout
FROM runners r
JOIN (VALUES (1), (2)) AS copies(c) ON c = 1 OR o_orderstatus = 'O'""",
    "race_features": f"""
WITH {RUNNERS},
typed AS (
    SELECT n AS horse_number, n AS frame, CAST(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS TINYINT) AS gender,
           CAST(digit AS INTEGER) AS age, 50.0 + n AS total_weight, CAST(digit AS INTEGER) AS race_number,
           CAST(digit AS INTEGER) AS start_at, CASE WHEN o_orderstatus = 'O' THEN 2000 ELSE 1400 END AS distance,
           CAST(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS TINYINT) AS rotate,
           CAST(CASE WHEN o_orderstatus = 'O' THEN 0 ELSE 1 END AS TINYINT) AS field_type, CAST(0 AS TINYINT) AS weather,
           CAST(CASE WHEN o_orderstatus = 'F' THEN -1 ELSE 0 END AS TINYINT) AS field_condition, n AS popular,
           CAST(n + 0.5 AS FLOAT) AS odds, CAST(weight_diff AS INTEGER) AS horse_weight_diff, race_id, race_date, horse_name,
           horse_id, 'j' || no AS jockey_id, 't' || trainer AS trainer_id, CAST(rank AS INTEGER) AS rank
    FROM runners WHERE o_orderstatus <> 'P' AND rank <> '中止'
),
m AS (SELECT horse_id, avg(horse_weight_diff) AS mean FROM typed GROUP BY 1)
SELECT typed.* REPLACE (CAST(total_weight AS DOUBLE) AS total_weight),
       dense_rank() OVER (ORDER BY horse_id) - 1 AS horse_id_cat,
       dense_rank() OVER (ORDER BY jockey_id) - 1 AS jockey_id_cat,
       dense_rank() OVER (ORDER BY trainer_id) - 1 AS trainer_id_cat,
       round(mean, 6) AS weight_diff_avg, round(horse_weight_diff - mean, 6) AS horse_weight_diff_dev
FROM typed LEFT JOIN m USING (horse_id)""",
    "decode_charset": "SELECT doc_id, text FROM documents",
    "versioned_write_read": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders",
    "partitioned_write_prune": """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
       strftime(o_orderdate, '%Y%m%d') AS race_date, strftime(o_orderdate, '%Y%m') AS ym
FROM orders WHERE strftime(o_orderdate, '%Y%m') BETWEEN '199601' AND '199612'""",
    "incremental_ingest_stream": "SELECT page_id, url, html FROM pages",
    "roc_auc": """
WITH s AS (SELECT quality AS label, n_chars AS score FROM labels JOIN documents USING (doc_id)),
ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM s),
c AS (SELECT CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
             sum(CASE WHEN label = 1 THEN r END) AS ranks FROM ranked)
SELECT positives, negatives, round((ranks - positives * (positives + 1) / 2.0) / (positives * negatives), 9) AS auc FROM c""",
    "roc_auc_lines": """
WITH s AS (SELECT CASE WHEN l_quantity > 25 THEN 1 ELSE 0 END AS label, l_extendedprice AS score FROM lineitem),
ranked AS (SELECT label, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS r FROM s),
c AS (SELECT CAST(sum(label) AS BIGINT) AS positives, CAST(count(*) - sum(label) AS BIGINT) AS negatives,
             sum(CASE WHEN label = 1 THEN r END) AS ranks FROM ranked)
SELECT positives, negatives, round((ranks - positives * (positives + 1) / 2.0) / (positives * negatives), 9) AS auc FROM c""",
    "ids_by_date": """
SELECT strftime(o_orderdate, '%Y%m%d') AS race_date, o_custkey,
       row_number() OVER (PARTITION BY o_orderdate ORDER BY o_custkey) - 1 AS place FROM orders""",
    "mean_before_day": """
SELECT l_orderkey, l_linenumber,
       round(avg(l_quantity) OVER (PARTITION BY l_partkey ORDER BY CAST(l_shipdate AS DATE)
                                   RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 1 DAY PRECEDING), 6) AS mean_before
FROM lineitem""",
    "growing_means": """
SELECT l_partkey, round(avg(l_quantity), 6) AS mean,
       round(avg(l_quantity) FILTER (WHERE l_shipdate < TIMESTAMP '1999-01-01'), 6) AS mean_before
FROM lineitem GROUP BY 1""",
    "growing_codes": """
WITH first AS (
    SELECT l_suppkey, min(CASE WHEN l_shipdate < TIMESTAMP '1997-01-01' THEN 1 WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 2 ELSE 3 END) AS part
    FROM lineitem WHERE l_extendedprice > 90000 GROUP BY 1
)
SELECT l_suppkey, row_number() OVER (ORDER BY part, l_suppkey) - 1 AS code FROM first""",
    "co_located_mean_join": """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, round(avg(l_quantity) OVER (PARTITION BY l_partkey), 6) AS mean FROM lineitem""",
    "commit_versions": """
SELECT CAST(number AS INTEGER) AS number, 'orders' AS name, o_orderkey AS key, o_totalprice AS value
FROM orders, (VALUES (1), (2), (0)) AS v(number) WHERE number <> 1 OR o_orderstatus = 'F'
UNION ALL
SELECT CAST(number AS INTEGER), 'customer', c_custkey, c_acctbal FROM customer, (VALUES (1), (2), (0)) AS v(number)""",
    "page_files_scan": """
SELECT * FROM (SELECT source, '202403' || lpad(CAST(page_id % 28 + 1 AS VARCHAR), 2, '0') AS race_date, page_id, md5(html) AS html_md5
               FROM pages, (VALUES ('files'), ('text')) AS v(source))
WHERE race_date BETWEEN '20240305' AND '20240320'""",
    "keyed_ingest_stream": "SELECT event_id, user_id, event_type FROM events",
    "boosted_flags": f"""
WITH flags AS (SELECT CAST(l_quantity > 25 AS INTEGER) AS large, CAST(l_discount > 0.05 AS INTEGER) AS cheap,
                      CASE WHEN l_extendedprice * (1 - l_discount) > 40000 THEN 1 ELSE 0 END AS label FROM lineitem),
counts AS (SELECT large, cheap, count(*) AS n, sum(label) AS pos FROM flags GROUP BY 1, 2),
start AS (SELECT large, cheap, n, pos, ln(sum(pos) OVER () / (sum(n) OVER () - sum(pos) OVER ())) AS f FROM counts),
{boosting_round("start", "one")}, {boosting_round("one", "two")}
SELECT large, cheap, round(f, 9) AS margin, n FROM two""",
    "boosted_sets": """
WITH lines AS (SELECT l_suppkey, CASE WHEN l_extendedprice > 40000 THEN 1 ELSE 0 END AS label FROM lineitem),
total AS (SELECT count(*) AS n, avg(label) AS p, ln(sum(label) / (count(*) - sum(label))) AS f FROM lines),
ids AS (SELECT l_suppkey, count(*) AS n, count(*) * any_value(p) - sum(label) AS g, count(*) * any_value(p * (1 - p)) AS h
        FROM lines, (SELECT p FROM total) GROUP BY 1),
prefix AS (SELECT l_suppkey, n, sum(g) OVER w AS lg, sum(h) OVER w AS lh, sum(n) OVER w AS ln, sum(g) OVER () AS tg, sum(h) OVER () AS th,
                  sum(n) OVER () AS tn, row_number() OVER w AS place
           FROM ids WINDOW w AS (ORDER BY g / (h + 10), CAST(l_suppkey AS VARCHAR) ROWS UNBOUNDED PRECEDING)),
best AS (SELECT place, lg, lh, tg, th FROM prefix WHERE ln >= 20 AND tn - ln >= 20
         ORDER BY lg ** 2 / (lh + 1) + (tg - lg) ** 2 / (th - lh + 1) DESC, place LIMIT 1)
SELECT l_suppkey, p.n, round(f - 0.3 * CASE WHEN p.place <= b.place THEN b.lg / (b.lh + 1) ELSE (b.tg - b.lg) / (b.th - b.lh + 1) END, 9) AS margin
FROM prefix p, best b, (SELECT f FROM total)""",
    "hpo_draws": f"""
WITH draws AS (SELECT trial, {DRAWS} FROM range(100) AS t(trial)),
marks AS (SELECT {hash_share("l_orderkey || ':' || l_linenumber")} AS mark FROM lineitem),
counts AS (SELECT trial, count(mark) AS rows FROM draws LEFT JOIN marks ON mark < bagging_fraction GROUP BY 1)
SELECT draws.* REPLACE (round(feature_fraction, 9) AS feature_fraction, round(bagging_fraction, 9) AS bagging_fraction), rows
FROM draws JOIN counts USING (trial)""",
}
