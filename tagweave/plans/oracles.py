"""Independent SQL (DuckDB dialect) for every registered query with an exact twin.

Written from the semantics, not generated from the Spark plans: tags are
plain GROUP BY / CASE queries, the wide table is ``string_agg ... FILTER``,
bitmaps are ``count(DISTINCT uid)`` per bucket, ML results are the majority
votes of the regions that the label is made of.  The catalog of :mod:`tagweave.plans.profile` appears as
``VALUES`` lists.
"""

from __future__ import annotations

from tagweave.plans.profile import BUSINESS_DATE as DT

# --- catalog as VALUES --------------------------------------------------------
TASK_INFO = """(VALUES (1, '1'), (2, '1'), (3, '1'), (4, '1'), (5, '1'), (6, '1'), (7, '0'), (8, '1'), (9, '1'))
  AS task_info(id, task_status)"""
TAG_INFO = """(VALUES (101, 'TAG_BASE_SEGMENT', 'segment', '3', 1),
  (102, 'TAG_ORDER_COUNT', 'order count', '1', 2), (103, 'TAG_ORDER_AMOUNT', 'order amount', '2', 3),
  (104, 'TAG_LAST_ORDER', 'last order day', '4', 4), (105, 'TAG_PRIORITY', 'order priorities', '3', 5),
  (106, 'TAG_NATION_GROUP', 'nation group', '1', 6), (107, 'TAG_OFF', 'inactive', '3', 7),
  (108, 'TAG_EVENT_COUNT', 'events', '1', 8), (109, 'TAG_EVENT_TYPES', 'event types', '3', 9),
  (201, 'SEG_FURN', 'Furn', '3', NULL), (202, 'SEG_BUILD', 'Build', '3', NULL),
  (203, 'SEG_MACH', 'Mach', '3', NULL), (204, 'SEG_AUTO', 'Auto', '3', NULL),
  (205, 'SEG_FURN_2', 'Furniture', '3', NULL), (206, 'NAT_10', '10', '1', NULL),
  (207, 'NAT_11', '11', '1', NULL), (208, 'NAT_12', '12', '1', NULL))
  AS tag_info(id, tag_code, tag_name, tag_value_type, tag_task_id)"""
TASK_TAG_RULE = """(VALUES (1, 101, 1, 'FURNITURE', 201), (2, 101, 1, 'BUILDING', 202),
  (3, 101, 1, 'MACHINERY', 203), (4, 101, 1, 'AUTOMOBILE', 204), (5, 101, 1, 'FURNITURE', 205),
  (6, 101, 1, 'HOUSEHOLD', 299), (7, 106, 6, '0', 206), (8, 106, 6, '1', 207), (9, 106, 6, '2', 208))
  AS task_tag_rule(id, tag_id, task_id, query_value, sub_tag_id)"""

# --- one query per tag (typed values) ---------------------------------------
SEGMENT = """SELECT CAST(c_custkey AS VARCHAR) AS uid,
  CASE c_mktsegment WHEN 'FURNITURE' THEN 'Furn' WHEN 'BUILDING' THEN 'Build'
    WHEN 'MACHINERY' THEN 'Mach' WHEN 'AUTOMOBILE' THEN 'Auto' END AS tag_value
  FROM customer"""


def order_count(dt: str = DT) -> str:
    return f"""SELECT CAST(o_custkey AS VARCHAR) AS uid, CAST(count(*) AS BIGINT) AS tag_value
  FROM orders WHERE o_orderdate < TIMESTAMP '{dt}' GROUP BY o_custkey"""


def order_amount(dt: str = DT) -> str:
    return f"""SELECT CAST(o_custkey AS VARCHAR) AS uid,
  CAST(sum(CAST(o_totalprice AS DECIMAL(16,2))) AS DECIMAL(16,2)) AS tag_value
  FROM orders WHERE o_orderdate < TIMESTAMP '{dt}' GROUP BY o_custkey"""


def last_order(dt: str = DT) -> str:
    return f"""SELECT CAST(o_custkey AS VARCHAR) AS uid, strftime(max(o_orderdate), '%Y-%m-%d') AS tag_value
  FROM orders WHERE o_orderdate < TIMESTAMP '{dt}' GROUP BY o_custkey"""


def priority(dt: str = DT) -> str:
    return f"""SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS uid, o_orderpriority AS tag_value
  FROM orders WHERE o_orderdate < TIMESTAMP '{dt}'"""


NATION = """SELECT CAST(c_custkey AS VARCHAR) AS uid,
  CAST(CASE c_nationkey WHEN 0 THEN 10 WHEN 1 THEN 11 WHEN 2 THEN 12 END AS BIGINT) AS tag_value
  FROM customer"""

EVENT_COUNT = """SELECT CAST(user_id AS VARCHAR) AS uid, CAST(count(*) AS BIGINT) AS tag_value
  FROM events GROUP BY user_id"""
EVENT_TYPES = "SELECT DISTINCT CAST(user_id AS VARCHAR) AS uid, event_type AS tag_value FROM events"

def active(dt: str = DT) -> list[tuple[str, str]]:
    return [("TAG_BASE_SEGMENT", SEGMENT), ("TAG_ORDER_COUNT", order_count(dt)),
            ("TAG_ORDER_AMOUNT", order_amount(dt)), ("TAG_LAST_ORDER", last_order(dt)),
            ("TAG_PRIORITY", priority(dt)), ("TAG_NATION_GROUP", NATION),
            ("TAG_EVENT_COUNT", EVENT_COUNT), ("TAG_EVENT_TYPES", EVENT_TYPES)]


ACTIVE = active()
TYPES = {"TAG_BASE_SEGMENT": "3", "TAG_ORDER_COUNT": "1", "TAG_ORDER_AMOUNT": "2",
         "TAG_LAST_ORDER": "4", "TAG_PRIORITY": "3", "TAG_NATION_GROUP": "1",
         "TAG_EVENT_COUNT": "1", "TAG_EVENT_TYPES": "3"}

def long(dt: str = DT) -> str:
    return "\nUNION ALL\n".join(
        f"SELECT uid, CAST(tag_value AS VARCHAR) AS tag_value, '{code}' AS tag_name FROM ({sql})"
        for code, sql in active(dt))


def wide(dt: str = DT) -> str:
    return "SELECT uid,\n" + ",\n".join(
        f"  coalesce(string_agg(tag_value, ',' ORDER BY tag_value) FILTER (WHERE tag_name = '{code}'), '') "
        f"AS {code.lower()}" for code, _ in ACTIVE) + f"\nFROM ({long(dt)}) GROUP BY uid"


LONG, WIDE = long(), wide()


def cells(codes=None, dt: str = DT) -> str:
    """Non-empty wide cells ``(uid, tag_code, tag_value)``."""
    codes = codes or [c for c, _ in ACTIVE]
    parts = "\nUNION ALL\n".join(
        f"SELECT uid, '{c.lower()}' AS tag_code, {c.lower()} AS tag_value FROM wide" for c in codes)
    return f"WITH wide AS ({wide(dt)}) SELECT * FROM ({parts}) WHERE tag_value <> ''"


BUCKET = "CASE WHEN CAST(uid AS BIGINT) > 0 THEN (CAST(uid AS BIGINT) - 1) // 32768 + 1 ELSE 0 END"


def bitmap_counts(codes=None) -> str:
    return (f"SELECT tag_code, tag_value, CAST({BUCKET} AS BIGINT) AS bucket, "
            f"CAST(count(DISTINCT uid) AS BIGINT) AS users, '{DT.replace('-', '')}' AS dt "
            f"FROM ({cells(codes)}) GROUP BY ALL")


AUDIENCE = [("tag_base_segment", "Furn"), ("tag_nation_group", "10")]


def audience(how: str) -> str:
    conds = " OR ".join(f"(tag_code = '{c}' AND tag_value = '{v}')" for c, v in AUDIENCE)
    if how == "and":
        return (f"SELECT CAST(uid AS BIGINT) AS uid FROM ({cells()}) WHERE {conds} "
                f"GROUP BY uid HAVING count(DISTINCT tag_code || '=' || tag_value) = {len(AUDIENCE)}")
    return f"SELECT DISTINCT CAST(uid AS BIGINT) AS uid FROM ({cells()}) WHERE {conds}"


# --- ML frame over orders -----------------------------------------------------
ML_FRAME = """SELECT o_orderkey, o_totalprice, month(o_orderdate) AS order_month,
  CASE o_orderpriority WHEN '1-URGENT' THEN 11 WHEN '2-HIGH' THEN 12 WHEN '3-MEDIUM' THEN 13
    WHEN '4-NOT SPECIFIED' THEN 14 WHEN '5-LOW' THEN 15 END AS priority_code,
  CASE o_orderstatus WHEN 'F' THEN 21 WHEN 'O' THEN 22 WHEN 'P' THEN 23 END AS status_code
  FROM orders"""
LABELLED = f"""SELECT *,
  CASE WHEN status_code <> 21 THEN 'a' WHEN order_month <= 4 THEN 'b' WHEN priority_code = 15 THEN 'c' ELSE 'd' END AS region,
  (['open', 'closed', 'late'])[(CASE WHEN status_code <> 21 THEN 0 WHEN order_month <= 4 OR priority_code = 15 THEN 1 ELSE 2 END
    + CASE WHEN substr(md5('noise:' || o_orderkey), 1, 1) = '0' THEN 1 ELSE 0 END) % 3 + 1] AS order_state,
  CASE WHEN CAST('0x' || substr(md5('42:' || o_orderkey), 1, 8) AS BIGINT) / 4294967296.0 < 0.7
    THEN 'train' ELSE 'test' END AS part
  FROM ({ML_FRAME})"""


def indexed(rows: str) -> str:
    return f"""WITH f AS ({LABELLED}),
  c AS (SELECT order_state, count(*) AS n FROM f {rows} GROUP BY order_state),
  r AS (SELECT order_state, CAST(row_number() OVER (ORDER BY n DESC, order_state) - 1 AS DOUBLE) AS label_index FROM c)
  SELECT f.*, r.label_index FROM f JOIN r USING (order_state)"""


def predicted(region: str = "region") -> str:
    """Held-out rows with the training majority of their region: the leaf of a tree that splits on what makes the regions."""
    return f"""WITH x AS (SELECT *, {region} AS leaf FROM ({indexed("WHERE part = 'train'")})),
  v AS (SELECT leaf, order_state, label_index, count(*) AS n FROM x WHERE part = 'train' GROUP BY ALL),
  best AS (SELECT leaf, arg_max(label_index, n) AS prediction, arg_max(order_state, n) AS prediction_origin
    FROM v GROUP BY leaf)
  SELECT x.*, best.prediction, best.prediction_origin FROM x JOIN best USING (leaf) WHERE x.part = 'test'"""


PREDICTED = predicted()
MONTHS = "CASE WHEN status_code <> 21 THEN 'a' WHEN order_month <= {0} THEN 'b' ELSE 'c' END"
SETTINGS = {"depth 1": "status_code <> 21", "depth 2": MONTHS.format(4), "min instances": MONTHS.format(4),
            "min gain": "0", "bins 4": MONTHS.format(3)}

# The tree's nodes as sets of regions; impurity (gini) and gain from the training counts alone.
NODES = f"""WITH x AS ({indexed("WHERE part = 'train'")}),
  node(feature, below, smaller, larger) AS (VALUES
    ('status_code', 'abcd', 'a', 'bcd'), ('order_month', 'bcd', 'b', 'cd'), ('priority_code', 'cd', 'c', 'd'),
    ('leaf', 'a', NULL, NULL), ('leaf', 'b', NULL, NULL), ('leaf', 'c', NULL, NULL), ('leaf', 'd', NULL, NULL)),
  counted AS (SELECT below, order_state, count(*) AS n FROM node JOIN x ON contains(below, region) WHERE part = 'train' GROUP BY ALL),
  sized AS (SELECT below, sum(n) AS n_rows, arg_max(order_state, n) AS prediction_origin,
      1 - sum(n * n) / (sum(n) * sum(n)) AS impurity FROM counted GROUP BY below),
  gained AS (SELECT node.feature, s.*, CASE WHEN node.smaller IS NULL THEN 0.0
      ELSE s.impurity - (l.n_rows * l.impurity + r.n_rows * r.impurity) / s.n_rows END AS gain
    FROM node JOIN sized s USING (below) LEFT JOIN sized l ON l.below = node.smaller LEFT JOIN sized r ON r.below = node.larger)
  SELECT feature, CASE WHEN feature = 'order_month' THEN (SELECT (max(order_month) FILTER (WHERE region = 'b')
        + min(order_month) FILTER (WHERE region IN ('c', 'd'))) / 2.0 FROM x WHERE part = 'train')::DOUBLE END AS threshold,
    CAST(n_rows AS BIGINT) AS n_rows, impurity::DOUBLE AS impurity, gain::DOUBLE AS gain, prediction_origin FROM gained"""


def _sql() -> dict[str, str]:
    q: dict[str, str] = {}
    # catalog operators, applied to data
    q["catalog_lookup_one"] = "SELECT * FROM customer WHERE c_custkey = 42 LIMIT 1"
    q["active_tags"] = f"""SELECT tg.tag_code, tg.tag_value_type, CAST(l.n_rows AS BIGINT) AS n_rows
      FROM {TAG_INFO.replace('AS tag_info(', 'AS tg(')} JOIN {TASK_INFO} ON tg.tag_task_id = task_info.id
      JOIN (SELECT tag_name, count(*) AS n_rows FROM ({LONG}) GROUP BY tag_name) l ON l.tag_name = tg.tag_code
      WHERE task_info.task_status = '1'"""
    q["rules_join"] = f"""SELECT CAST(r.id AS BIGINT) AS id, r.query_value, t.tag_name AS sub_tag_value,
        CAST(coalesce(s.n_rows, 0) AS BIGINT) AS n_rows
      FROM {TASK_TAG_RULE.replace('AS task_tag_rule(', 'AS r(')}
      JOIN {TAG_INFO.replace('AS tag_info(', 'AS t(')} ON r.sub_tag_id = t.id
      LEFT JOIN (SELECT c_mktsegment AS query_value, count(*) AS n_rows FROM customer GROUP BY 1) s
        ON s.query_value = r.query_value
      WHERE r.task_id = 1"""
    type_rows = ", ".join(f"('{c.lower()}', '{t}')" for c, t in TYPES.items())
    q["tags_by_type"] = f"""SELECT m.tag_value_type,
        'user_tag_value_' || CASE m.tag_value_type WHEN '1' THEN 'long' WHEN '2' THEN 'decimal'
          WHEN '3' THEN 'string' WHEN '4' THEN 'date' END AS table_name,
        string_agg(DISTINCT m.tag_code, ',' ORDER BY m.tag_code) AS tag_codes,
        CAST(sum(coalesce(c.n, 0)) AS BIGINT) AS n_values
      FROM (VALUES {type_rows}) AS m(tag_code, tag_value_type)
      LEFT JOIN (SELECT tag_code, count(*) AS n FROM ({cells()}) GROUP BY tag_code) c USING (tag_code)
      GROUP BY m.tag_value_type"""
    q["camel_columns"] = ("SELECT c_custkey AS cCustkey, c_name AS cName, c_nationkey AS cNationkey, "
                          "c_acctbal AS cAcctbal, c_mktsegment AS cMktsegment FROM customer")
    q["rows_as_json"] = "SELECT CAST(to_json(c) AS VARCHAR) AS json FROM customer AS c"
    # scans
    q["scan_table"] = "SELECT * FROM customer"
    q["scan_tag_partition"] = order_count()
    q["tag_table_catalog"] = f"SELECT *, '{DT}' AS dt FROM ({order_count()})"
    q["tag_sql_source"] = (f"SELECT DISTINCT o_custkey AS uid, o_orderpriority AS query_value FROM orders "
                           f"WHERE o_orderdate < TIMESTAMP '{DT}'")
    q["tag_sql_params"] = (f"SELECT o_custkey AS uid, CAST(sum(CAST(o_totalprice AS DECIMAL(16,2))) AS DECIMAL(26,2)) "
                           f"AS query_value FROM orders WHERE o_orderdate < TIMESTAMP '{DT}' GROUP BY o_custkey")
    q["text_tsv_roundtrip"] = SEGMENT
    # tag computation
    q["tag_passthrough"] = order_count()
    q["tag_rule_case"] = SEGMENT
    q["tag_rule_join"] = SEGMENT
    q["tag_typed_values"] = order_amount()
    q["tag_multi_value"] = (f"SELECT uid, coalesce(string_agg(tag_value, ',' ORDER BY tag_value), '') AS tag_value "
                            f"FROM ({priority()}) GROUP BY uid")
    q["tag_compute"] = NATION
    q["tag_write_partition"] = (f"SELECT *, '1999-01-01' AS dt FROM ({order_count('1999-01-01')}) UNION ALL "
                                f"SELECT *, '{DT}' AS dt FROM ({order_count()})")
    q["tag_backfill"] = "\nUNION ALL\n".join(f"SELECT *, '{d}' AS dt FROM ({order_count(d)})" for d in (
        "1990-01-01", "1996-03-01", "1996-03-02", "1996-03-03", "1997-07-01", DT))
    q["date_token"] = "SELECT o_orderkey, strftime(o_orderdate, '%Y%m%d') AS dt_token FROM orders"
    q["date_to_epoch_ms"] = "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) * 1000 AS epoch_ms FROM orders"
    # merge
    q["tag_union_long"] = LONG
    q["wide_pivot"] = WIDE
    q["wide_pivot_preagg"] = WIDE
    q["wide_map"] = WIDE
    q["wide_write"] = WIDE
    q["wide_heavy_users"] = WIDE
    # bitmaps
    q["bitmap_unpivot"] = cells()
    q["bitmap_explode"] = cells()
    q["bitmap_build"] = bitmap_counts()
    q["bitmap_decode"] = f"SELECT tag_code, tag_value, CAST(uid AS BIGINT) AS uid FROM ({cells()})"
    q["bitmap_by_type"] = bitmap_counts([c for c, t in TYPES.items() if t == "3"])
    q["bitmap_write_partition"] = f"""SELECT m.value_type, c.tag_code, c.tag_value, CAST(count(*) AS BIGINT) AS users
      FROM ({cells()}) c JOIN (VALUES {type_rows}) AS m(tag_code, value_type) USING (tag_code)
      GROUP BY ALL"""
    q["bitmap_cardinality"] = (f"SELECT tag_code, tag_value, CAST(count(DISTINCT uid) AS BIGINT) AS users "
                               f"FROM ({cells()}) GROUP BY ALL")
    window = " UNION ALL ".join(f"SELECT * FROM ({cells([c for c, t in TYPES.items() if t in ('1', '3')], d)})"
                                for d in ("1996-01-01", "1998-01-01", DT))
    q["audience_window"] = (f"SELECT tag_code, tag_value, CAST(count(DISTINCT uid) AS BIGINT) AS users "
                            f"FROM ({window}) GROUP BY ALL")
    q["audience_and"] = audience("and")
    q["audience_or"] = audience("or")
    # export
    q["export_sorted"] = f"SELECT CAST(uid AS BIGINT) AS uid, * EXCLUDE (uid) FROM ({WIDE})"
    # ML
    q["encode_categories"] = ("SELECT o_orderkey, priority_code, status_code FROM "
                              f"({ML_FRAME})")
    q["string_index"] = f"SELECT o_orderkey, order_state, label_index FROM ({indexed('')})"
    q["assemble_features"] = (f"SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS f_price, "
                              f"CAST(order_month AS DOUBLE) AS f_month, CAST(priority_code AS DOUBLE) AS f_priority, "
                              f"CAST(status_code AS DOUBLE) AS f_status FROM ({ML_FRAME})")
    q["vector_index"] = (f"SELECT o_orderkey, CAST(o_totalprice AS DOUBLE) AS f_price, "
                         f"CAST(order_month AS DOUBLE) AS f_month, "
                         f"CAST(dense_rank() OVER (ORDER BY priority_code) - 1 AS DOUBLE) AS f_priority, "
                         f"CAST(dense_rank() OVER (ORDER BY status_code) - 1 AS DOUBLE) AS f_status "
                         f"FROM ({ML_FRAME})")
    q["dt_train_predict"] = f"SELECT o_orderkey, prediction FROM ({PREDICTED})"
    q["label_back"] = f"SELECT o_orderkey, prediction_origin FROM ({PREDICTED})"
    q["ml_split"] = f"SELECT o_orderkey, order_state, part FROM ({LABELLED})"
    q["tree_nodes"] = f"""SELECT feature, threshold, n_rows, round(impurity, 6) AS impurity, round(gain, 6) AS gain,
      prediction_origin FROM ({NODES})"""
    q["feature_importance"] = f"""SELECT f.feature, round(coalesce(gain * n_rows / (SELECT sum(gain * n_rows) FROM ({NODES})), 0.0), 6)
        AS importance
      FROM (VALUES ('o_totalprice'), ('order_month'), ('priority_code'), ('status_code')) AS f(feature)
      LEFT JOIN ({NODES}) n USING (feature)"""
    q["ml_hyper_parameters"] = "\nUNION ALL\n".join(
        f"SELECT '{name}' AS setting, o_orderkey, prediction_origin FROM ({predicted(region)})" for name, region in SETTINGS.items())
    q["ml_skipped_rows"] = f"""SELECT count(*) AS rows_in, count(*) FILTER (WHERE priority_code <> 15) AS rows_scored,
      count(*) FILTER (WHERE priority_code = 15) AS rows_skipped FROM ({LABELLED}) WHERE part = 'test'"""
    q["eval_accuracy"] = (f"SELECT avg(CASE WHEN prediction = label_index THEN 1.0 ELSE 0.0 END)::DOUBLE "
                          f"AS accuracy FROM ({PREDICTED})")
    q["eval_confusion"] = (f"SELECT label_index, prediction, CAST(count(*) AS BIGINT) AS n FROM ({PREDICTED}) "
                           f"GROUP BY ALL")
    q["eval_precision_recall"] = f"""WITH p AS ({PREDICTED}),
      t AS (SELECT label_index AS label, count(*) AS actual FROM p GROUP BY 1),
      g AS (SELECT prediction AS label, count(*) AS predicted FROM p GROUP BY 1),
      h AS (SELECT label_index AS label, count(*) AS tp FROM p WHERE label_index = prediction GROUP BY 1)
      SELECT t.label,
        CASE WHEN coalesce(g.predicted, 0) > 0 THEN coalesce(h.tp, 0) / g.predicted ELSE 0.0 END::DOUBLE AS precision,
        (coalesce(h.tp, 0) / t.actual)::DOUBLE AS recall
      FROM t LEFT JOIN g USING (label) LEFT JOIN h USING (label)"""
    q["model_roundtrip"] = f"SELECT o_orderkey, prediction FROM ({PREDICTED})"
    q["ml_end_to_end"] = f"SELECT o_orderkey, order_state, prediction_origin FROM ({PREDICTED})"
    return q


ORACLES = _sql()
