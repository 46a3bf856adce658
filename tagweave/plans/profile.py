"""The tag catalog used by the registered queries, the bench and the tests.

Nine tag tasks over ``customer``, ``orders`` and ``events`` covering all
four value types, rule mapping (string and numeric raw values, a duplicate
rule, a rule whose sub-tag is missing), multi-valued tags and an inactive
task.  Every multi-valued tag is bounded per user (distinct values of a small
domain), so no user's wide row grows with the event volume.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from tagweave.sources.catalog import Catalog, catalog_from_rows

BUSINESS_DATE = "2000-01-01"

TASKS = [
    dict(id=1, task_name="segment", task_status="1",
         task_sql="select c_custkey uid, c_mktsegment query_value from customer"),
    dict(id=2, task_name="order count", task_status="1",
         task_sql="select o_custkey uid, count(*) query_value from orders "
                  "where o_orderdate < '$dt' group by o_custkey"),
    dict(id=3, task_name="order amount", task_status="1",
         task_sql="select o_custkey uid, sum(cast(o_totalprice as decimal(16,2))) query_value "
                  "from orders where o_orderdate < '${dt}' group by o_custkey"),
    dict(id=4, task_name="last order", task_status="1",
         task_sql="select o_custkey uid, date_format(max(o_orderdate),'yyyy-MM-dd') query_value "
                  "from orders where o_orderdate < '$dt' group by o_custkey"),
    dict(id=5, task_name="priorities", task_status="1",
         task_sql="select distinct o_custkey uid, o_orderpriority query_value from orders "
                  "where o_orderdate < '$dt'"),
    dict(id=6, task_name="nation group", task_status="1",
         task_sql="select c_custkey uid, c_nationkey query_value from customer"),
    dict(id=7, task_name="switched off", task_status="0",
         task_sql="select c_custkey uid, 'x' query_value from customer"),
    dict(id=8, task_name="event count", task_status="1",
         task_sql="select user_id uid, count(*) query_value from events group by user_id"),
    dict(id=9, task_name="event types", task_status="1",
         task_sql="select distinct user_id uid, event_type query_value from events"),
]

TAGS = [
    dict(id=101, tag_code="TAG_BASE_SEGMENT", tag_name="segment", tag_level=1, tag_value_type="3", tag_task_id=1),
    dict(id=102, tag_code="TAG_ORDER_COUNT", tag_name="order count", tag_level=1, tag_value_type="1", tag_task_id=2),
    dict(id=103, tag_code="TAG_ORDER_AMOUNT", tag_name="order amount", tag_level=1, tag_value_type="2", tag_task_id=3),
    dict(id=104, tag_code="TAG_LAST_ORDER", tag_name="last order day", tag_level=1, tag_value_type="4", tag_task_id=4),
    dict(id=105, tag_code="TAG_PRIORITY", tag_name="order priorities", tag_level=1, tag_value_type="3", tag_task_id=5),
    dict(id=106, tag_code="TAG_NATION_GROUP", tag_name="nation group", tag_level=1, tag_value_type="1", tag_task_id=6),
    dict(id=107, tag_code="TAG_OFF", tag_name="inactive", tag_level=1, tag_value_type="3", tag_task_id=7),
    dict(id=108, tag_code="TAG_EVENT_COUNT", tag_name="events", tag_level=1, tag_value_type="1", tag_task_id=8),
    # the kinds of event a user produced (bounded by the number of event types)
    dict(id=109, tag_code="TAG_EVENT_TYPES", tag_name="event types", tag_level=1, tag_value_type="3",
         tag_task_id=9),
    # sub-tags: their tag_name is the value a rule maps to
    dict(id=201, tag_code="SEG_FURN", tag_name="Furn", tag_level=2, parent_tag_id=101, tag_value_type="3"),
    dict(id=202, tag_code="SEG_BUILD", tag_name="Build", tag_level=2, parent_tag_id=101, tag_value_type="3"),
    dict(id=203, tag_code="SEG_MACH", tag_name="Mach", tag_level=2, parent_tag_id=101, tag_value_type="3"),
    dict(id=204, tag_code="SEG_AUTO", tag_name="Auto", tag_level=2, parent_tag_id=101, tag_value_type="3"),
    dict(id=205, tag_code="SEG_FURN_2", tag_name="Furniture", tag_level=2, parent_tag_id=101, tag_value_type="3"),
    dict(id=206, tag_code="NAT_10", tag_name="10", tag_level=2, parent_tag_id=106, tag_value_type="1"),
    dict(id=207, tag_code="NAT_11", tag_name="11", tag_level=2, parent_tag_id=106, tag_value_type="1"),
    dict(id=208, tag_code="NAT_12", tag_name="12", tag_level=2, parent_tag_id=106, tag_value_type="1"),
]

RULES = [
    dict(id=1, tag_id=101, task_id=1, query_value="FURNITURE", sub_tag_id=201),
    dict(id=2, tag_id=101, task_id=1, query_value="BUILDING", sub_tag_id=202),
    dict(id=3, tag_id=101, task_id=1, query_value="MACHINERY", sub_tag_id=203),
    dict(id=4, tag_id=101, task_id=1, query_value="AUTOMOBILE", sub_tag_id=204),
    dict(id=5, tag_id=101, task_id=1, query_value="FURNITURE", sub_tag_id=205),  # loses to rule 1
    dict(id=6, tag_id=101, task_id=1, query_value="HOUSEHOLD", sub_tag_id=299),  # sub-tag missing
    dict(id=7, tag_id=106, task_id=6, query_value="0", sub_tag_id=206),
    dict(id=8, tag_id=106, task_id=6, query_value="1", sub_tag_id=207),
    dict(id=9, tag_id=106, task_id=6, query_value="2", sub_tag_id=208),
]


def demo_catalog(spark: SparkSession) -> Catalog:
    return catalog_from_rows(spark, TASKS, TAGS, RULES)


# ML frame over orders: text categories -> integer codes, label from status, month and priority.
PRIORITY_CODES = {"1-URGENT": 11, "2-HIGH": 12, "3-MEDIUM": 13, "4-NOT SPECIFIED": 14, "5-LOW": 15}
STATUS_CODES = {"F": 21, "O": 22, "P": 23}
FEATURES = ["o_totalprice", "order_month", "priority_code", "status_code"]
LABEL = "order_state"
LABELS = ["open", "closed", "late"]
