"""Report inputs derived from the given tables, whole tables every time.

The SQL in the constants is plain enough for Spark and DuckDB alike, so both engines see the same
rows; the operators under test are written twice, here only the raw material is shared. Loads and
files grow in number with the tables. FIXTURES.md lists the rules.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtrail import constants as c
from loadtrail.params import ReportParams

SHIPPER = "shipper-a"
START, END = "2024-01-02", "2024-01-29"
# the limits of a task are small, so that the hot load is split in the small tables as well
LIMITS = {"pairs_per_split": 2_000, "rows_per_split": 500}
NOTIFIER = replace(ReportParams.notifier(SHIPPER, START, END), **LIMITS)
READY_TO_PICKUP = replace(ReportParams.ready_to_pickup(SHIPPER, START, END), **LIMITS)
HOT_LOAD = "1"

# ten events make a request, forty requests share sixteen loads; every 32nd request belongs to load 1, whose share
# of the log stays the same as the log grows
AUDIT_LOG_SQL = f"""
SELECT
  CASE WHEN value < 0.3 THEN NULL
       WHEN floor(event_id / 10) % 32 = 5 THEN '{HOT_LOAD}'
       ELSE CAST(CAST(floor(event_id / 400) AS BIGINT) * 16
                 + (CAST(floor(event_id / 10) AS BIGINT) % 8) * 2 + event_id % 2 AS STRING) END AS entity_id,
  CASE WHEN event_id % 97 = 0 THEN NULL
       ELSE 'req-' || CAST(CAST(floor(event_id / 10) AS BIGINT) AS STRING) END AS request_id,
  CASE WHEN event_id % 11 = 0 THEN 'Order' WHEN event_id % 3 = 0 THEN 'Shipment' ELSE 'Load' END AS entity_type,
  CASE WHEN floor(event_id / 10) % 4 = 0 THEN 'shipper-b' ELSE '{SHIPPER}' END AS shipper_id,
  CASE WHEN event_type = 'purchase' THEN '{c.READY_TO_PICKUP_WORKFLOW}'
       WHEN event_type IN ('click', 'view') THEN '{c.NOTIFIER_WORKFLOW}'
       ELSE '{c.RESPONSE_WORKFLOW}' END AS workflow_identifier,
  CASE WHEN event_type IN ('error', 'signup') THEN
         CASE WHEN event_id % 5 = 0 THEN 'ETA_UPDATED'
              WHEN event_id % 5 IN (1, 3) THEN '{c.DETAILS_EXTRACTED_ACTION}'
              WHEN event_id % 5 = 2 THEN 'VALIDATED'
              WHEN event_id % 3 = 0 THEN 'xUPDATED'
              ELSE 'UPDATED' END
       WHEN event_id % 3 = 0 THEN 'TRIGGERED'
       ELSE '{c.SCAC_FETCHED_ACTION}' END AS action,
  CASE WHEN event_type IN ('error', 'signup') THEN
         CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'Raw message: eta ' || CAST(event_id AS STRING)
              || CASE WHEN event_id % 7 = 1 THEN chr(10) || '"on time", he said' ELSE '' END END
       WHEN event_id % 5 = 0 THEN NULL
       WHEN event_id % 5 = 1 THEN 'scac fetched'
       WHEN event_id % 5 = 2 THEN 'seen' || chr(10) || '{c.ALERT_LABEL}  Load #' || CAST(event_id AS STRING)
              || ' late, please return)' || chr(10) || 'second line'
       ELSE 'Load #' || CAST(event_id AS STRING) || ': {c.ALERT_LABEL} late '
              || CAST(event_id % 60 AS STRING) || ' min' END AS comment,
  ts AS created_at
FROM events
"""

MILESTONES_SQL = f"""
SELECT
  entity_id,
  shipper_id,
  CASE WHEN event_id % 7 = 0 THEN '{c.ESCALATION_SENT_STATUS}'
       WHEN event_id % 7 IN (1, 2) THEN '{c.RESPONSE_RECEIVED_STATUS}'
       ELSE 'followup_sent' END AS status,
  CASE WHEN event_id % 5 = 0 THEN NULL
       WHEN event_id % 2 = 0 THEN '{c.ESCALATION_TEXT} for load'
       ELSE 'ok' END AS comments,
  ts + CASE WHEN event_id % 9 = 0 THEN INTERVAL '-30' SECOND
            WHEN event_id % 9 = 1 THEN INTERVAL '0' SECOND
            WHEN event_id % 9 = 2 THEN INTERVAL '122' SECOND
            WHEN event_id % 9 = 3 THEN INTERVAL '600' SECOND
            WHEN event_id % 9 IN (4, 5) THEN INTERVAL '120' SECOND
            ELSE INTERVAL '45' SECOND END AS created_at,
  CASE WHEN event_id % 13 = 0 OR (value >= 0.2 AND value < 35) THEN 'Stop'
       ELSE '{c.MILESTONE_ENTITY_TYPE}' END AS entity_type,
  CASE WHEN event_type = 'purchase' THEN '{c.READY_TO_PICKUP_WORKFLOW}'
       WHEN event_type IN ('click', 'view') THEN '{c.NOTIFIER_WORKFLOW}'
       ELSE '{c.RESPONSE_WORKFLOW}' END AS workflow_id
FROM (SELECT e.*,
        CASE WHEN value < 0.3 THEN NULL
             WHEN floor(event_id / 10) % 32 = 5 THEN '{HOT_LOAD}'
             ELSE CAST(CAST(floor(event_id / 400) AS BIGINT) * 16
                       + (CAST(floor(event_id / 10) AS BIGINT) % 8) * 2 + event_id % 2 AS STRING) END AS entity_id,
        CASE WHEN floor(event_id / 10) % 4 = 0 THEN 'shipper-b' ELSE '{SHIPPER}' END AS shipper_id
      FROM events e) all_events
"""

# one payload per supplier with two loads; neighbouring suppliers repeat a load
CARRIER_PAYLOAD_SQL = """
SELECT
  '{"loads":[{"loadNumber":"' || CAST(s_suppkey * 2 AS STRING) || '","carrier":{"name":"' || s_name
    || '","id":"SC' || CAST(s_nationkey AS STRING) || '"}},{"loadNumber":"' || CAST(s_suppkey * 2 + 2 AS STRING)
    || CASE WHEN s_acctbal < 0 THEN '"}]}' ELSE '","carrier":{"name":"' || s_name || ' early"}}]}' END AS body,
  s_suppkey AS arrival_order
FROM supplier
"""

# one sheet per order date and 60,000 order keys; the origin of label and header moves with the day of the month
SHEET_SQL = """
SELECT DISTINCT
  'sheet_' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '_'
    || CAST(CAST(floor(o_orderkey / 60000) AS BIGINT) AS STRING) || '.xlsx' AS file_name,
  CAST(extract(DAY FROM o_orderdate) AS INT) AS d
FROM orders
"""

ORDER_LINE_SQL = """
SELECT
  'sheet_' || CAST(CAST(o_orderdate AS DATE) AS STRING) || '_'
    || CAST(CAST(floor(o_orderkey / 60000) AS BIGINT) AS STRING) || '.xlsx' AS file_name,
  CAST(5 + CAST(extract(DAY FROM o_orderdate) AS INT) % 3 + o_orderkey % 60000 AS INT) AS row_idx,
  CASE WHEN o_totalprice < 10000 THEN 'TOTAL'
       WHEN o_totalprice < 20000 THEN '12.5'
       WHEN o_totalprice < 30000 THEN NULL
       WHEN o_totalprice < 40000 THEN '99999999999999999999'
       WHEN o_totalprice < 60000 THEN ' +' || CAST(CAST(floor(o_orderkey / 30) AS BIGINT) AS STRING) || ' '
       ELSE CAST(CAST(floor(o_orderkey / 30) AS BIGINT) AS STRING) END AS first_cell,
  'C' || CAST(o_custkey AS STRING) AS customer,
  o_orderstatus AS order_status,
  o_orderpriority AS order_priority
FROM orders
"""

# two parts per turn of a conversation: an attachment and an inline part without a file name
MAIL_SQL = """
SELECT
  CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING) AS message_id,
  1704067200000 + (conv_id % 60) * 43200000 + turn * 60000 AS internal_date,
  CASE WHEN conv_id % 3 = 0 THEN 'Daily HoldOver list'
       WHEN conv_id % 3 = 1 THEN 'Hold over, plant' ELSE 'Invoice' END AS subject,
  role,
  text AS turn_text,
  'sheet_' || CAST(CAST(DATE '1992-01-01' + CAST((conv_id * 7) % 2400 AS INT) AS DATE) AS STRING) || '_'
    || CAST(CAST(floor(conv_id / 2400) AS BIGINT) AS STRING) || '.xlsx' AS attachment_name,
  CASE WHEN turn % 2 = 0 THEN 'att-' || CAST(conv_id AS STRING) END AS attachment_id
FROM conversations
"""


@dataclass(frozen=True, eq=False)
class Tables:
    """The given tables of one folder, and the report inputs derived from them."""

    spark: SparkSession
    folder: str

    def given(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _derive(self, sql: str, table: str) -> DataFrame:
        return self.spark.sql(sql.replace("{", "{{").replace("}", "}}").replace(f"FROM {table}", f"FROM {{{table}}}"),
                              **{table: self.given(table)})

    @cached_property
    def log(self) -> DataFrame:
        return self._derive(AUDIT_LOG_SQL, "events")

    @cached_property
    def milestones(self) -> DataFrame:
        return self._derive(MILESTONES_SQL, "events")

    @cached_property
    def carrier_payload(self) -> DataFrame:
        return self._derive(CARRIER_PAYLOAD_SQL, "supplier")

    @cached_property
    def cells(self) -> DataFrame:
        sheets, lines = self._derive(SHEET_SQL, "orders"), self._derive(ORDER_LINE_SQL, "orders")

        def cell(row, column, value):
            return F.struct(
                row.cast("int").alias("row_idx"),
                column.cast("int").alias("col_idx"),
                value.cast("string").alias("cell_value"),
            )

        day = F.col("d")
        label_row, label_column, header_row = day % 3, day % 2 + 1, day % 3 + 4
        anchors = [
            cell(F.lit(0), F.lit(0), F.lit("Holdover report")),
            cell(label_row, label_column, F.lit(c.PLANT_LABEL)),
            cell(label_row, label_column + 1, F.concat(F.lit("Plant "), day.cast("string"))),
            # a second label below the first must not win, nor a second header
            cell(label_row + 1, F.lit(1), F.lit(c.PLANT_LABEL)),
            cell(label_row + 1, F.lit(2), F.lit("elsewhere")),
            cell(header_row - 1, F.lit(0), F.lit("77")),
            cell(header_row, F.lit(0), F.lit(c.HEADER_LABEL)),
            cell(header_row, F.lit(1), F.lit("CARRIER")),
            cell(F.lit(2_000_000_000), F.lit(0), F.lit(c.HEADER_LABEL)),
        ]
        filler = ", ".join(f"concat('v{position} ', order_status)" for position in range(4, 14))
        values = f"posexplode(array(first_cell, customer, order_status, order_priority, {filler}))"
        return sheets.select("file_name", F.inline(F.array(*anchors))).union(
            lines.selectExpr("file_name", "row_idx", f"{values} AS (col_idx, cell_value)")
        )

    @cached_property
    def mail(self) -> DataFrame:
        part = lambda name, attachment, data: F.struct(
            name.alias("filename"), attachment.alias("attachment_id"), data.alias("data")
        )
        encoded = F.translate(F.base64(F.encode("turn_text", "UTF-8")), "+/", "-_")
        header = lambda name, value: F.struct(F.lit(name).alias("name"), value.alias("value"))
        sender = header("From", F.col("role"))
        return self._derive(MAIL_SQL, "conversations").select(
            "message_id",
            "internal_date",
            F.concat("subject", F.lit(" "), "turn_text").alias("text"),
            F.when(F.col("role") == "user", F.array(sender, header("Subject", F.col("subject"))))
            .otherwise(F.array(sender))
            .alias("headers"),
            F.array(
                part(F.lit(""), F.lit(None).cast("string"), F.lit(None).cast("string")),
                part(F.col("attachment_name"), F.col("attachment_id"), encoded),
            ).alias("parts"),
        )
