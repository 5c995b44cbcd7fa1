"""Labels, patterns and names that the input data and the reports are bound to."""

# audit log
LOAD_ENTITY_TYPES = ("Load", "Shipment")
RESPONSE_WORKFLOW = "shipment_update"
NOTIFIER_WORKFLOW = "notifier"
READY_TO_PICKUP_WORKFLOW = "ready_to_pickup"
SCAC_FETCHED_ACTION = "FETCHED_CARRIER_SCAC"
DETAILS_EXTRACTED_ACTION = "DETAILS_EXTRACTED"
UPDATED_ACTION_LIKE = "%_UPDATED%"  # LIKE: the underscore stands for any one character
RAW_MESSAGE_LIKE = "%Raw message%"

# optional partition column of both logs: the date of created_at
DAY_COLUMN = "created_date"

# alert text inside trigger comments
ALERT_LABEL = "FourKites Alert:"
LOAD_PREFIX_PATTERN = r"(?U)Load #\d+:?[\s\x1c-\x1f]*"
# a set of characters (backslash, r, n, closing bracket), not line ends: "return" becomes "retu"
TAIL_CHARACTERS_PATTERN = r"(?d)[\\r\\n)]+$"

# milestones
MILESTONE_ENTITY_TYPE = "Load"
RESPONSE_RECEIVED_STATUS = "response_received"
ESCALATION_SENT_STATUS = "escalation_l2_sent"
ESCALATION_TEXT = "Escalation triggered"
FLAG_YES = "Y"
FOLLOW_UP_WINDOW_SECONDS = 120

# report status
AWAITING_STATUS = "AWAITING_RESPONSE"
FAILED_STATUS = "SKIPPED/INVALID_RESPONSE/FAILED"
SUCCESS_STATUS = "SUCCESS"
TRIGGER_SKIPPED_STATUS = "TRIGGER_SKIPPED"
ACTION_SEPARATOR = "; "

# notes of the ready-to-pickup report
UPDATED_ACTION_TEXT = "_UPDATED"  # contains: here the underscore is literal
NOTE_NOT_SENT = "Email not sent"
NOTE_AWAITING = "Email sent and awaiting response"
NOTE_PROCESSED = "Email sent and response processed"
NOTE_NOT_PROCESSED = "Email sent and response not processed"

# carrier lookup
LOOKUP_BATCH_SIZE = 10

# holdover sheets and mail
PLANT_LABEL = "PLANT:"
HEADER_LABEL = "SHIPMENT NUMBER"
MAIL_SEARCH_TERMS = ("holdover", "hold over")
NO_SUBJECT = "No Subject"
RECEIVED_DATE_FORMAT = "dd:MM:yyyy"
# years of more than four digits carry a sign; there is no year -0
WRITTEN_TIMESTAMP_PATTERN = (
    r"\A([0-9]{4}|\+[0-9]{5,6}|-(?!0+-)[0-9]{4,6})-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,6})?\z"
)
INTEGER_PATTERN = r"^\s*[+-]?[0-9]+\s*$"

SHEET_COLUMNS = (
    "Load Number",
    "CARRIER",
    "CONTAINER ID",
    "DESTINATION CITY",
    "DESTINATION STATE",
    "DD DATE",
    "DD TIME",
    "BILL DATE",
    "BILL TIME",
    "ZDLT LATE CODE",
    "ON TIME? (Y/N)",
    "SPLIT? (Y/N)",
    "FRESH PRIORITY STO? (Y/N)",
    "NOTES/COMMENTS",
)

# report headings
REPORT_HEADINGS = {
    "workflow": "Workflow",
    "workflow_exec_id": "Workflow Execution Id",
    "shipper_id": "Shipper",
    "scac": "Carrier SCAC",
    "load_id": "Load Number",
    "trigger_message": "Trigger Message",
    "response_message": "Response Message",
    "trigger_timestamp": "Triggered At",
    "followup_sent_at": "Followup Sent At",
    "response_timestamp": "Response At",
    "actions": "Update Actions",
    "status": "Status",
    "reminder": "Reminder",
    "escalated": "Escalated",
}
# "Carrier" differs from the sheet's "CARRIER" only in case, so it keeps its own name until the CSV sink
CARRIER_COLUMN = "carrier_name"
CARRIER_HEADING = "Carrier"
DELAY_HEADING = "Response Delay (mins)"
FACILITY_COLUMN = "FACILITY"
RECEIVED_COLUMN = "DATE"

NOTIFIER_COLUMNS = (
    "Workflow",
    "Workflow Execution Id",
    "Shipper",
    "carrier_name",
    "Carrier SCAC",
    "Load Number",
    "Trigger Message",
    "Response Message",
    "Triggered At",
    "Followup Sent At",
    "Response At",
    "Response Delay (mins)",
    "Update Actions",
    "Status",
    "Reminder",
    "Escalated",
)
READY_TO_PICKUP_COLUMNS = (
    FACILITY_COLUMN,
    RECEIVED_COLUMN,
    *SHEET_COLUMNS,
    "Workflow",
    "Workflow Execution Id",
    "Shipper",
    "carrier_name",
    "Carrier SCAC",
    "Trigger Message",
    "Response Message",
    "Triggered At",
    "Followup Sent At",
    "Response At",
    "Response Delay (mins)",
    "Update Actions",
    "Status",
    "Reminder",
    "Escalated",
)

MASTER_TABLE = "master data"
