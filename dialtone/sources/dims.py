"""Fixed dimension and rule rows of the source system.

These are small, fixed tables (their size does not grow with the data),
so they are created with ``createDataFrame``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from dialtone import schemas
from dialtone.sources.tables import conform

# Dashboard event-counter rules, as
# (EventClass, EventType, EventCategory, WindowName, Count, FlushEnable,
#  UseSession, PersistSession, ThresholdEnable, ThresholdValue).
COUNTER_RULES = [
    ("DIALER", "CAMPAIGN", "DIALING", "CAMPAIGNDIALING", 1, True, True, False, False, 0),
    ("DIALER", "CAMPAIGN", "DISCONNECTING", "CAMPAIGNDIALING", -1, True, True, False, False, 0),
    ("DIALER", "CAMPAIGN", "DISCONNECTED", "CAMPAIGNCONNECTED", -1, True, True, False, False, 0),
    ("DIALER", "CAMPAIGN", "CONNECTED", "CAMPAIGNCONNECTED", 1, True, True, False, False, 0),
    ("DIALER", "CAMPAIGN", "NUMBERADDED", "CAMPAIGNNUMBERSTAKEN", 1, True, True, False, False, 0),
    ("DIALER", "CAMPAIGN", "REJECTED", "CAMPAIGNREJECTED", 1, True, False, False, False, 0),
]

# Which counters each dashboard window publishes, as (WindowName, EventName).
PUBLISH_META = [
    ("CAMPAIGNCONNECTED", "TotalCount"),
    ("CAMPAIGNDIALING", "TotalCount"),
    ("CAMPAIGNNUMBERSTAKEN", "TotalCount"),
    ("CAMPAIGNCONNECTED", "CurrentCount"),
    ("CAMPAIGNDIALING", "CurrentCount"),
    ("CAMPAIGNREJECTED", "TotalCount"),
]


def counter_rules(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTER_RULES, schemas.COUNTER_RULES)


def publish_meta(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PUBLISH_META, schemas.PUBLISH_META)


# ITU-T Q.850 hangup causes with their SIP response equivalents,
# as (ItutQ850Code, SipEquiv, Enumeration, Cause). The free-text descriptions
# of the source rows are not carried (no report reads them).
HANGUP_CAUSES = [
    (0, None, "UNSPECIFIED", "Unspecified. No other cause codes applicable."),
    (1, 404, "UNALLOCATED_NUMBER", "Unallocated (unassigned) number [Q.850 value 1]"),
    (2, 404, "NO_ROUTE_TRANSIT_NET", "No route to specified transit network (national use) [Q.850]"),
    (3, 404, "NO_ROUTE_DESTINATION", "No route to destination [Q.850]"),
    (6, None, "CHANNEL_UNACCEPTABLE", "channel unacceptable [Q.850]"),
    (7, None, "CALL_AWARDED_DELIVERED", "call awarded"),
    (16, None, "NORMAL_CLEARING", "normal call clearing [Q.850]"),
    (17, 486, "USER_BUSY", "user busy [Q.850]"),
    (18, 408, "NO_USER_RESPONSE", "no user responding [Q.850]"),
    (19, 480, "NO_ANSWER", "no answer from user (user alerted) [Q.850]"),
    (20, 480, "SUBSCRIBER_ABSENT", "subscriber absent [Q.850]"),
    (21, 603, "CALL_REJECTED", "call rejected [Q.850]"),
    (22, 410, "NUMBER_CHANGED", "number changed [Q.850]"),
    (23, 410, "REDIRECTION_TO_NEW_DESTINATION", " "),
    (25, 483, "EXCHANGE_ROUTING_ERROR", " "),
    (27, 502, "DESTINATION_OUT_OF_ORDER", "destination out of order [Q.850]"),
    (28, 484, "INVALID_NUMBER_FORMAT", "invalid number format (address incomplete) [Q.850]"),
    (29, 501, "FACILITY_REJECTED", "facilities rejected [Q.850]"),
    (30, None, "RESPONSE_TO_STATUS_ENQUIRY", "response to STATUS INQUIRY [Q.850]"),
    (31, 480, "NORMAL_UNSPECIFIED", "normal"),
    (34, 503, "NORMAL_CIRCUIT_CONGESTION", "no circuit/channel available [Q.850]"),
    (38, 503, "NETWORK_OUT_OF_ORDER", "network out of order [Q.850]"),
    (41, 503, "NORMAL_TEMPORARY_FAILURE", "temporary failure [Q.850]"),
    (42, 503, "SWITCH_CONGESTION", "switching equipment congestion [Q.850]"),
    (43, None, "ACCESS_INFO_DISCARDED", "access information discarded [Q.850]"),
    (44, 503, "REQUESTED_CHAN_UNAVAIL", "requested circuit/channel not available [Q.850]"),
    (45, None, "PRE_EMPTED", " "),
    (47, None, " ", "resource unavailable"),
    (50, None, "FACILITY_NOT_SUBSCRIBED", "requested facility not subscribed [Q.850"),
    (52, 403, "OUTGOING_CALL_BARRED", "outgoing calls barred"),
    (54, 403, "INCOMING_CALL_BARRED", "incoming calls barred"),
    (57, 403, "BEARERCAPABILITY_NOTAUTH", "bearer capability not authorized [Q.850]"),
    (58, 503, "BEARERCAPABILITY_NOTAVAIL", "bearer capability not presently available [Q.850]"),
    (63, None, "SERVICE_UNAVAILABLE", "service or option not available"),
    (65, 488, "BEARERCAPABILITY_NOTIMPL", "bearer capability not implemented [Q.850]"),
    (66, None, "CHAN_NOT_IMPLEMENTED", "channel type not implemented [Q.850]"),
    (69, 501, "FACILITY_NOT_IMPLEMENTED", "requested facility not implemented [Q.850]"),
    (79, 501, "SERVICE_NOT_IMPLEMENTED", "service or option not implemented"),
    (81, None, "INVALID_CALL_REFERENCE", "invalid call reference value [Q.850]"),
    (88, 488, "INCOMPATIBLE_DESTINATION", "incompatible destination [Q.850]"),
    (95, None, "INVALID_MSG_UNSPECIFIED", "invalid message"),
    (96, None, "MANDATORY_IE_MISSING", "mandatory information element is missing [Q.850]"),
    (97, None, "MESSAGE_TYPE_NONEXIST", "message type non-existent or not implemented [Q.850]"),
    (98, None, "WRONG_MESSAGE", "message not compatible with call state or message type non-existent or not implemented. [Q.850]"),
    (99, None, "IE_NONEXIST", "Information element / parameter non-existent or not implemented [Q.850]"),
    (100, None, "INVALID_IE_CONTENTS", "Invalid information element contents [Q.850]"),
    (101, None, "WRONG_CALL_STATE", "message not compatible with call state [Q.850]"),
    (102, 504, "RECOVERY_ON_TIMER_EXPIRE", "recovery on timer expiry [Q.850]"),
    (103, None, "MANDATORY_IE_LENGTH_ERROR", "parameter non-existent or not implemented - passed on (national use) [Q.850]"),
    (111, None, "PROTOCOL_ERROR", "protocol error"),
    (127, None, "INTERWORKING", "Interworking"),
    (487, 487, "ORIGINATOR_CANCEL", " "),
    (500, None, "CRASH", " "),
    (501, None, "SYSTEM_SHUTDOWN", " "),
    (502, None, "LOSE_RACE", " "),
    (503, None, "MANAGER_REQUEST", " "),
    (600, None, "BLIND_TRANSFER", " "),
    (601, None, "ATTENDED_TRANSFER", " "),
    (602, None, "ALLOTTED_TIMEOUT", " "),
    (603, None, "USER_CHALLENGE", " "),
    (604, None, "MEDIA_TIMEOUT", " "),
    (605, None, "PICKED_OFF", " "),
    (606, None, "USER_NOT_REGISTERED", " "),
    (607, None, "PROGRESS_TIMEOUT", " "),
    (609, None, "GATEWAY_DOWN", " "),
]


def hangup_causes(spark: SparkSession) -> DataFrame:
    """The hangup-cause lookup (65 rows)."""
    return spark.createDataFrame(HANGUP_CAUSES, schemas.HANGUP_CAUSES)


def read_hangup_causes(spark: SparkSession, path: str) -> DataFrame:
    """A user's own hangup-cause table, with descriptions."""
    return conform(spark.read.parquet(path), schemas.HANGUP_CAUSE_TABLE)
