"""

Schemas are always given explicitly, never inferred. Timestamps of the reference are epoch
milliseconds (``bigint``); ``functions.time.ms_to_ts`` derives the event-time column.
"""

EVENT = "user string, url string, timestamp bigint"
URL_VIEW_COUNT = "url string, count bigint, window_start timestamp, window_end timestamp"
LOGIN_EVENT = "user_id string, host string, event_type string, ts bigint"
ORDER_EVENT = "user_id string, order_id string, event_type string, ts bigint"
ACTION = "user_id string, action string, seq bigint"
PATTERN = "action1 string, action2 string, version int"
APP_PAYMENT = "order_id string, source string, ts bigint"
THIRD_PARTY_PAYMENT = "order_id string, platform string, status string, ts bigint"
KEYED_TIME = "k string, ts bigint"
TAGGED_TIME = "k string, stream string, ts bigint"
WORD_COUNT = "word string, count bigint"
CLICK_TABLE = "user_name string, url string, ts bigint"
