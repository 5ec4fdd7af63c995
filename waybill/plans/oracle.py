"""The registered queries as DuckDB SQL over the same tables.

Written independently of the Spark plans: the life cycle and the late-data rule
are plain window functions in arrival order here.
"""

from __future__ import annotations

_ARRIVAL = "scanned_at, line, part, supplier, quantity, price"

_ORDERS_TO = """orders_to AS (
  SELECT o_orderkey, o_orderstatus, o_orderdate, o_orderpriority, c_name, n_name AS destination, r_name AS origin
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_SCANS = _ORDERS_TO + """, scans AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS shipment_id, l_shipdate AS scanned_at, l_linenumber AS line,
         l_partkey AS part, l_suppkey AS supplier, l_quantity AS quantity, l_extendedprice AS price,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS correlation_id,
         CASE WHEN l_partkey % 2 = 0 THEN lower(n_name) ELSE n_name END AS location,
         destination
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN orders_to ON l_orderkey = o_orderkey)"""

_REPLAY = _SCANS + f""", first_seen AS (
  SELECT *, row_number() OVER w AS seq,
         first_value(destination) OVER w AS first_destination, first_value(scanned_at) OVER w AS created_at
  FROM scans WINDOW w AS (PARTITION BY shipment_id ORDER BY {_ARRIVAL})),
replay AS (
  SELECT shipment_id, seq, location, first_destination AS destination, scanned_at, created_at, correlation_id,
         lower(location) = lower(first_destination) AS delivered,
         max(CASE WHEN lower(location) = lower(first_destination) THEN scanned_at END) OVER w AS delivered_at,
         CASE WHEN bool_or(lower(location) = lower(first_destination)) OVER w THEN 'DELIVERED' ELSE 'IN_TRANSIT' END AS status
  FROM first_seen WINDOW w AS (PARTITION BY shipment_id ORDER BY seq)),
delivered AS (
  SELECT shipment_id, destination, location, scanned_at AS delivered_at, correlation_id, seq
  FROM replay WHERE delivered),
state AS (
  SELECT shipment_id, destination, location AS last_location, created_at, scanned_at AS last_scanned_at,
         delivered_at, status
  FROM replay QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY seq DESC) = 1)"""

_REQUESTS = """delivery_requests AS (
  SELECT 'deliver-' || o_orderkey AS request_id, o_orderdate + INTERVAL 30 DAY AS requested_at,
         o_orderkey % 17 = 0 AS absent,
         CASE WHEN o_orderkey % 11 = 0 THEN ' ' ELSE CAST(o_orderkey AS VARCHAR) END AS asked_id,
         CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE destination END AS asked_location
  FROM orders_to WHERE o_orderstatus = 'F'),
answered AS (
  SELECT request_id, requested_at, asked_id, asked_location, destination,
         CASE WHEN absent THEN 'Request must not be null'
              WHEN trim(asked_id) = '' THEN 'shipmentId must not be null or empty'
              WHEN trim(asked_location) = '' THEN 'location must not be null or empty'
              WHEN shipment_id IS NULL THEN 'Shipment not found: ' || asked_id END AS error_message
  FROM delivery_requests LEFT JOIN state ON shipment_id = asked_id),
marked AS (
  SELECT request_id,
         CASE WHEN error_message IS NULL THEN asked_id END AS shipment_id,
         error_message IS NULL AS success,
         CASE WHEN error_message IS NULL THEN 'DELIVERED' END AS status,
         CASE WHEN error_message IS NULL THEN asked_location END AS location,
         CASE WHEN error_message IS NULL THEN destination END AS destination,
         CASE WHEN error_message IS NULL THEN requested_at END AS delivered_at,
         error_message
  FROM answered)"""

_CREATED = """created AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS shipment_id, destination, o_orderdate AS created_at, o_orderkey,
         'create-' || o_orderkey AS correlation_id,
         concat_ws(':', 'shipment-created', o_orderkey % 3, o_orderkey // 3) AS record_id
  FROM orders_to)"""

_RECREATED = """recreated AS (
  SELECT CAST(o_orderkey AS VARCHAR) AS shipment_id, destination, o_orderdate AS created_at FROM orders_to
  UNION ALL
  SELECT CAST(o_orderkey AS VARCHAR), 'NEW_' || destination, o_orderdate + INTERVAL 200 DAY
  FROM orders_to WHERE o_orderkey % 10 = 0)"""

_SCAN_REQUESTS = _ORDERS_TO + ", " + _RECREATED + """, scan_requests AS (
  SELECT CASE WHEN l_linenumber = 5 AND l_partkey % 2 = 0 THEN NULL
              WHEN l_partkey % 50 = 1 THEN 'X-' || l_orderkey
              WHEN l_partkey % 50 = 2 THEN '  '
              ELSE CAST(l_orderkey AS VARCHAR) END AS shipment_id,
         CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber = 7 THEN '  ' ELSE n_name END AS location,
         l_shipdate AS scanned_at, l_linenumber AS line, l_partkey AS part, l_suppkey AS supplier,
         l_quantity AS quantity, l_extendedprice AS price,
         concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS request_id
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey),
checked AS (
  SELECT r.*,
         CASE WHEN r.shipment_id IS NULL THEN 'Shipment ID cannot be null'
              WHEN location IS NULL THEN 'Location cannot be null'
              WHEN trim(location) = '' THEN 'Location cannot be empty' END AS invalid,
         c.created_at AS known_since, c.destination
  FROM scan_requests r ASOF LEFT JOIN recreated c
    ON r.shipment_id = c.shipment_id AND r.scanned_at >= c.created_at),
results AS (
  SELECT *, coalesce(invalid, CASE WHEN known_since IS NULL
              THEN 'Shipment with ID ' || shipment_id || ' not found.' END) AS error_message
  FROM checked)"""

_HOURLY = """hourly AS (
  SELECT event_type AS location, date_trunc('hour', ts) AS window_start,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end, count(*) AS count
  FROM events GROUP BY ALL)"""

_LATE = """arriving AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS shipment_id, event_type AS location, ts AS delivered_at,
         ts + to_minutes(event_id * 37 % 180) AS arrival, date_trunc('hour', ts) AS window_start,
         date_trunc('hour', ts) + INTERVAL 1 HOUR AS window_end
  FROM events),
clocked AS (
  SELECT *, max(delivered_at) OVER ({scope} ORDER BY arrival, event_id ROWS UNBOUNDED PRECEDING) AS clock
  FROM arriving)"""

_NOTES = _REPLAY + ", " + _CREATED + """, notes AS (
  SELECT sha256(record_id) AS id, shipment_id, 'SHIPMENT_CREATED' AS type,
         'Shipment ' || shipment_id || ' has been created and is being prepared for transport to ' || destination || '.' AS message,
         created_at AS timestamp
  FROM created
  UNION ALL
  SELECT sha256('shipment-scanned:' || replace(correlation_id, '-', ':')), shipment_id, 'SHIPMENT_SCANNED',
         'Shipment ' || shipment_id || ' has been scanned at ' || location || '. Current destination: ' || destination || '.',
         scanned_at
  FROM scans
  UNION ALL
  SELECT sha256('shipment-delivered:' || correlation_id), shipment_id, 'SHIPMENT_DELIVERED',
         'Shipment ' || shipment_id || ' has been successfully delivered to ' || location || '.',
         delivered_at
  FROM delivered)"""

_DELETIONS = """deletions AS (
  SELECT o_orderkey * 2 + again AS request_id,
         CASE WHEN o_orderkey % 7 = 0 THEN ' '
              WHEN o_orderkey % 5 = 0 THEN 'gone-' || o_orderkey
              ELSE ' ' || sha256(concat_ws(':', 'shipment-created', o_orderkey % 3, o_orderkey // 3)) END AS id
  FROM orders, (VALUES (0), (1)) AS t(again) WHERE again = 0 OR o_orderkey % 9 = 0)"""

_WEBHOOK = _REPLAY + ", " + _CREATED + """, webhook AS (
  SELECT *, 'serverless-' || timestamp AS "correlationId" FROM (
    SELECT 'shipment-created' AS "eventType", shipment_id AS "shipmentId",
           'CUSTOMER-' || right(shipment_id, 3) AS "customerId", CAST(NULL AS VARCHAR) AS origin, destination,
           epoch_ms(created_at) AS timestamp FROM created
    UNION ALL
    SELECT 'shipment-scanned', shipment_id, 'CUSTOMER-' || right(shipment_id, 3), location, destination,
           epoch_ms(scanned_at) FROM scans
    UNION ALL
    SELECT 'shipment-delivered', shipment_id, 'CUSTOMER-' || right(shipment_id, 3), NULL, location,
           epoch_ms(delivered_at) FROM delivered))"""


def _iso(column: str) -> str:
    """ISO text; the order tables' dates have no fraction."""
    return f"strftime({column}, '%Y-%m-%dT%H:%M:%S')"


def _array(column: str) -> str:
    """Number array of a full hour."""
    return "'[' || " + " || ',' || ".join(
        f"date_part('{part}', {column})" for part in ("year", "month", "day", "hour", "minute")
    ) + " || ']'"


def _json(**fields: str) -> str:
    """JSON text of non-null fields given as SQL text expressions."""
    return "'{' || " + " || ',' || ".join(f"'\"{k}\":' || {v}" for k, v in fields.items()) + " || '}'"


def _quoted(expression: str) -> str:
    return f"'\"' || {expression} || '\"'"


def _event(event_type: str, time: str, correlation: str) -> dict[str, str]:
    return {
        "correlationId": _quoted(correlation),
        "timestamp": _quoted(_iso(time) + " || 'Z'"),
        "version": _quoted("'v1'"),
        "eventType": _quoted(f"'{event_type}'"),
    }


_STATE_COLUMNS = "shipment_id, destination, last_location, created_at, last_scanned_at, delivered_at, status"
_RESPONSE = (
    "shipment_id, status, last_location AS location, delivered_at, true AS success, "
    "CAST(NULL AS VARCHAR) AS error_message"
)

_CREATE_ERROR = """CASE WHEN o_orderkey % 7 = 0 THEN 'Origin must not be blank'
    WHEN o_orderkey % 5 = 0 THEN 'Destination must not be blank'
    WHEN o_orderkey % 3 = 0 THEN 'CustomerId must not be blank' END"""

_BODY = """CASE "eventType2"
    WHEN 'shipment-scanned' THEN {scanned}
    WHEN 'shipment-delivered' THEN {delivered}
    ELSE {created} END"""


def _text(created: str, scanned: str, delivered: str) -> str:
    return _BODY.format(created=created, scanned=scanned, delivered=delivered)


_KEPT = "window_end + INTERVAL 5 MINUTE > clock"

COUNTS = {
    "delivery_counts_hourly": f"WITH {_HOURLY} SELECT * FROM hourly",
    "delivery_counts_hopping": """
        SELECT location, window_start, window_start + INTERVAL 60 MINUTE AS window_end, count(*) AS count FROM (
          SELECT event_type AS location, time_bucket(INTERVAL 30 MINUTE, ts) AS window_start FROM events
          UNION ALL
          SELECT event_type, time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE FROM events)
        GROUP BY ALL""",
    "valid_deliveries": """
        SELECT CAST(l_orderkey AS VARCHAR) AS shipment_id,
               regexp_replace(CASE WHEN l_linenumber % 3 = 0 THEN chr(9) || '  ' || n_name || ' ' || chr(10)
                                   ELSE n_name END,
                              '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g') AS location,
               l_shipdate AS delivered_at
        FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
        WHERE l_linenumber <> 7 AND l_linenumber % 5 <> 0""",
    "event_time": """
        SELECT event_id, CASE WHEN event_id % 22 = 0 THEN TIMESTAMP '2024-02-01 00:00:00'
                              WHEN event_id % 11 = 0 THEN ts ELSE ts - INTERVAL 1 HOUR END AS event_time
        FROM events""",
    "counts_in_range": f"""WITH {_HOURLY} SELECT * FROM hourly
        WHERE window_start BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-12'""",
    "counts_last_24h": f"""WITH {_HOURLY}, latest AS (SELECT max(ts) AS t FROM events)
        SELECT hourly.* FROM hourly, latest WHERE window_start BETWEEN t - INTERVAL 24 HOUR AND t""",
    "recent_window_count": f"""WITH {_HOURLY}, latest AS (SELECT max(ts) AS t FROM events)
        SELECT count(*) AS recent_data_count
        FROM hourly, latest WHERE window_start BETWEEN t - INTERVAL 1 HOUR AND t""",
    "location_analytics": f"""WITH {_HOURLY}, picked AS (
          SELECT * FROM hourly WHERE location = 'purchase'
            AND window_start BETWEEN TIMESTAMP '2024-01-05' AND TIMESTAMP '2024-01-25')
        SELECT *, CAST(sum(count) OVER () AS BIGINT) AS total_deliveries FROM picked""",
    "delivery_rate": f"""WITH {_HOURLY}
        SELECT location, window_start, CAST(count AS DOUBLE) AS per_hour, format('{{:,}}', count) AS total_display,
               printf('%.1f', CAST(count AS DOUBLE)) AS rate_display,
               strftime(window_start, '%b %d %H:%M') AS start_display,
               strftime(window_end, '%b %d %H:%M') AS end_display
        FROM hourly""",
    "deliveries_per_location": "SELECT event_type AS location, count(*) AS total_deliveries FROM events GROUP BY 1",
    "delivery_counts_merged": f"WITH {_HOURLY} SELECT * FROM hourly",
    "counts_retained": f"""WITH {_HOURLY} SELECT * FROM hourly
        WHERE window_start > (SELECT max(window_start) FROM hourly) - INTERVAL 7 DAY""",
    "counts_with_grace": f"""WITH {_LATE.format(scope='PARTITION BY location')}
        SELECT location, window_start, window_end, count(*) AS count FROM clocked WHERE {_KEPT} GROUP BY ALL""",
    "counts_with_grace_one_clock": f"""WITH {_LATE.format(scope='')}
        SELECT location, window_start, window_end, count(*) AS count FROM clocked WHERE {_KEPT} GROUP BY ALL""",
    "late_deliveries": f"""WITH {_LATE.format(scope='PARTITION BY location')}
        SELECT event_id, shipment_id, location, delivered_at, arrival, window_start, window_end
        FROM clocked WHERE NOT ({_KEPT})""",
    "delivery_counts_daily": f"""WITH {_REPLAY}
        SELECT location, date_trunc('day', delivered_at) AS window_start,
               date_trunc('day', delivered_at) + INTERVAL 1 DAY AS window_end, count(*) AS count
        FROM delivered GROUP BY ALL""",
    "delivery_counts_streamed": f"WITH {_HOURLY} SELECT * FROM hourly",
    "analytics_records": f"""WITH {_HOURLY}
        SELECT 'delivery-analytics' AS topic, location || '-' || epoch_ms(window_start) AS key,
               {_json(location=_quoted('location'), count='count',
                      windowStart=_array('window_start'), windowEnd=_array('window_end'))} AS value
        FROM hourly""",
}

LIFECYCLE = {
    "shipment_lifecycle": f"""WITH {_REPLAY}
        SELECT shipment_id, seq, status, location AS last_location, destination, delivered, delivered_at FROM replay""",
    "delivered_events": f"""WITH {_REPLAY}
        SELECT shipment_id, destination, location, delivered_at, correlation_id FROM delivered""",
    "delivered_events_first": f"""WITH {_REPLAY}
        SELECT shipment_id, destination, location, delivered_at, correlation_id FROM delivered
        QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY seq) = 1""",
    "shipment_state": f"WITH {_REPLAY} SELECT {_STATE_COLUMNS} FROM state",
    "shipment_by_id": f"WITH {_REPLAY} SELECT {_RESPONSE} FROM state WHERE shipment_id = '42'",
    "shipment_responses": f"WITH {_REPLAY} SELECT {_RESPONSE} FROM state",
    "status_lookup": f"""WITH {_REPLAY}
        SELECT CAST(o_orderkey AS VARCHAR) AS shipment_id, coalesce(status, 'Unknown') AS status
        FROM orders LEFT JOIN state ON CAST(o_orderkey AS VARCHAR) = shipment_id""",
    "mark_delivered": f"""WITH {_REPLAY}, {_REQUESTS}
        SELECT request_id, shipment_id, success, status, location, delivered_at, error_message FROM marked""",
    "manual_deliveries": f"""WITH {_REPLAY}, {_REQUESTS}
        SELECT shipment_id, destination, location, delivered_at, request_id AS correlation_id
        FROM marked WHERE success""",
    "state_after_manual": f"""WITH {_REPLAY}, {_REQUESTS}, done AS (SELECT * FROM marked WHERE success)
        SELECT s.shipment_id, s.destination,
               CASE WHEN d.success THEN d.location ELSE s.last_location END AS last_location,
               s.created_at, s.last_scanned_at,
               CASE WHEN d.success THEN d.delivered_at ELSE s.delivered_at END AS delivered_at,
               CASE WHEN d.success THEN 'DELIVERED' ELSE s.status END AS status
        FROM state s LEFT JOIN done d ON s.shipment_id = d.shipment_id""",
    "known_shipments": f"""WITH {_ORDERS_TO}, {_RECREATED}
        SELECT shipment_id, destination, created_at, 'CREATED' AS status FROM recreated
        QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY created_at DESC) = 1""",
    "scan_results": f"""WITH {_SCAN_REQUESTS}
        SELECT request_id, shipment_id, location, error_message IS NULL AS success, error_message FROM results""",
    "scan_accepted": f"""WITH {_SCAN_REQUESTS}
        SELECT shipment_id, location, scanned_at, destination, request_id AS correlation_id
        FROM results WHERE error_message IS NULL""",
    "scan_rejected": f"""WITH {_SCAN_REQUESTS}
        SELECT request_id, shipment_id, location, error_message FROM results
        WHERE invalid IS NULL AND error_message IS NOT NULL""",
    "scan_state": f"""WITH {_SCAN_REQUESTS}, known AS (
          SELECT * FROM recreated QUALIFY row_number() OVER (PARTITION BY shipment_id ORDER BY created_at DESC) = 1),
        last_scan AS (
          SELECT r.* FROM results r JOIN known k ON r.shipment_id = k.shipment_id AND r.scanned_at >= k.created_at
          WHERE error_message IS NULL
          QUALIFY row_number() OVER (PARTITION BY r.shipment_id
            ORDER BY scanned_at DESC, line DESC, part DESC, supplier DESC, quantity DESC, price DESC) = 1)
        SELECT k.shipment_id, k.destination, s.location AS last_location, s.scanned_at AS last_scanned_at,
               CASE WHEN s.shipment_id IS NULL THEN 'CREATED' ELSE 'IN_TRANSIT' END AS status
        FROM known k LEFT JOIN last_scan s ON k.shipment_id = s.shipment_id""",
    "scan_known_check": f"""WITH {_ORDERS_TO}
        SELECT CASE WHEN o_orderkey % 5 = 0 THEN 'no/' || o_orderkey
                    WHEN o_orderkey % 7 = 0 THEN 'X-' || o_orderkey
                    ELSE CAST(o_orderkey AS VARCHAR) END AS shipment_id,
               o_orderkey % 5 <> 0 AS valid_id, o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AS known
        FROM orders""",
    "create_validation": f"""
        SELECT 'request-' || o_orderkey AS request_id, {_CREATE_ERROR} AS error_message FROM orders""",
    "create_shipments": f"""WITH {_ORDERS_TO}
        SELECT 'request-' || o_orderkey AS request_id, sha256('request-' || o_orderkey) AS shipment_id,
               origin, destination, c_name AS customer_id, o_orderdate AS created_at, 'CREATED' AS status
        FROM orders_to WHERE ({_CREATE_ERROR}) IS NULL""",
    "delete_shipments": f"""WITH {_ORDERS_TO}
        SELECT CAST(o_orderkey AS VARCHAR) AS shipment_id, destination FROM orders_to
        WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
}

NOTIFICATIONS = {
    "notifications": f"WITH {_NOTES} SELECT * FROM notes",
    "notifications_for_shipment": f"WITH {_NOTES} SELECT * FROM notes WHERE shipment_id = '42'",
    "notification_by_id": f"WITH {_NOTES} SELECT * FROM notes WHERE id = sha256('shipment-created:0:0')",
    "notification_count": f"WITH {_NOTES} SELECT count(*) AS count FROM notes",
    "recent_notifications": f"WITH {_NOTES} SELECT * FROM notes ORDER BY timestamp DESC, id LIMIT 10",
    "notifications_by_type": f"""WITH {_NOTES}
        SELECT t.type, count(id) AS count
        FROM (VALUES ('SHIPMENT_CREATED'), ('SHIPMENT_SCANNED'), ('SHIPMENT_DELIVERED')) t(type)
        LEFT JOIN notes USING (type) GROUP BY 1""",
    "notifications_by_shipment": f"WITH {_NOTES} SELECT shipment_id, count(*) AS count FROM notes GROUP BY 1",
    "busiest_shipments": f"""WITH {_NOTES} SELECT shipment_id, count(*) AS count FROM notes GROUP BY 1
        ORDER BY 2 DESC, 1 LIMIT 10""",
    "notification_preview": f"""WITH {_NOTES}
        SELECT id, CASE WHEN length(message) > 50 THEN substr(message, 1, 50) || '...' ELSE message END AS preview
        FROM notes""",
    "notification_type_parse": """
        SELECT event_id,
               CASE event_id % 4 WHEN 0 THEN 'shipment_scanned' WHEN 1 THEN 'SHIPMENT_DELIVERED'
                                 WHEN 2 THEN event_type END AS raw_type,
               CASE event_id % 4 WHEN 0 THEN 'SHIPMENT_SCANNED' WHEN 1 THEN 'SHIPMENT_DELIVERED'
                                 ELSE 'SHIPMENT_CREATED' END AS any_case,
               CASE event_id % 4 WHEN 1 THEN 'SHIPMENT_DELIVERED' ELSE 'SHIPMENT_CREATED' END AS exact_case
        FROM events""",
    "notification_validation": f"""WITH {_ORDERS_TO}, {_CREATED}
        SELECT sha256(record_id) AS id,
               CASE WHEN o_orderkey % 13 = 0 THEN 'Notification must not be null'
                    WHEN o_orderkey % 5 = 0 THEN 'Notification shipmentId must not be null or empty'
                    WHEN o_orderkey % 7 = 0 THEN 'Notification message must not be null or empty'
                    WHEN o_orderkey % 11 = 0 THEN 'Notification type must not be null' END AS error_message
        FROM created""",
    "delete_notifications": f"""WITH {_NOTES}, {_DELETIONS}
        SELECT * FROM notes WHERE id NOT IN (SELECT trim(id) FROM deletions)""",
    "deletion_results": f"""WITH {_NOTES}, {_DELETIONS}, answered AS (
          SELECT request_id, d.id, CASE WHEN trim(d.id) = '' THEN 'Notification ID must not be null or empty'
            WHEN n.id IS NULL OR row_number() OVER (PARTITION BY trim(d.id) ORDER BY request_id) > 1
              THEN 'Notification not found with ID: ' || d.id END AS error_message
          FROM deletions d LEFT JOIN notes n ON trim(d.id) = n.id)
        SELECT request_id, id, error_message IS NULL AS success, error_message FROM answered""",
    "deletion_counts": f"""WITH {_NOTES}, {_DELETIONS}
        SELECT count(*) FILTER (id IN (SELECT trim(id) FROM deletions)) AS deleted_count,
               count(*) FILTER (id NOT IN (SELECT trim(id) FROM deletions)) AS remaining_count FROM notes""",
    "delete_all_notifications": f"""WITH {_NOTES}
        SELECT count(*) AS deleted_count, CAST(0 AS BIGINT) AS remaining_count FROM notes""",
    "notification_sent_records": f"""WITH {_NOTES}
        SELECT 'notification-sent' AS topic, CAST(NULL AS VARCHAR) AS key,
               {_json(notificationId=_quoted('id'), shipmentId=_quoted('shipment_id'), type=_quoted('type'),
                      message=_quoted('message'),
                      **_event('NotificationSentEvent', 'timestamp', "sha256('sent:' || id)"))} AS value
        FROM notes""",
    "event_records": f"""WITH {_REPLAY}, {_CREATED}
        SELECT 'shipment-created' AS topic, shipment_id AS key,
               {_json(shipmentId=_quoted('shipment_id'), destination=_quoted('destination'),
                      createdAt=_quoted(_iso('created_at')),
                      **_event('ShipmentCreatedEvent', 'created_at', 'correlation_id'))} AS value
        FROM created
        UNION ALL
        SELECT 'shipment-scanned', shipment_id,
               {_json(shipmentId=_quoted('shipment_id'), location=_quoted('location'),
                      destination=_quoted('destination'), scannedAt=_quoted(_iso('scanned_at')),
                      **_event('ShipmentScannedEvent', 'scanned_at', 'correlation_id'))}
        FROM scans
        UNION ALL
        SELECT 'shipment-delivered', shipment_id,
               {_json(shipmentId=_quoted('shipment_id'), location=_quoted('location'),
                      destination=_quoted('destination'), deliveredAt=_quoted(_iso('delivered_at')),
                      **_event('ShipmentDeliveredEvent', 'delivered_at', 'correlation_id'))}
        FROM delivered""",
    "webhook_payloads": f"WITH {_WEBHOOK} SELECT * FROM webhook",
    "customer_messages": f"""WITH {_WEBHOOK}, keyed AS (
          SELECT *, timestamp // 86400000 % 7 AS k FROM webhook),
        varied AS (
          SELECT CASE WHEN k = 1 THEN 'shipment-lost' ELSE "eventType" END AS "eventType2", "shipmentId",
                 CASE WHEN k IN (2, 3) THEN 'DEMO' ELSE "customerId" END AS customer,
                 CASE WHEN k = 4 THEN 'null' ELSE destination END AS d, CASE WHEN k <> 5 THEN timestamp END AS t
          FROM keyed)
        SELECT "eventType2" AS event_type, "shipmentId" AS shipment_id,
               'Demo Kunde ' || right(customer, 3) AS customer_name,
               {_text("'🐾 Ihre Waybill Sendung ist unterwegs!'", "'📍 Waybill Sendungsupdate'",
                      "'🎉 Waybill Zustellung erfolgreich!'")} AS email_subject,
               {_text('''printf('Ihre Sendung %s ist unterwegs nach %s! Wir halten Sie auf dem Laufenden.', "shipmentId", d)''',
                      '''printf('Update: Ihre Sendung %s macht Fortschritte Richtung %s.', "shipmentId", d)''',
                      '''printf('Großartig! Ihre Sendung %s wurde erfolgreich in %s zugestellt!', "shipmentId", d)''')} AS email_body,
               {_text('''printf('🐾 Waybill: Sendung %s → %s', "shipmentId", d)''',
                      '''printf('📍 Waybill: %s gescannt → %s', "shipmentId", d)''',
                      '''printf('🎉 Waybill: %s zugestellt in %s!', "shipmentId", d)''')} AS sms,
               CASE WHEN t IS NULL THEN 0 ELSE 1706745600000 - t END AS execution_time
        FROM varied""",
    "event_metrics": f"""WITH {_WEBHOOK}, judged AS (
          SELECT "eventType", "eventType" = 'shipment-created' AND CAST("shipmentId" AS BIGINT) % 97 = 0 AS broken
          FROM webhook)
        SELECT CASE WHEN broken THEN 'error' ELSE "eventType" END AS event_type,
               CASE WHEN broken THEN 'failure' ELSE 'success' END AS status, count(*) AS count
        FROM judged GROUP BY ALL""",
}

_DELIVERY_COLUMNS = "CAST(user_id AS VARCHAR) AS shipment_id"

DECODING = {
    "decode_delivered": f"""
        SELECT {_DELIVERY_COLUMNS}, 'anywhere' AS destination, event_type AS location, ts AS delivered_at,
               'corr-' || event_id AS correlation_id,
               CASE WHEN event_id % 4 = 0 THEN ts + INTERVAL 1 SECOND ELSE ts END AS timestamp,
               CASE WHEN event_id % 2 = 0 THEN 'v2' ELSE 'v1' END AS version
        FROM events""",
    "decode_by_type": f"""WITH {_SCANS}, {_CREATED}
        SELECT 'shipment-created' AS topic, CAST(o_orderkey % 3 AS INTEGER) AS partition, o_orderkey // 3 AS offset,
               'ShipmentCreatedEvent' AS event_type, shipment_id, destination, CAST(NULL AS VARCHAR) AS location,
               created_at, CAST(NULL AS TIMESTAMP) AS scanned_at, CAST(NULL AS TIMESTAMP) AS delivered_at,
               correlation_id
        FROM created
        UNION ALL
        SELECT 'shipment-scanned', CAST(CAST(shipment_id AS BIGINT) % 3 AS INTEGER), CAST(shipment_id AS BIGINT) // 3,
               'ShipmentScannedEvent', shipment_id, destination, location, NULL, scanned_at, NULL, correlation_id
        FROM scans
        UNION ALL
        SELECT 'shipment-delivered', CAST(event_id % 3 AS INTEGER), event_id // 3, 'ShipmentDeliveredEvent',
               CAST(user_id AS VARCHAR), 'anywhere', event_type, NULL, NULL, ts, 'corr-' || event_id
        FROM events""",
    "decode_dates": """
        SELECT event_id, ts AS from_iso, ts AS from_array, CAST(NULL AS TIMESTAMP) AS from_junk FROM events""",
    "decode_usable": f"""
        SELECT {_DELIVERY_COLUMNS}, event_type AS location, ts AS delivered_at, 'corr-' || event_id AS correlation_id
        FROM events WHERE event_id % 97 <> 0 AND event_id % 89 <> 0 AND event_id % 83 <> 0""",
    "dead_letters": """
        SELECT 'shipment-delivered' AS topic, 'shipment-delivered.DLT' AS dead_letter_topic,
               CAST(event_id % 3 AS INTEGER) AS partition, event_id // 3 AS offset,
               CASE WHEN event_id % 97 = 0 THEN 'malformed JSON'
                    WHEN event_id % 89 = 0 THEN 'unknown event type' ELSE 'unreadable date' END AS reason
        FROM events WHERE event_id % 97 = 0 OR event_id % 89 = 0 OR event_id % 83 = 0""",
    "error_log_lines": """
        SELECT CASE WHEN user_id % 2 = 0 THEN 'analytics' ELSE 'notifications' END AS service,
               date_trunc('second', ts) AS logged_at, 'worker-' || (user_id % 4) AS thread,
               CASE WHEN event_type = 'error' THEN 'ERROR' ELSE 'INFO' END AS level, 'app.Handler' AS logger,
               CASE WHEN event_type = 'error' THEN 'failed on ' ELSE 'no Errors in ' END || event_id AS message
        FROM events WHERE event_type = 'error' OR event_id % 10 = 0""",
}

ORACLE = {**COUNTS, **LIFECYCLE, **NOTIFICATIONS, **DECODING}

# The same questions asked of stored tables.
ORACLE |= {
    f"{name}_stored": ORACLE[name]
    for name in (
        "counts_in_range", "notifications_for_shipment", "notification_by_id", "notification_count",
        "notifications_by_type", "recent_notifications", "deletion_results", "status_lookup", "shipment_by_id",
    )
}
ORACLE["location_total_stored"] = (
    f"SELECT DISTINCT location, total_deliveries FROM ({ORACLE['location_analytics']})"
)
