"""DuckDB oracles for ``plans.orders``.

The reservation is stated as a recursive CTE: each recursion step is one decision
round over all constrained order lines, and recursion ends after the round that
leaves no order undecided.  (The plain rule, order by order, is what the tests
hold the operator against; as a recursive query it takes too long.)
"""

CHAIN = """
WITH RECURSIVE
stock AS (SELECT p_partkey AS product_id, CAST(p_size AS DOUBLE) * 10 AS stock FROM part),
lines_all AS (
  SELECT l.l_orderkey AS order_id, o.o_orderdate AS order_date, l.l_linenumber AS pos,
         l.l_partkey AS product_id, l.l_quantity AS quantity, p.p_retailprice AS price
  FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
  LEFT JOIN part p ON p.p_partkey = l.l_partkey),
totals AS (
  SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, o.o_orderdate AS order_date,
         CAST(COALESCE(t.n_items, 0) AS BIGINT) AS n_items, COALESCE(t.total_amount, 0.0) AS total_amount
  FROM orders o LEFT JOIN (
    SELECT order_id, COUNT(*) AS n_items,
           CAST(SUM(CAST(quantity AS DECIMAL(15,2)) * CAST(price AS DECIMAL(15,2))) AS DOUBLE) AS total_amount
    FROM lines_all GROUP BY 1) t ON t.order_id = o.o_orderkey),
dem AS (
  SELECT d.*, COALESCE(s.stock, 0.0) AS stock, s.product_id IS NOT NULL AS found
  FROM (SELECT order_id, order_date, product_id, SUM(quantity) AS qty, MIN(pos) AS pos
        FROM lines_all GROUP BY 1, 2, 3) d
  LEFT JOIN stock s ON s.product_id = d.product_id),
dem2 AS (SELECT *, SUM(qty) OVER (PARTITION BY product_id) > stock AS constraining FROM dem),
rounds(rnd, order_id, order_date, product_id, qty, stock, st, more) AS (
  SELECT 0, order_id, order_date, product_id, qty, stock, 'U', true FROM dem2 WHERE constraining
  UNION ALL
  SELECT rnd + 1, order_id, order_date, product_id, qty, stock, new_st,
         bool_or(new_st = 'U') OVER () AS more
  FROM (
    SELECT *, CASE WHEN st <> 'U' THEN st
                   WHEN bool_and(fits_hi) OVER (PARTITION BY order_id) THEN 'A'
                   WHEN bool_or(fails_lo) OVER (PARTITION BY order_id) THEN 'R'
                   ELSE 'U' END AS new_st
    FROM (
      SELECT *,
             qty <= stock - COALESCE(SUM(CASE WHEN st <> 'R' THEN qty END) OVER w, 0) AS fits_hi,
             qty > stock - COALESCE(SUM(CASE WHEN st = 'A' THEN qty END) OVER w, 0) AS fails_lo
      FROM rounds WHERE more
      WINDOW w AS (PARTITION BY product_id ORDER BY order_date, order_id
                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) a) b),
final_round AS (SELECT * FROM rounds WHERE rnd = (SELECT max(rnd) FROM rounds)),
per_order AS (
  SELECT d.order_id, bool_and(NOT d.constraining OR COALESCE(f.st = 'A', false)) AS accepted
  FROM dem2 d LEFT JOIN final_round f ON f.order_id = d.order_id AND f.product_id = d.product_id
  GROUP BY d.order_id),
probe AS (
  SELECT d.order_id, d.product_id, d.pos, d.qty, d.found, p.accepted,
         d.stock - COALESCE(SUM(CASE WHEN p.accepted THEN d.qty END) OVER (
             PARTITION BY d.product_id ORDER BY d.order_date, d.order_id
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS available
  FROM dem2 d JOIN per_order p ON p.order_id = d.order_id WHERE d.constraining),
first_fail AS (
  SELECT order_id, arg_min(product_id, (pos, product_id)) AS failed_product,
         arg_min(available, (pos, product_id)) AS available,
         arg_min(qty, (pos, product_id)) AS requested, arg_min(found, (pos, product_id)) AS found
  FROM probe WHERE NOT accepted AND qty > available GROUP BY order_id),
reservation AS (
  SELECT p.order_id,
         CASE WHEN p.accepted THEN 'INVENTORY_RESERVED' ELSE 'OUT_OF_STOCK' END AS decision,
         f.failed_product, f.available, f.requested,
         CASE WHEN p.accepted THEN NULL WHEN NOT f.found THEN 'Product not found'
              ELSE 'Insufficient stock' END AS reason
  FROM per_order p LEFT JOIN first_fail f ON f.order_id = p.order_id),
payments AS (
  SELECT r.order_id, t.total_amount AS amount,
         CASE WHEN ok THEN 'PAYMENT_COMPLETED' ELSE 'PAYMENT_FAILED' END AS status,
         CASE WHEN ok THEN 'TXN-' || upper(substr(sha256(CAST(r.order_id AS VARCHAR)), 1, 8)) END AS transaction_id,
         CASE WHEN ok THEN 'credit_card' END AS payment_method,
         CASE WHEN NOT ok THEN 'Insufficient funds' END AS reason
  FROM (SELECT order_id, (('0x' || substr(md5(CAST(order_id AS VARCHAR)), 1, 8))::BIGINT % 100) < 80 AS ok
        FROM reservation WHERE decision = 'INVENTORY_RESERVED') r
  JOIN totals t ON t.order_id = r.order_id),
shipments AS (
  SELECT order_id, 'TRK-' || upper(substr(sha256(CAST(order_id AS VARCHAR)), 1, 12)) AS tracking_number,
         'UPS' AS carrier, '3 business days' AS estimated_delivery
  FROM payments WHERE status = 'PAYMENT_COMPLETED'),
items AS (
  SELECT order_id, list({'product_id': product_id, 'quantity': quantity, 'price': price} ORDER BY pos, product_id, quantity, price) AS items
  FROM lines_all GROUP BY order_id),
log AS (
  SELECT t.order_id, 1 AS step, 'ORDER_CREATED' AS event_type, customer_id, total_amount AS amount,
         CAST(NULL AS BIGINT) AS product_id, CAST(NULL AS VARCHAR) AS reason,
         CAST(NULL AS VARCHAR) AS tracking_number, i.items AS items
  FROM totals t LEFT JOIN items i ON i.order_id = t.order_id WHERE n_items > 0
  UNION ALL
  SELECT r.order_id, 2, decision, NULL, NULL, failed_product, reason, NULL,
         CASE WHEN decision = 'INVENTORY_RESERVED' THEN i.items END
  FROM reservation r LEFT JOIN items i ON i.order_id = r.order_id
  UNION ALL
  SELECT order_id, 3, status, NULL, amount, NULL, reason, NULL, NULL FROM payments
  UNION ALL
  SELECT order_id, 4, 'READY_FOR_SHIPMENT', NULL, NULL, NULL, NULL, NULL, NULL FROM shipments
  UNION ALL
  SELECT p.order_id, 4, 'INVENTORY_RELEASED', NULL, NULL, NULL, reason, NULL, i.items
  FROM payments p LEFT JOIN items i ON i.order_id = p.order_id WHERE status = 'PAYMENT_FAILED'
  UNION ALL
  SELECT order_id, 5, 'SHIPMENT_CREATED', NULL, NULL, NULL, NULL, tracking_number, NULL FROM shipments),
status AS (
  SELECT order_id, arg_max(status, rnk) AS status FROM (
    SELECT order_id,
           CASE event_type WHEN 'ORDER_CREATED' THEN 'created' WHEN 'INVENTORY_RESERVED' THEN 'inventory_reserved'
                WHEN 'PAYMENT_COMPLETED' THEN 'payment_completed' WHEN 'SHIPMENT_CREATED' THEN 'shipped' END AS status,
           CASE event_type WHEN 'ORDER_CREATED' THEN 1 WHEN 'INVENTORY_RESERVED' THEN 2
                WHEN 'PAYMENT_COMPLETED' THEN 3 WHEN 'SHIPMENT_CREATED' THEN 4 END AS rnk
    FROM log) x WHERE rnk IS NOT NULL GROUP BY order_id)
"""

# The event types each service subscribes to.
SUBS = """(VALUES
  ('PAYMENT_COMPLETED', 'OrderService'), ('INVENTORY_RESERVED', 'OrderService'), ('SHIPMENT_CREATED', 'OrderService'),
  ('ORDER_CREATED', 'InventoryService'), ('PAYMENT_COMPLETED', 'InventoryService'), ('PAYMENT_FAILED', 'InventoryService'),
  ('INVENTORY_RESERVED', 'PaymentService'), ('READY_FOR_SHIPMENT', 'ShippingService'),
  ('ORDER_CREATED', 'NotificationService'), ('PAYMENT_COMPLETED', 'NotificationService'),
  ('SHIPMENT_CREATED', 'NotificationService'), ('OUT_OF_STOCK', 'NotificationService'),
  ('PAYMENT_FAILED', 'NotificationService'),
  ('ORDER_CREATED', 'AnalyticsService'), ('PAYMENT_COMPLETED', 'AnalyticsService'),
  ('PAYMENT_FAILED', 'AnalyticsService'), ('SHIPMENT_CREATED', 'AnalyticsService')) s(event_type, service)"""

SQL = {
    "order_totals": CHAIN + "SELECT order_id, customer_id, n_items, total_amount FROM totals",
    "order_validation": CHAIN + """
SELECT order_id, n_items, n_items > 0 AS is_valid, CASE WHEN n_items > 0 THEN NULL ELSE 'no_items' END AS reason
FROM totals""",
    "stock_check": CHAIN + """,
sc AS (
  SELECT d.order_id, d.product_id, d.requested, d.pos, s.stock IS NOT NULL AS found,
         COALESCE(s.stock, 0.0) AS available, d.requested > COALESCE(s.stock, 0.0) AS fails
  FROM (SELECT order_id, product_id, SUM(quantity) AS requested, MIN(pos) AS pos
        FROM lines_all GROUP BY 1, 2) d LEFT JOIN stock s ON s.product_id = d.product_id),
agg AS (
  SELECT order_id, bool_and(NOT fails) AS all_available,
         arg_min(product_id, (pos, product_id)) FILTER (WHERE fails) AS failed_product,
         arg_min(available, (pos, product_id)) FILTER (WHERE fails) AS available,
         arg_min(requested, (pos, product_id)) FILTER (WHERE fails) AS requested,
         arg_min(found, (pos, product_id)) FILTER (WHERE fails) AS found
  FROM sc GROUP BY order_id)
SELECT order_id, all_available, failed_product, available, requested,
       CASE WHEN all_available THEN NULL WHEN NOT found THEN 'Product not found'
            ELSE 'Insufficient stock' END AS reason
FROM agg""",
    "reservation": CHAIN + "SELECT * FROM reservation",
    "stock_after_orders": CHAIN + """
SELECT d.order_id, d.product_id, d.quantity,
       s.stock - SUM(d.quantity) OVER (PARTITION BY d.product_id ORDER BY d.order_date, d.order_id
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stock_left
FROM (SELECT order_id, order_date, product_id, SUM(quantity) AS quantity FROM lines_all
      WHERE order_id IN (SELECT order_id FROM reservation WHERE decision = 'INVENTORY_RESERVED')
      GROUP BY 1, 2, 3) d
JOIN stock s ON s.product_id = d.product_id""",
    "payment_outcomes": CHAIN + "SELECT * FROM payments",
    "shipments": CHAIN + "SELECT * FROM shipments",
    "notifications": CHAIN + """
SELECT order_id, event_type,
       CASE event_type
         WHEN 'ORDER_CREATED' THEN 'Order confirmation sent for ' || CAST(order_id AS VARCHAR)
              || ' to customer ' || CAST(customer_id AS VARCHAR)
         WHEN 'PAYMENT_COMPLETED' THEN 'Payment confirmation sent for ' || CAST(order_id AS VARCHAR)
         WHEN 'SHIPMENT_CREATED' THEN 'Shipping info sent for ' || CAST(order_id AS VARCHAR)
              || ' - Tracking: ' || tracking_number
         WHEN 'OUT_OF_STOCK' THEN 'Out-of-stock alert for ' || CAST(order_id AS VARCHAR)
              || ' - Product: ' || CAST(product_id AS VARCHAR)
         WHEN 'PAYMENT_FAILED' THEN 'Payment failure for ' || CAST(order_id AS VARCHAR)
              || ' - Reason: ' || reason END AS message
FROM log WHERE event_type IN ('ORDER_CREATED', 'PAYMENT_COMPLETED', 'SHIPMENT_CREATED',
                              'OUT_OF_STOCK', 'PAYMENT_FAILED')""",
    "order_status": CHAIN + "SELECT * FROM status",
    "orders_by_status": CHAIN + "SELECT status, COUNT(*) AS orders FROM status GROUP BY status",
    "order_chains": CHAIN + """,
paths AS (SELECT order_id, string_agg(event_type, ' → ' ORDER BY step) AS path FROM log GROUP BY order_id)
SELECT CASE path
         WHEN 'ORDER_CREATED → INVENTORY_RESERVED → PAYMENT_COMPLETED → READY_FOR_SHIPMENT → SHIPMENT_CREATED'
           THEN 'Normal Flow'
         WHEN 'ORDER_CREATED → OUT_OF_STOCK' THEN 'Out of Stock'
         WHEN 'ORDER_CREATED → INVENTORY_RESERVED → PAYMENT_FAILED → INVENTORY_RELEASED' THEN 'Payment Failure'
         ELSE 'Other' END AS chain, path, COUNT(*) AS orders
FROM paths GROUP BY 1, 2""",
    "order_kpis": CHAIN + """,
k AS (
  SELECT COUNT(*) FILTER (WHERE event_type = 'ORDER_CREATED') AS total_orders,
         COALESCE(CAST(SUM(CAST(amount AS DECIMAL(15,2))) FILTER (WHERE event_type = 'ORDER_CREATED') AS DOUBLE), 0.0) AS total_revenue,
         COUNT(*) FILTER (WHERE event_type = 'PAYMENT_COMPLETED') AS successful_payments,
         COUNT(*) FILTER (WHERE event_type = 'PAYMENT_FAILED') AS failed_payments
  FROM log)
SELECT *, CAST(successful_payments AS DOUBLE) / greatest(1, successful_payments + failed_payments) AS success_rate
FROM k""",
    "inventory_snapshot": CHAIN + """,
held AS (
  SELECT l.product_id, SUM(CASE WHEN p.order_id IS NULL THEN l.quantity ELSE 0.0 END) AS reserved
  FROM lines_all l
  JOIN reservation r ON r.order_id = l.order_id AND r.decision = 'INVENTORY_RESERVED'
  LEFT JOIN (SELECT order_id FROM payments WHERE status = 'PAYMENT_FAILED') p ON p.order_id = l.order_id
  GROUP BY l.product_id)
SELECT s.product_id, s.stock, COALESCE(h.reserved, 0.0) AS reserved, s.stock - COALESCE(h.reserved, 0.0) AS available
FROM stock s LEFT JOIN held h ON h.product_id = s.product_id""",
    "inventory_totals": CHAIN + """,
held AS (
  SELECT SUM(l.quantity) AS reserved FROM lines_all l
  JOIN payments p ON p.order_id = l.order_id AND p.status = 'PAYMENT_COMPLETED' JOIN stock s ON s.product_id = l.product_id)
SELECT COUNT(*) AS total_products, COALESCE(SUM(stock), 0.0) AS total_items,
       COALESCE(SUM(stock), 0.0) - COALESCE((SELECT reserved FROM held), 0.0) AS available_items
FROM stock""",
    "released_orders": CHAIN + """
SELECT l.product_id, COUNT(*) AS lines, SUM(l.quantity) AS released
FROM lines_all l JOIN payments p ON p.order_id = l.order_id WHERE p.status = 'PAYMENT_FAILED' GROUP BY 1""",
    "payments_by_amount": CHAIN + """
SELECT order_id, total_amount AS amount, CASE WHEN total_amount > 0 THEN 'PAYMENT_PROCESSED' ELSE 'PAYMENT_FAILED' END AS status
FROM totals""",
    "known_order_events": CHAIN + "SELECT order_id, step, event_type FROM log WHERE order_id % 2 = 0",
    "event_fanout": CHAIN + f"""
SELECT l.order_id, l.event_type, s.service FROM log l JOIN {SUBS} ON s.event_type = l.event_type""",
    "event_monitor": CHAIN + """
SELECT CASE l.event_type WHEN 'ORDER_CREATED' THEN 'orders' WHEN 'INVENTORY_RESERVED' THEN 'inventory'
         WHEN 'OUT_OF_STOCK' THEN 'inventory' WHEN 'INVENTORY_RELEASED' THEN 'inventory'
         WHEN 'PAYMENT_COMPLETED' THEN 'payments'
         WHEN 'PAYMENT_FAILED' THEN 'payments' WHEN 'READY_FOR_SHIPMENT' THEN 'shipping'
         WHEN 'SHIPMENT_CREATED' THEN 'shipping' END AS topic,
       l.event_type, CAST(l.order_id AS VARCHAR) AS order_id,
       strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS time, l.amount
FROM log l JOIN orders o ON o.o_orderkey = l.order_id""",
    "order_envelopes": CHAIN + """
SELECT 'EVT-' || upper(substr(sha256(CAST(l.order_id AS VARCHAR) || ':' || l.event_type), 1, 12)) AS event_id,
       l.event_type, strftime(o.o_orderdate, '%Y-%m-%dT%H:%M:%S') AS timestamp,
       CAST(to_json({'order_id': l.order_id, 'customer_id': l.customer_id, 'amount': l.amount,
                     'product_id': l.product_id, 'reason': l.reason,
                     'tracking_number': l.tracking_number, 'items': l.items}) AS VARCHAR) AS data,
       l.order_id * 10 + l.step AS message_id
FROM log l JOIN orders o ON o.o_orderkey = l.order_id""",
}
