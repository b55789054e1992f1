-- Orders of one day, optionally of one status.
-- parameters: dt; orders, status
SELECT order_id, customer_id, order_dt, CAST(amount AS DECIMAL(18,2)) AS amount, status
FROM IDENTIFIER(:orders)
WHERE order_dt = CAST(:dt AS DATE)
  AND (coalesce(:status, '') = '' OR status = :status)
ORDER BY order_id
