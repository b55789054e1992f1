-- Orders and amount per status of one day, from the loaded table of a schema.
-- parameters: dt; schema
SELECT order_dt, status, count(*) AS order_cnt, CAST(sum(amount) AS DECIMAL(18,2)) AS amount_sum
FROM IDENTIFIER(:schema || '.orders')
WHERE order_dt = CAST(:dt AS DATE)
GROUP BY order_dt, status
ORDER BY order_dt, status
