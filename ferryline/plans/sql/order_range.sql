-- Orders and amount per day and status in a closed range of days.
-- parameters: from_dt, to_dt; orders
SELECT order_dt, status, count(*) AS order_cnt, CAST(sum(amount) AS DECIMAL(18,2)) AS amount_sum
FROM IDENTIFIER(:orders)
WHERE order_dt BETWEEN CAST(:from_dt AS DATE) AND CAST(:to_dt AS DATE)
GROUP BY order_dt, status
ORDER BY order_dt, status
