-- Valid cart adds of the days :init_date to :end_date ('YYYYMMDD', both included).
SELECT fecha, search_query, userid, correlation_id, item_id, item_list_index, item_name, price
FROM valid_cart_adds
WHERE event_dt BETWEEN :init_date AND :end_date
