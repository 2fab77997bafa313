-- Valid shown results of the days :init_date to :end_date ('YYYYMMDD', both included).
SELECT day AS fecha, search_query, userid, correlation_id, itemid, item_number, item_name, position
FROM valid_impressions
WHERE day BETWEEN to_date(:init_date, 'yyyyMMdd') AND to_date(:end_date, 'yyyyMMdd')
