-- Affinity of users to items over the days :init_date to :end_date ('YYYYMMDD', both included).
-- One scan: per user, item and day the adds and the spend, each as a share of the user's day
-- (a window over the day), summed over the days on top of 1.
WITH bought AS (
  SELECT userid, itemid, event_dt, count(*) AS adds, sum(price) AS spend
  FROM valid_purchases
  WHERE event_dt BETWEEN :init_date AND :end_date
  GROUP BY ALL
),
share AS (
  SELECT userid, itemid,
         try_divide(CAST(adds AS DOUBLE), CAST(sum(adds) OVER one_day AS DOUBLE)) AS of_adds,
         try_divide(spend, sum(spend) OVER one_day) AS of_spend
  FROM bought
  WINDOW one_day AS (PARTITION BY userid, event_dt)
)
SELECT userid, itemid, 1.0D + sum(of_adds) + sum(of_spend) AS rating
FROM share
GROUP BY userid, itemid
