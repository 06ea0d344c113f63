"""For each registered query the same result in plain SQL, for an independent engine."""

from __future__ import annotations

FEED = """
feed AS (
  SELECT user_id AS id, concat('  ', event_type, ' ') AS title,
         CAST(value AS DECIMAL(10,2)) AS price,
         concat(' ', upper(event_type)) AS category, ts AS ingested_at, event_id
  FROM events)"""

CATALOG = """
catalog AS (
  SELECT p_partkey AS id, CASE WHEN p_partkey % 13 = 0 THEN '' ELSE trim(p_name) END AS title,
         lower(trim(p_type)) AS category,
         CAST(CASE WHEN p_partkey % 11 = 0 THEN 0 WHEN p_partkey % 17 <> 0 THEN p_retailprice END
              AS DECIMAL(10,2)) AS price,
         CASE WHEN p_partkey % 7 <> 0 AND lower(trim(p_type)) <> 'small'
              THEN CAST(CAST((sq * 10) // n AS DOUBLE) / 100 AS DECIMAL(10,2)) END AS rating_rate,
         CASE WHEN p_partkey % 7 <> 0 AND lower(trim(p_type)) <> 'small' THEN CAST(n AS INT) END AS rating_count
  FROM part JOIN (
    SELECT l_partkey, sum(CAST(l_quantity AS INT)) AS sq, count(*) AS n
    FROM lineitem GROUP BY l_partkey) r ON p_partkey = l_partkey)"""

KPIS = f"""{CATALOG},
kpis AS (
  SELECT category, count(*) AS product_count,
         CAST(round(CAST(avg(price) AS DECIMAL(14,6)), 2) AS DOUBLE) AS avg_price,
         CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
         CAST(sum(price) AS DOUBLE) AS total_inventory_value,
         CAST(round(CAST(avg(rating_rate) AS DECIMAL(14,6)), 2) AS DOUBLE) AS avg_rating,
         CAST(sum(rating_count) AS BIGINT) AS total_reviews
  FROM catalog WHERE price > 0 AND length(title) > 0 GROUP BY category)"""

TOP = f"""{CATALOG},
top AS (
  SELECT id, title, category, CAST(price AS DOUBLE) AS price,
         CAST(rating_rate AS DOUBLE) AS rating_rate, rating_count
  FROM catalog WHERE price > 0 AND length(title) > 0 AND rating_count >= 30
  ORDER BY rating_rate DESC, rating_count DESC, id LIMIT 10)"""

BUCKET_ROWS = """
  SELECT CASE WHEN price < 25 THEN '0-25' WHEN price < 75 THEN '25-75'
              WHEN price < 200 THEN '75-200' ELSE '200+' END AS price_bucket,
         count(*) AS product_count,
         CAST(round(CAST(avg(price) AS DECIMAL(14,6)), 2) AS DOUBLE) AS avg_price"""

BUCKETS = f"""{FEED},
buckets AS ({BUCKET_ROWS} FROM feed GROUP BY 1)"""

# Raw records of the events, typed; reviews k, rating k / 16 (exact in binary).
RAW_FEED = """
raw_feed AS (
  SELECT event_id, user_id, event_type, ts, value,
         CAST(json_extract(props, '$.k') AS INT) AS k
  FROM events)"""

# The newest record of each user.
SILVER = f"""{RAW_FEED},
silver AS (
  SELECT CAST(user_id AS INT) AS id, event_type AS title,
         CAST(value AS DECIMAL(10,2)) AS price, lower(event_type) AS category,
         CAST(k AS DOUBLE) / 16 AS rating_rate, k AS rating_count,
         k IS NOT NULL AS has_rating, value > 0 AND length(event_type) > 0 AS is_valid, event_id, k
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM raw_feed) x
  WHERE rn = 1)"""

SILVER_ROWS = f"""WITH {SILVER}
SELECT id, title, CAST(price AS DOUBLE) AS price, category, rating_rate, rating_count,
       has_rating, is_valid, event_id FROM silver"""

RAW_ROWS = f"""WITH {RAW_FEED}
SELECT event_id, user_id AS id, concat(' ', upper(event_type)) AS category,
       CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS price, k AS rating_count,
       CAST(ts AS DATE) AS ingest_date FROM raw_feed"""

LANDING = "SELECT CAST(ts AS DATE) AS ingest_date, count(*) AS n FROM events GROUP BY 1"

UPSERT = """
WITH u AS (
  SELECT 0 AS src, * FROM events WHERE ts < TIMESTAMP '2024-01-20'
  UNION ALL
  SELECT 1 AS src, * FROM events WHERE ts >= TIMESTAMP '2024-01-20')
SELECT user_id, event_id, event_type, value
FROM (SELECT u.*, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
      FROM u) x
WHERE rn = 1"""

# From the items: ratings of the valid ones, each with the same weight.
CARD = f"""WITH {CATALOG}
SELECT count(*) AS total_products,
       CAST(round(sum(rating_rate) / CAST(count(rating_rate) AS DECIMAL(20,6)), 2) AS DOUBLE) AS avg_rating
FROM catalog WHERE price > 0 AND length(title) > 0"""

REPORT = f"""WITH {CATALOG},
valid AS (SELECT * FROM catalog WHERE price > 0 AND length(title) > 0)
SELECT count(*) AS total_products,
       count(DISTINCT category) FILTER (rating_count > 0) AS reviewed_categories,
       CAST(sum(rating_count) AS BIGINT) AS total_reviews, CAST(sum(price) AS DOUBLE) AS total_value
FROM valid"""

SQL: dict[str, str] = {
    "kpis": f"WITH {KPIS} SELECT * FROM kpis",
    "top": f"WITH {TOP} SELECT * FROM top",
    "buckets": f"WITH {BUCKETS} SELECT * FROM buckets",
    "q1": f"WITH {KPIS} SELECT category, product_count, avg_price, total_inventory_value FROM kpis",
    "q2": f"WITH {KPIS} SELECT category, avg_rating, total_reviews FROM kpis WHERE total_reviews > 0",
    "q3": f"WITH {TOP} SELECT * FROM top ORDER BY rating_rate DESC, rating_count DESC, id",
    "q4": f"""WITH {BUCKETS}, whole AS (SELECT CAST(sum(product_count) AS DOUBLE) AS n FROM buckets)
        SELECT price_bucket, product_count, avg_price,
               CAST(round(CAST(product_count * 100 / whole.n AS DECIMAL(18,6)), 2) AS DOUBLE)
                 AS pct_of_total
        FROM buckets, whole""",
    "q5": f"""WITH {KPIS}
        SELECT category, avg_rating, total_inventory_value,
               CAST(round(CAST(CAST(avg_rating AS DECIMAL(4,2))
                    * CAST(total_inventory_value AS DECIMAL(20,2)) AS DECIMAL(28,4)), 2) AS DOUBLE)
                 AS rating_value_score
        FROM kpis""",
    "q6": f"""WITH {TOP}
        SELECT b.category, b.id, b.title, b.rating_rate, b.rating_count
        FROM top b
        WHERE NOT EXISTS (
          SELECT 1 FROM top o WHERE o.category = b.category
            AND (-o.rating_rate, -o.rating_count, o.id) < (-b.rating_rate, -b.rating_count, b.id))""",
    "card": CARD,
    "value_share": f"""WITH {CATALOG}, whole AS (SELECT CAST(sum(rating_count) AS DOUBLE) AS n FROM catalog)
        SELECT id, round(rating_count * 100 / whole.n, 6) AS pct_of_total
        FROM catalog, whole WHERE rating_count IS NOT NULL""",
    "slicer": f"WITH {KPIS} SELECT category, total_inventory_value FROM kpis WHERE category = 'promo'",
    "dedup": f"""WITH {FEED}
        SELECT id, lower(trim(category)) AS category, trim(title) AS title,
               CAST(price AS DOUBLE) AS price, event_id
        FROM (SELECT *, row_number() OVER (
                PARTITION BY id ORDER BY ingested_at DESC, event_id DESC) AS rn FROM feed) x
        WHERE rn = 1""",
    "required": """
        SELECT d.doc_id, d.lang, l.quality
        FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
        WHERE l.quality IS NOT NULL AND d.text IS NOT NULL""",
    "flags": """
        SELECT has_rating, is_valid, count(*) AS n
        FROM (SELECT l.quality IS NOT NULL AS has_rating,
                     (d.n_chars > 0 AND length(trim(d.text)) > 0) AS is_valid
              FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) x
        GROUP BY 1, 2""",
    "flatten": "SELECT event_id, CAST(json_extract(props, '$.k') AS INT) AS rating_count FROM events",
    "rejects": """
        SELECT * FROM (
          SELECT CASE WHEN o_orderpriority LIKE '1%' THEN concat('x', CAST(o_orderkey AS VARCHAR))
                      ELSE CAST(o_orderkey AS VARCHAR) END AS id,
                 CASE WHEN o_orderstatus = 'P' THEN 'required:category'
                      WHEN o_orderpriority LIKE '1%' THEN 'type:id'
                      WHEN o_totalprice * 1000 >= 99999999.995 THEN 'type:price' END AS reason
          FROM orders) x
        WHERE reason IS NOT NULL""",
    "upsert": UPSERT,
    "upsert_join": UPSERT,
    "landing": LANDING,
    "raw_scan": RAW_ROWS,
    "raw_discovered": RAW_ROWS,
    "raw_day": f"SELECT * FROM ({RAW_ROWS}) x WHERE ingest_date = DATE '2024-01-16'",
    "bronze_append": """
        SELECT user_id AS id, CAST(CAST(value AS DECIMAL(10,2)) AS DOUBLE) AS price,
               CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN event_id END AS event_id
        FROM events""",
    "bronze_count": "SELECT count(*) AS n FROM events",
    "silver": SILVER_ROWS,
    "gold_kpis": f"""WITH {SILVER}
        SELECT category, count(*) AS product_count,
               CAST(round(CAST(avg(price) AS DECIMAL(14,6)), 2) AS DOUBLE) AS avg_price,
               CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
               CAST(sum(price) AS DOUBLE) AS total_inventory_value,
               CAST(round(CAST(CAST(sum(k) AS DOUBLE) / (16 * count(*)) AS DECIMAL(18,6)), 2) AS DOUBLE)
                 AS avg_rating,
               CAST(sum(rating_count) AS BIGINT) AS total_reviews
        FROM silver WHERE is_valid GROUP BY category""",
    "serving_buckets": f"WITH {SILVER} {BUCKET_ROWS} FROM silver GROUP BY 1",
    "report_sql": REPORT,
    "contract": f"WITH {KPIS} SELECT * FROM kpis",
    "late": """
        SELECT event_id, ingested_on, ingest_date,
               CAST(ingest_date - ingested_on AS INT) AS days_late
        FROM (SELECT event_id, CAST(ts AS DATE) AS ingested_on,
                     CAST(date_trunc('week', ts) AS DATE) + 7 AS ingest_date FROM events) x
        WHERE ingest_date - ingested_on > 3""",
    "incremental": LANDING,
    "incremental_silver": SILVER_ROWS,
    "incremental_late": "SELECT event_id, CAST(ts AS DATE) AS ingest_date FROM events",
    "admitted": """
        WITH one AS (SELECT event_id, ts FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_id % 10 <> 0),
        mark AS (SELECT max(ts) - INTERVAL 3 DAY AS moment FROM one),
        two AS (
            SELECT event_id, ts, FALSE AS again FROM events WHERE ts >= TIMESTAMP '2024-01-16' OR event_id % 10 = 0
            UNION ALL SELECT event_id, ts, TRUE FROM events WHERE ts < TIMESTAMP '2024-01-16' AND event_id % 10 = 1
            UNION ALL SELECT event_id, ts, TRUE FROM events WHERE ts >= TIMESTAMP '2024-01-16' AND event_id % 10 = 2)
        SELECT event_id, 'accepted' AS outcome, CAST(1 AS BIGINT) AS n FROM one
        UNION ALL
        SELECT event_id, CASE WHEN ts < moment THEN 'late' WHEN again THEN 'repeated' ELSE 'accepted' END, 1
        FROM two, mark""",
    "incremental_fields": f"""WITH {RAW_FEED}
        SELECT event_id, user_id AS id, k AS rating_count FROM raw_feed""",
    "raw_nested": f"""WITH {RAW_FEED}
        SELECT event_id, event_id % 3 AS source, k AS rating_count FROM raw_feed""",
    "raw_mistyped": f"""WITH {RAW_FEED}
        SELECT event_id, CASE WHEN event_id % 10 <> 0 THEN k END AS rating_count,
               CASE WHEN event_id % 10 = 0 THEN 4.5::DOUBLE END AS rating_text
        FROM raw_feed""",
    "raw_array": RAW_ROWS,
    "array_fields": f"""WITH {RAW_FEED}
        SELECT event_id, CAST(CAST(value AS DECIMAL(10,2)) AS VARCHAR) AS price,
               CASE WHEN event_id % 10 <> 0 THEN event_id % 3 END AS source,
               CASE WHEN event_id % 10 <> 0 THEN k END AS rating_count,
               CASE WHEN event_id % 10 = 0 THEN '4.50' END AS rating_text
        FROM raw_feed""",
    "landing_stamped": """
        SELECT '2024-02-01T12:30:00+00:00' AS _ingested_at, DATE '2024-02-01' AS ingest_date, count(*) AS n
        FROM events""",
    "bronze_overwrite": """
        SELECT event_id, user_id AS id, CAST(NULL AS VARCHAR) AS first_only
        FROM events WHERE ts >= TIMESTAMP '2024-01-16'""",
    "silver_flags": f"""WITH {SILVER}
        SELECT id, CASE WHEN event_id % 3 = 0 THEN '' ELSE title END AS title, has_rating,
               event_id % 5 <> 0 AND price > 0 AND event_id % 3 <> 0 AS is_valid
        FROM silver""",
    "load_times": f"""WITH {SILVER}, tiers AS ({BUCKET_ROWS} FROM silver GROUP BY 1)
        SELECT 'bronze' AS layer, count(*) AS n, 0::BIGINT AS missing, 1::BIGINT AS moments FROM events
        UNION ALL SELECT 'silver', count(*), 0, 1 FROM silver
        UNION ALL SELECT 'gold', count(*), 0, 1 FROM tiers""",
}
# One state per user and moment; runs of equal states are one.
SQL["key_history"] = """
    WITH states AS (SELECT user_id, ts, max(event_type) AS event_type FROM events GROUP BY ALL),
    runs AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS earlier FROM states)
    SELECT user_id, event_type, epoch_us(ts) AS valid_from,
           epoch_us(lead(ts) OVER (PARTITION BY user_id ORDER BY ts)) AS valid_to
    FROM runs WHERE event_type IS DISTINCT FROM earlier"""
SQL["as_of"] = """
    WITH seen AS (SELECT user_id, ts, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL)
    SELECT e.event_id, e.user_id, epoch_us(s.ts) AS as_of, s.value
    FROM events e ASOF LEFT JOIN seen s ON e.user_id = s.user_id AND e.ts >= s.ts
    WHERE e.event_type = 'error'"""
SQL["category_tiers"] = f"""WITH {CATALOG},
    cut AS (SELECT category, floor(CAST(min(price) AS DOUBLE) + (CAST(max(price) AS DOUBLE) - CAST(min(price) AS DOUBLE)) * 1 / 3) AS a,
                   floor(CAST(min(price) AS DOUBLE) + (CAST(max(price) AS DOUBLE) - CAST(min(price) AS DOUBLE)) * 2 / 3) AS b
            FROM catalog GROUP BY category)
    SELECT category, CASE WHEN price < a THEN 'low' WHEN price < b THEN 'middle' ELSE 'high' END AS label,
           count(*) AS n, CAST(sum(price) AS DOUBLE) AS total
    FROM catalog JOIN cut USING (category) GROUP BY ALL"""
TWO_CATALOGS = f"""{CATALOG},
earlier AS (SELECT id, category, price FROM catalog),
later AS (
  SELECT id, category, CASE WHEN id % 5 = 0 THEN price + 1 ELSE price END AS price FROM earlier WHERE id % 8 <> 0
  UNION ALL SELECT id + 10000000, category, price FROM earlier WHERE id % 9 = 0)"""
SQL["catalog_changes"] = f"""WITH {TWO_CATALOGS}
    SELECT coalesce(a.id, b.id) AS id, CASE WHEN a.id IS NULL THEN 'insert' WHEN b.id IS NULL THEN 'delete' ELSE 'update' END AS change,
           CAST(a.price AS DOUBLE) AS before, CAST(b.price AS DOUBLE) AS after
    FROM earlier a FULL JOIN later b ON a.id = b.id
    WHERE a.id IS NULL OR b.id IS NULL OR a.price IS DISTINCT FROM b.price"""
SQL["catalog_applied"] = f"WITH {TWO_CATALOGS} SELECT id, category, CAST(price AS DOUBLE) AS price FROM later"
SQL["kpi_levels"] = f"""WITH {CATALOG}, rows AS (
      SELECT category, CASE WHEN price < 25 THEN '0-25' WHEN price < 75 THEN '25-75' WHEN price < 200 THEN '75-200' ELSE '200+' END
             AS price_bucket, price, rating_rate
      FROM catalog WHERE price > 0 AND length(title) > 0)
    SELECT CASE grouping(category, price_bucket) WHEN 0 THEN 'category and tier' WHEN 1 THEN 'category' WHEN 2 THEN 'tier' ELSE 'all' END
             AS level, category, price_bucket, count(*) AS product_count, CAST(sum(price) AS DOUBLE) AS total_inventory_value,
           CAST(min(price) AS DOUBLE) AS min_price, CAST(max(price) AS DOUBLE) AS max_price,
           CAST(round(CAST(sum(rating_rate) / CAST(count(rating_rate) AS DECIMAL(20,6)) AS DECIMAL(18,6)), 2) AS DOUBLE) AS avg_rating
    FROM rows GROUP BY GROUPING SETS ((category, price_bucket), (category), (price_bucket), ())"""
SQL["sketch_spans"] = """
    SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, true AS users_close, true AS median_close
    FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-16' GROUP BY event_type"""
SQL["bronze_content"] = "SELECT count(*) AS n, count(*) AS written, true AS found FROM events"
SQL["batch_fields"] = SQL["incremental_fields"]
SQL["rejects_stored"] = SQL["rejects"]
SQL["replay"] = SQL["gold_kpis"]
SQL["bronze_compacted"] = RAW_ROWS
SQL["incremental_gold"] = SQL["gold_kpis"]
SQL["incremental_top"] = f"""WITH {SILVER}
    SELECT id, title, category, CAST(price AS DOUBLE) AS price, rating_rate, rating_count
    FROM silver WHERE is_valid AND rating_count >= 50 ORDER BY rating_rate DESC, rating_count DESC, id LIMIT 10"""
