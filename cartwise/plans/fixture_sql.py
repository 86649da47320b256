"""The derived inputs as SQL views, for the DuckDB oracle (FIXTURES.md).

These are the same definitions as :mod:`cartwise.sources.fixtures`, written
independently in SQL so the oracle does not share code with the Spark side.
"""

from __future__ import annotations

TYPE_CODE = ("CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3 "
             "WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 WHEN 'STANDARD' THEN 6 END")
BRAND = ("CASE WHEN p_partkey % 20 = 0 THEN NULL "
         "ELSE CAST(replace(p_brand, 'Brand#', '') AS BIGINT) END")
PNAME = "concat(p_name, ' ', CAST(p_partkey % 100 AS VARCHAR))"

FX = {
    "fx_order_lines": f"""
        SELECT o.o_custkey AS customer_id, o.o_orderkey AS order_id, l.l_partkey AS product_id,
               CAST(CASE WHEN l.l_partkey % 40 = 0 THEN NULL ELSE {TYPE_CODE} END AS INTEGER) AS category_id,
               l.l_linenumber AS output_type, o.o_orderdate AS ordered_at
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey""",
    "fx_excluded": "SELECT c_custkey AS customer_id FROM customer WHERE c_acctbal < 0",
    "fx_catalog": f"""
        SELECT p_partkey AS product_id, {PNAME} AS product_name,
               CAST({TYPE_CODE} AS VARCHAR) AS category_code, p_type AS category_name,
               {BRAND} AS brand_id,
               CASE WHEN p_partkey % 15 = 0 THEN NULL ELSE CAST(floor(p_partkey / 4) AS BIGINT) END AS item_base_id
        FROM part""",
    "fx_model_map": """
        SELECT concat('  ', CAST(p_partkey AS VARCHAR), ' ') AS product_code,
               concat(CASE WHEN dup = 0 THEN 'M' ELSE 'X' END,
                      CAST(CAST(floor(p_partkey / 3) AS BIGINT) AS VARCHAR)) AS model_code
        FROM part CROSS JOIN (VALUES (0), (1)) d(dup)
        WHERE p_partkey % 11 <> 0 AND (dup = 0 OR p_partkey % 13 = 0)""",
    "fx_person": """
        SELECT c_custkey AS customer_id, CAST(c_nationkey % 5 AS INTEGER) AS prediction,
               CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE c_mktsegment END AS stage_last,
               CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST((c_custkey * 7) % 73 AS DOUBLE) END AS expected_age_last
        FROM customer""",
    "fx_growth": """
        SELECT CAST(a AS DOUBLE) AS age_months,
               round(3.5 + 2 * sqrt(CAST(a AS DOUBLE)), 3) AS weight_kg,
               round(50.0 + 8 * sqrt(CAST(a AS DOUBLE)), 3) AS height_cm
        FROM (VALUES (0),(2),(4),(6),(9),(12),(18),(24),(36),(48),(60)) g(a)""",
    "fx_product_label": "SELECT p_partkey AS product_id, CAST(p_partkey % 16 AS INTEGER) AS label_no FROM part",
    "fx_weight_label": """
        SELECT p_partkey AS product_id, CAST((p_partkey + more) % 8 AS INTEGER) AS label_no
        FROM part CROSS JOIN (VALUES (0), (3)) d(more) WHERE p_partkey % 4 <> 0 AND (more = 0 OR p_partkey % 7 = 0)""",
    "fx_weight_labels": """
        SELECT label_no, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi FROM (VALUES
          (0, 0.0, 5.5), (1, 4.0, 8.0), (2, 6.0, 11.25), (3, 9.0, 14.0), (4, 12.0, NULL), (5, 7.5, 7.5), (7, 3.05, NULL)
        ) t(label_no, lo, hi)""",
    "fx_weighed": """
        SELECT c_custkey AS customer_id, age AS expected_age_last,
               CASE WHEN c_custkey % 7 = 0 THEN NULL
                    ELSE round(3.2::DOUBLE + 0.21::DOUBLE * coalesce(age, 0) + (c_custkey % 37) / 16::DOUBLE, 3) END AS weight_kg
        FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE CAST((c_custkey * 7) % 73 AS DOUBLE) END AS age
              FROM customer)""",
    "fx_text_orders": """
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 10 = 3 THEN 'day ' || strftime(o_orderdate, '%Y-%m-%d')
                    WHEN o_orderkey % 10 = 5 THEN NULL
                    WHEN o_orderkey % 2 = 0 THEN strftime(o_orderdate, '%Y-%m-%d') || ' 10:' || lpad(CAST(o_orderkey % 60 AS VARCHAR), 2, '0') || ':07'
                    ELSE strftime(o_orderdate, '%Y-%m-%d') END AS ordered_text
        FROM orders""",
    "fx_listed_label": """
        SELECT p_partkey AS product_id, CAST(p_partkey % 16 AS INTEGER) AS label_no,
               CAST(p_partkey % 310 AS VARCHAR) AS category_code,
               CASE p_size % 6 WHEN 0 THEN 'age_range' WHEN 1 THEN 'age_usp' WHEN 2 THEN 'recommended_age'
                    WHEN 3 THEN 'weight_usp' WHEN 4 THEN 'color' ELSE 'size' END AS propertyid
        FROM part""",
    "fx_size_labels": f"""
        SELECT p_partkey AS product_id, {BRAND} AS brand_id,
               CASE p_size % 9 WHEN 0 THEN 'FREE' WHEN 1 THEN 'NB' WHEN 2 THEN 'XS' WHEN 3 THEN 'S'
                    WHEN 4 THEN 'M' WHEN 5 THEN 'L' WHEN 6 THEN 'XL' WHEN 7 THEN 'XXL' ELSE 'XXXL' END AS size_label
        FROM part WHERE p_type = 'SMALL'""",
    "fx_milk_product": f"""
        SELECT p_partkey AS product_id, {BRAND} AS brand_id, CAST(p_partkey % 6 AS INTEGER) AS label_no
        FROM part WHERE p_type = 'MEDIUM'""",
    "fx_cycle": """
        SELECT o.o_custkey AS customer_id, l.l_partkey AS product_id,
               CASE p.p_type WHEN 'SMALL' THEN '36' ELSE '99' END AS category_code,
               CAST(max(CAST(round(l.l_discount * 100) AS INTEGER)) AS DOUBLE) / 10 AS score,
               CAST(row_number() OVER (PARTITION BY o.o_custkey
                    ORDER BY max(CAST(round(l.l_discount * 100) AS INTEGER)) DESC, l.l_partkey) AS INTEGER) AS rank_cycle
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
        WHERE p.p_type IN ('SMALL', 'MEDIUM')
        GROUP BY 1, 2, 3""",
    "fx_purchases": """
        SELECT DISTINCT o.o_custkey AS customer_id, l.l_partkey AS product_id,
               CAST(o.o_orderdate AS DATE) AS purchase_date
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "fx_properties": f"""
        SELECT concat(CAST(p_partkey AS VARCHAR), ' ') AS product_code, {PNAME} AS product_name,
               CAST(prop AS INTEGER) AS property_id,
               CASE prop WHEN 1 THEN 'brand_size' WHEN 2 THEN 'name_type' WHEN 3 THEN 'price' ELSE 'note' END AS property_name,
               CASE prop WHEN 1 THEN concat(p_brand, '/', CAST(p_size % 10 AS VARCHAR))
                         WHEN 2 THEN concat(p_name, '/', p_type)
                         WHEN 3 THEN CAST(CAST(round(p_retailprice * 10) AS BIGINT) AS VARCHAR)
                         ELSE 'Đang cập nhật' END AS value_id,
               p_type AS category_id, {BRAND} AS brand_id, CAST(p_partkey % 6 AS INTEGER) AS status_id,
               CASE p_partkey % 3 WHEN 0 THEN '1,2,-4' WHEN 1 THEN '1,3' ELSE '2, x,3' END AS list_property
        FROM part CROSS JOIN (VALUES (1),(2),(3),(4)) k(prop)
        WHERE prop < 4 OR p_partkey % 10 = 0""",
    "fx_property_map": """
        SELECT DISTINCT CAST(prop AS INTEGER) AS property_id,
               CASE prop WHEN 1 THEN concat(p_brand, '/', CAST(p_size % 10 AS VARCHAR))
                         ELSE concat(p_name, '/', p_type) END AS value_id,
               CAST(prop AS INTEGER) AS property_id_map,
               CASE prop WHEN 1 THEN concat(p_brand, '/', CAST((p_size + 1) % 10 AS VARCHAR))
                         ELSE concat(p_name, '/', CASE p_type WHEN 'ECONOMY' THEN 'LARGE' WHEN 'LARGE' THEN 'MEDIUM'
                              WHEN 'MEDIUM' THEN 'PROMO' WHEN 'PROMO' THEN 'SMALL' WHEN 'SMALL' THEN 'STANDARD'
                              ELSE 'ECONOMY' END) END AS value_id_map
        FROM part CROSS JOIN (VALUES (1),(2)) k(prop)""",
    "fx_reply_items": f"""
        SELECT c.c_custkey AS request_id, CAST(i.pos AS INTEGER) AS pos, {PNAME} AS product_name,
               p.p_partkey AS product_id
        FROM customer c CROSS JOIN (VALUES (0),(1),(2),(3),(4)) i(pos)
        JOIN part p ON p.p_partkey = (c.c_custkey * 7 + i.pos) % (SELECT max(p_partkey) + 1 FROM part)
        WHERE c.c_custkey % 10 <> 0""",
    "fx_misspelt": """
        SELECT p_partkey AS product_id,
               concat(substr(p_name, 1, 3), substr(p_name, 5), ' ', CAST(p_partkey % 100 AS VARCHAR)) AS query_name
        FROM part""",
    "fx_age_labels": """
        SELECT label_no, label, CAST(lo AS DOUBLE) AS lo, CAST(hi AS DOUBLE) AS hi, rejected FROM (VALUES
          (0, 'Trẻ sơ sinh', 0.0, 2.0, false), (1, 'Dưới 6 tháng', 0.0, 6.0, false),
          (2, 'Dưới 1,5 tuổi', 0.0, 18.0, false), (3, 'Từ 6 tháng đến 2 tuổi', 6.0, 24.0, false),
          (4, 'Từ 3 tuổi', 36.0, NULL, false), (5, 'Từ 18 tháng', 18.0, NULL, false),
          (6, '0 - 6 tháng', 0.0, 6.0, false), (7, '1 - 3 tuổi', 12.0, 36.0, false),
          (8, '6 tháng - 2 tuổi', 6.0, 24.0, false), (9, '2 tuổi', 24.0, 24.0, false),
          (10, '9 tháng', 9.0, 9.0, false), (11, 'Đang cập nhật', NULL, NULL, false),
          (12, '12 - 18', NULL, NULL, false), (13, 'Size L', NULL, NULL, true),
          (14, 'Freesize', NULL, NULL, true), (15, 'Mọi lứa tuổi', NULL, NULL, true)
        ) t(label_no, label, lo, hi, rejected)""",
    "fx_milk_labels": """
        SELECT * FROM (VALUES
          (0, 'Trẻ sơ sinh', 0, 1), (1, '0 - 6 tháng', 0, 6), (2, '6 - 12 tháng', 6, 6),
          (3, '1 - 2 tuổi', 12, 12), (4, 'Từ 1 tuổi', 12, NULL), (5, 'Từ 2 tuổi', 24, NULL)
        ) t(label_no, label, min_age_months, range_months)""",
}


def with_fx(body: str, *names: str) -> str:
    """Prefix ``body`` with the CTEs of the named views."""
    ctes = ",\n".join(f"{n} AS ({FX[n]})" for n in names)
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
