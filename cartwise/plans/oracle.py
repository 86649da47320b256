"""DuckDB oracle SQL, one statement per catalogue query.

of the Spark code.  Column names and types match the Spark results.
"""

from __future__ import annotations

from .fixture_sql import with_fx

ORACLE: dict[str, str] = {}

CLEAN_LINES = """
    clean AS (
        SELECT DISTINCT customer_id, order_id, product_id, category_id, ordered_at
        FROM fx_order_lines l
        WHERE output_type IN (1, 2, 4, 5)
          AND NOT EXISTS (SELECT 1 FROM fx_excluded e WHERE e.customer_id = l.customer_id))"""

CATEGORY_FREQ = """
    cat AS (
        SELECT customer_id, category_id, count(DISTINCT order_id) AS category_order_count
        FROM clean GROUP BY customer_id, category_id),
    tot AS (
        SELECT customer_id, count(DISTINCT order_id) AS total_orders FROM clean GROUP BY customer_id),
    catf AS (
        SELECT cat.customer_id, cat.category_id, cat.category_order_count, tot.total_orders,
               round(cat.category_order_count / tot.total_orders * 100, 2) AS category_freq,
               CAST(rank() OVER (PARTITION BY cat.customer_id
                    ORDER BY (cat.category_id IS NULL), cat.category_order_count DESC,
                             cat.category_id ASC NULLS FIRST) AS INTEGER) AS category_rank
        FROM cat JOIN tot ON cat.customer_id = tot.customer_id)"""

TOP_PRODUCT = """
    prod AS (
        SELECT customer_id, category_id, product_id, count(DISTINCT order_id) AS order_count,
               max(ordered_at) AS last_purchase_date
        FROM clean GROUP BY customer_id, category_id, product_id),
    topp AS (
        SELECT * FROM prod
        QUALIFY rank() OVER (PARTITION BY customer_id, category_id
                             ORDER BY order_count DESC, last_purchase_date DESC, product_id ASC) = 1)"""

ORACLE["order_lines_clean"] = with_fx(f"WITH {CLEAN_LINES} SELECT * FROM clean",
                                      "fx_order_lines", "fx_excluded")

ORACLE["category_frequency"] = with_fx(f"WITH {CLEAN_LINES}, {CATEGORY_FREQ} SELECT * FROM catf",
                                       "fx_order_lines", "fx_excluded")

ORACLE["top_product_per_category"] = with_fx(f"WITH {CLEAN_LINES}, {TOP_PRODUCT} SELECT * FROM topp",
                                             "fx_order_lines", "fx_excluded")

ORACLE["frequency_profile"] = with_fx(f"""
    WITH {CLEAN_LINES}, {CATEGORY_FREQ}, {TOP_PRODUCT}
    SELECT t.customer_id, t.category_id, t.product_id, t.order_count,
           c.category_order_count AS total_orders_in_category,
           round(t.order_count / c.category_order_count * 100, 2) AS product_freq_in_category,
           t.last_purchase_date, c.category_freq, c.category_rank, m.model_code
    FROM topp t
    LEFT JOIN catf c ON t.customer_id = c.customer_id AND t.category_id = c.category_id
    LEFT JOIN fx_model_map m ON trim(m.product_code) = CAST(t.product_id AS VARCHAR)
""", "fx_order_lines", "fx_excluded", "fx_model_map")

FREQUENCY_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ("customer_id", "category_rank", "category_id", "product_id", "model_code"))


def _sorted_sql(keep: str) -> str:
    return with_fx(f"""
    WITH {CLEAN_LINES}, {CATEGORY_FREQ}, {TOP_PRODUCT},
    f AS (
        SELECT t.customer_id, t.category_id, t.product_id, t.order_count,
               c.category_order_count AS total_orders_in_category,
               round(t.order_count / c.category_order_count * 100, 2) AS product_freq_in_category,
               t.last_purchase_date, c.category_freq, c.category_rank, m.model_code
        FROM topp t
        LEFT JOIN catf c ON t.customer_id = c.customer_id AND t.category_id = c.category_id
        LEFT JOIN fx_model_map m ON trim(m.product_code) = CAST(t.product_id AS VARCHAR)),
    n AS (SELECT *, row_number() OVER (ORDER BY {FREQUENCY_ORDER}) - 1 AS row_no FROM f)
    SELECT * FROM n {keep}
""", "fx_order_lines", "fx_excluded", "fx_model_map")


ORACLE["frequency_sorted"] = _sorted_sql("")
ORACLE["frequency_slice"] = _sorted_sql("WHERE customer_id BETWEEN 100 AND 299")

ORACLE["model_code_map"] = with_fx("""
    SELECT c.product_id, m.model_code
    FROM fx_catalog c LEFT JOIN fx_model_map m ON trim(m.product_code) = CAST(c.product_id AS VARCHAR)
""", "fx_catalog", "fx_model_map")

# -- R2 -------------------------------------------------------------------------------
ORACLE["companion_top1"] = with_fx("""
    WITH props AS (
        SELECT trim(product_code) AS product_code, product_name, property_id, value_id,
               property_name, category_id FROM fx_properties),
    m AS (SELECT DISTINCT * FROM fx_property_map),
    main AS (
        SELECT DISTINCT p.product_code, p.product_name, p.property_id, p.value_id, p.property_name,
               m.property_id_map, m.value_id_map
        FROM props p JOIN m ON p.property_id = m.property_id AND p.value_id = m.value_id),
    sub AS (
        SELECT DISTINCT property_id AS property_id_map, value_id AS value_id_map,
               product_code AS product_code_sub, product_name AS product_name_sub,
               category_id AS category_id_sub FROM props),
    pairs AS (
        SELECT DISTINCT main.product_code, main.product_name, main.property_id, main.value_id,
               main.property_name, main.property_id_map, main.value_id_map,
               sub.product_code_sub, sub.product_name_sub, sub.category_id_sub
        FROM main JOIN sub ON main.property_id_map = sub.property_id_map
                          AND main.value_id_map = sub.value_id_map
        WHERE main.product_code <> sub.product_code_sub),
    sc AS (
        SELECT product_code, product_name, product_code_sub, product_name_sub, category_id_sub,
               count(*) AS score
        FROM pairs GROUP BY product_code, product_name, product_code_sub, product_name_sub, category_id_sub),
    top1 AS (
        SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY product_code, category_id_sub
                                                    ORDER BY score DESC, product_code_sub) = 1)
    SELECT t.*, mm.model_code FROM top1 t
    LEFT JOIN fx_model_map mm ON trim(mm.product_code) = t.product_code_sub
""", "fx_properties", "fx_property_map", "fx_model_map")

ORACLE["companion_files"] = f"SELECT CAST(48 AS BIGINT) AS files, count(*) AS rows FROM ({ORACLE['companion_top1']})"


# -- R3 / R4 ----------------------------------------------------------------------------
MODE = """
    mode AS (
        SELECT prediction, stage_last AS mode_stage_last FROM (
            SELECT prediction, stage_last, count(*) AS n FROM fx_person
            WHERE stage_last IS NOT NULL GROUP BY prediction, stage_last)
        QUALIFY row_number() OVER (PARTITION BY prediction ORDER BY n DESC, stage_last) = 1)"""

IMPUTED = MODE + """,
    mean AS (
        SELECT prediction, stage_last, avg(expected_age_last) AS m FROM fx_person
        WHERE expected_age_last IS NOT NULL GROUP BY prediction, stage_last),
    filled AS (
        SELECT p.customer_id, p.prediction, coalesce(p.stage_last, mode.mode_stage_last) AS stage_last,
               p.expected_age_last
        FROM fx_person p LEFT JOIN mode ON p.prediction = mode.prediction),
    imp AS (
        SELECT f.customer_id, f.stage_last, round(coalesce(f.expected_age_last, mean.m), 0) AS expected_age_last
        FROM filled f LEFT JOIN mean ON f.prediction = mean.prediction AND f.stage_last = mean.stage_last)"""

ORACLE["group_mode"] = with_fx(f"WITH {MODE} SELECT * FROM mode", "fx_person")
ORACLE["impute_stage_age"] = with_fx(f"WITH {IMPUTED} SELECT * FROM imp", "fx_person")

ORACLE["growth_gap_fill"] = with_fx(f"""
    WITH {IMPUTED},
    b AS (
        SELECT i.customer_id, i.expected_age_last AS a,
               (SELECT max(age_months) FROM fx_growth WHERE age_months <= i.expected_age_last) AS a0,
               (SELECT min(age_months) FROM fx_growth WHERE age_months >= i.expected_age_last) AS a1
        FROM imp i)
    SELECT b.customer_id, b.a AS expected_age_last,
           round(CASE WHEN b.a IS NULL THEN NULL WHEN b.a0 IS NULL THEN g1.weight_kg
                      WHEN b.a1 IS NULL OR b.a1 = b.a0 THEN g0.weight_kg
                      ELSE g0.weight_kg + (g1.weight_kg - g0.weight_kg) * (b.a - b.a0) / (b.a1 - b.a0) END, 6)
               AS weight_kg,
           round(CASE WHEN b.a IS NULL THEN NULL WHEN b.a0 IS NULL THEN g1.height_cm
                      WHEN b.a1 IS NULL OR b.a1 = b.a0 THEN g0.height_cm
                      ELSE g0.height_cm + (g1.height_cm - g0.height_cm) * (b.a - b.a0) / (b.a1 - b.a0) END, 6)
               AS height_cm
    FROM b LEFT JOIN fx_growth g0 ON g0.age_months = b.a0 LEFT JOIN fx_growth g1 ON g1.age_months = b.a1
""", "fx_person", "fx_growth")

ORACLE["forward_fill"] = with_fx(f"""
    WITH {IMPUTED},
    b AS (
        SELECT i.customer_id, i.expected_age_last AS a,
               (SELECT max(age_months) FROM fx_growth WHERE age_months <= i.expected_age_last) AS a0
        FROM imp i)
    SELECT b.customer_id, b.a AS expected_age_last, g.weight_kg, g.height_cm
    FROM b LEFT JOIN fx_growth g ON g.age_months = b.a0
""", "fx_person", "fx_growth")

def _line_sql(c: str) -> str:
    """Line between the nearest known rows by position, the last value behind them."""
    return f"""coalesce({c}, CASE WHEN n{c} IS NULL THEN p{c} ELSE p{c} + (n{c} - p{c}) * (i - ip{c}) / (in{c} - ip{c}) END)"""


def _near_sql(c: str) -> str:
    back = "OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    ahead = "OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    at = f"CASE WHEN {c} IS NOT NULL THEN i END"
    return (f"last_value({c} IGNORE NULLS) {back} AS p{c}, first_value({c} IGNORE NULLS) {ahead} AS n{c}, "
            f"last_value({at} IGNORE NULLS) {back} AS ip{c}, first_value({at} IGNORE NULLS) {ahead} AS in{c}")


ORACLE["growth_by_position"] = with_fx(f"""
    WITH {IMPUTED},
    r AS (SELECT i.customer_id, i.expected_age_last AS age, g.weight_kg, g.height_cm,
                 row_number() OVER (ORDER BY i.expected_age_last DESC NULLS LAST, i.customer_id) AS i
          FROM imp i LEFT JOIN fx_growth g ON g.age_months = i.expected_age_last),
    near AS (SELECT *, {_near_sql('weight_kg')}, {_near_sql('height_cm')} FROM r),
    line AS (SELECT customer_id, age, {_line_sql('weight_kg')} AS weight_kg, {_line_sql('height_cm')} AS height_cm,
                    row_number() OVER (ORDER BY age ASC NULLS LAST, customer_id) AS j FROM near)
    SELECT customer_id, age AS expected_age_last,
           round(last_value(weight_kg IGNORE NULLS) OVER (ORDER BY j), 6) AS weight_kg,
           round(last_value(height_cm IGNORE NULLS) OVER (ORDER BY j), 6) AS height_cm
    FROM line
""", "fx_person", "fx_growth")

# -- R5 / R6 / R8 --------------------------------------------------------------------------
PRODUCT_LABELS = """
    pl AS (
        SELECT p.product_id, l.label, l.lo, l.hi, l.rejected
        FROM fx_product_label p JOIN fx_age_labels l ON p.label_no = l.label_no)"""

RANGES = PRODUCT_LABELS + """,
    mx AS (SELECT max(hi) AS m FROM pl WHERE NOT rejected),
    rng AS (
        SELECT product_id, label,
               CASE WHEN rejected THEN NULL ELSE lo IS NOT NULL END AS parsed,
               CASE WHEN rejected THEN NULL ELSE coalesce(lo, CAST(0 AS DOUBLE)) END AS min_age_months,
               CASE WHEN rejected THEN NULL ELSE coalesce(hi, mx.m) END AS max_age_months
        FROM pl CROSS JOIN mx)"""

CANDIDATES = IMPUTED + "," + RANGES + """,
    ages AS (SELECT DISTINCT expected_age_last AS age FROM imp WHERE expected_age_last IS NOT NULL),
    m AS (
        SELECT a.age, r.product_id, r.parsed, r.max_age_months - r.min_age_months AS w,
               abs(a.age - (r.min_age_months + r.max_age_months) / 2) AS d
        FROM ages a JOIN rng r ON a.age BETWEEN r.min_age_months AND r.max_age_months),
    best AS (
        SELECT age, product_id,
               CAST(row_number() OVER (PARTITION BY age ORDER BY parsed DESC, w, d, product_id) AS INTEGER)
                   AS cand_rank
        FROM m QUALIFY cand_rank <= 20),
    cand AS (
        SELECT i.customer_id, i.expected_age_last AS age, b.product_id, b.cand_rank
        FROM imp i JOIN best b ON i.expected_age_last = b.age)"""

DIVERSIFIED = CANDIDATES + """,
    ext AS (
        SELECT c.customer_id, c.product_id, c.cand_rank, CAST(k.category_code AS INTEGER) AS category_id,
               coalesce(k.item_base_id, c.product_id) AS item_base_id
        FROM cand c LEFT JOIN fx_catalog k ON c.product_id = k.product_id),
    v AS (SELECT * FROM ext QUALIFY row_number() OVER (PARTITION BY customer_id, item_base_id
                                                      ORDER BY cand_rank) <= 2),
    t AS (SELECT *, row_number() OVER (PARTITION BY customer_id, category_id ORDER BY cand_rank) AS turn
          FROM v WHERE category_id IS NOT NULL),
    div AS (
        SELECT customer_id, product_id, category_id, item_base_id, cand_rank, pick FROM (
            SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY turn, category_id) AS INTEGER)
                      AS pick FROM t)
        WHERE pick <= 15)"""

ORACLE["label_reject"] = with_fx(f"WITH {PRODUCT_LABELS} SELECT product_id, label, rejected FROM pl",
                                 "fx_product_label", "fx_age_labels")
ORACLE["age_label_range"] = with_fx(f"""
    WITH {PRODUCT_LABELS}
    SELECT product_id, label, lo AS min_age_months, hi AS max_age_months FROM pl
""", "fx_product_label", "fx_age_labels")
ORACLE["age_ranges"] = with_fx(f"WITH {RANGES} SELECT * FROM rng", "fx_product_label", "fx_age_labels")
ORACLE["age_candidates"] = with_fx(f"WITH {CANDIDATES} SELECT * FROM cand",
                                   "fx_person", "fx_product_label", "fx_age_labels")
ORACLE["weight_label_range"] = with_fx("""
    SELECT w.product_id, l.lo AS min_kg, l.hi AS max_kg FROM fx_weight_label w JOIN fx_weight_labels l USING (label_no)
""", "fx_weight_label", "fx_weight_labels")

ORACLE["age_weight_candidates"] = with_fx(f"""
    WITH {RANGES},
    kg AS (SELECT w.product_id, l.lo, l.hi FROM fx_weight_label w JOIN fx_weight_labels l USING (label_no)
           QUALIFY row_number() OVER (PARTITION BY w.product_id ORDER BY l.hi - l.lo NULLS LAST, l.lo) = 1),
    pt AS (SELECT DISTINCT expected_age_last AS age, weight_kg AS wt FROM fx_weighed WHERE expected_age_last IS NOT NULL),
    m AS (
        SELECT a.age, a.wt, r.product_id, r.parsed, r.max_age_months - r.min_age_months AS w,
               abs(a.age - (r.min_age_months + r.max_age_months) / 2) AS d
        FROM pt a JOIN rng r ON a.age BETWEEN r.min_age_months AND r.max_age_months
        LEFT JOIN kg ON kg.product_id = r.product_id
        WHERE kg.lo IS NULL OR (a.wt >= kg.lo AND (kg.hi IS NULL OR a.wt <= kg.hi))),
    best AS (
        SELECT age, wt, product_id,
               CAST(row_number() OVER (PARTITION BY age, wt ORDER BY parsed DESC, w, d, product_id) AS INTEGER) AS cand_rank
        FROM m QUALIFY cand_rank <= 20)
    SELECT c.customer_id, best.age, best.product_id, best.cand_rank
    FROM fx_weighed c JOIN best ON best.age = c.expected_age_last AND best.wt IS NOT DISTINCT FROM c.weight_kg
""", "fx_product_label", "fx_age_labels", "fx_weight_label", "fx_weight_labels", "fx_weighed")

ORACLE["age_ranges_listed"] = with_fx("""
    WITH pl AS (SELECT f.product_id, f.category_code, f.propertyid, l.* FROM fx_listed_label f JOIN fx_age_labels l USING (label_no)),
    six AS (SELECT DISTINCT label FROM pl WHERE propertyid IN ('age_range_filter_multi', 'recommended_age_usp', 'age_usp',
                'recommended_age', 'age_range', 'children_clothing_size')),
    mx AS (SELECT max(hi) AS m FROM pl WHERE NOT rejected AND label IN (SELECT label FROM six))
    SELECT product_id, label, CASE WHEN ok THEN lo IS NOT NULL END AS parsed,
           CASE WHEN ok THEN coalesce(lo, 0::DOUBLE) END AS min_age_months, CASE WHEN ok THEN coalesce(hi, m) END AS max_age_months
    FROM (SELECT *, NOT rejected AND label IN (SELECT label FROM six) AS ok FROM pl CROSS JOIN mx
          WHERE propertyid IN ('age_range_filter_multi', 'recommended_age_usp', 'age_usp', 'recommended_age', 'age_range',
                               'weight_filter', 'weight_usp', 'children_clothing_size')
            AND CAST(category_code AS INTEGER) IN (114, 112, 209, 189, 271, 272, 270, 122, 123, 110, 108, 107, 121, 120, 124, 125, 126, 127, 106, 105, 113, 109,
    116, 102, 103, 111, 279, 273, 274, 275, 276, 277, 278, 281, 284, 283, 232, 264, 263, 194, 200, 201, 254, 150, 13, 176,
    208, 289, 290, 294, 299, 306, 307, 364, 59, 3, 353, 236, 237, 238, 239, 240, 241, 242, 243, 206, 193, 18, 38, 33, 28,
    24, 268, 296, 300, 302, 303, 308))
""", "fx_listed_label", "fx_age_labels")

ORACLE["diversify"] = with_fx(f"WITH {DIVERSIFIED} SELECT * FROM div",
                              "fx_person", "fx_product_label", "fx_age_labels", "fx_catalog")

GROWTH_SHEET = """
    w AS (SELECT age_months, weight_kg AS v FROM fx_growth WHERE age_months <> 9),
    h AS (SELECT age_months, height_cm AS v FROM fx_growth)"""


def _near_age(t: str) -> str:
    """Value of table ``t`` at an age: on the line between its neighbours, the nearest beyond its ends."""
    below = f"(SELECT max(age_months) FROM {t} WHERE age_months <= i.expected_age_last)"
    above = f"(SELECT min(age_months) FROM {t} WHERE age_months >= i.expected_age_last)"
    return f"""SELECT i.customer_id, round(CASE WHEN i.expected_age_last IS NULL THEN NULL WHEN a.v IS NULL THEN b.v
                   WHEN b.v IS NULL OR a.age_months = b.age_months THEN a.v
                   ELSE a.v + (b.v - a.v) * (i.expected_age_last - a.age_months) / (b.age_months - a.age_months) END, 6) AS v
        FROM imp i LEFT JOIN {t} a ON a.age_months = {below} LEFT JOIN {t} b ON b.age_months = {above}"""


ORACLE["growth_from_sheet"] = with_fx(f"""
    WITH {IMPUTED}, {GROWTH_SHEET}, x AS ({_near_age('w')}), y AS ({_near_age('h')})
    SELECT i.customer_id, i.expected_age_last, x.v AS weight_kg, y.v AS height_cm
    FROM imp i JOIN x USING (customer_id) JOIN y USING (customer_id)
""", "fx_person", "fx_growth")

ORACLE["growth_sheet_cells"] = with_fx(f"""
    WITH {IMPUTED}
    SELECT g.age_months, CASE WHEN g.age_months <> 9 THEN g.weight_kg END AS weight_kg, g.height_cm,
           CASE WHEN g.age_months = 9 THEN 'B6=n/a' END AS bad_cells,
           (SELECT count(*) FROM imp WHERE imp.expected_age_last = g.age_months) AS n_customers
    FROM fx_growth g
""", "fx_person", "fx_growth")

ORACLE["reply_intake"] = with_fx("""
    WITH c AS (SELECT c_custkey AS request_id, c_custkey % 7 AS form, c_custkey % 10 = 0 AS empty FROM customer),
    it AS (SELECT i.*, c.form FROM fx_reply_items i JOIN c USING (request_id)),
    wrong AS (SELECT request_id, p AS pos FROM c CROSS JOIN (VALUES (0), (1), (2), (3)) w(p) WHERE form = 3 AND NOT empty)
    SELECT request_id, CASE form WHEN 4 THEN 'no_content' WHEN 5 THEN 'broken' WHEN 6 THEN 'missing' ELSE 'no_items' END AS state,
           CAST(NULL AS INTEGER) AS pos, CAST(NULL AS BOOLEAN) AS is_object, CAST(NULL AS VARCHAR) AS code, CAST(NULL AS VARCHAR) AS name
    FROM c WHERE form >= 4 OR empty
    UNION ALL
    SELECT request_id, 'ok', pos, true, CAST(product_id AS VARCHAR), product_name FROM it WHERE form <= 1 OR (form = 2 AND pos = 0)
    UNION ALL
    SELECT request_id, 'ok', 4, true, CAST(product_id AS VARCHAR), product_name FROM it WHERE form = 3 AND pos = 0
    UNION ALL
    SELECT request_id, 'ok', pos, false, NULL, NULL FROM wrong
""", "fx_reply_items")

ORACLE["batch_commits"] = with_fx(f"""
    WITH {DIVERSIFIED},
    k AS (SELECT customer_id, CAST((row_number() OVER (ORDER BY customer_id) - 1) // 500 AS BIGINT) AS batch
          FROM (SELECT DISTINCT customer_id FROM div)),
    r AS (SELECT k.batch, customer_id, md5(concat_ws('|', customer_id, product_id, pick)) AS m FROM div JOIN k USING (customer_id))
    SELECT batch, count(DISTINCT customer_id) AS keys, count(*) AS rows,
           concat_ws('-', bit_xor(('0x' || substr(m, 1, 15))::BIGINT)::VARCHAR, sum(('0x' || substr(m, 16, 8))::BIGINT)::VARCHAR) AS digest
    FROM r GROUP BY batch
""", "fx_person", "fx_product_label", "fx_age_labels", "fx_catalog")

ORACLE["run_date_path"] = with_fx("""
    SELECT '20240229' AS run_date, category_code, product_id,
           CASE category_code WHEN '3' THEN upper(product_name) ELSE product_name END AS product_name, brand_id, item_base_id
    FROM fx_catalog
""", "fx_catalog")

ORACLE["text_timestamps"] = with_fx("""
    SELECT order_id, ordered_text, TRY_CAST(ordered_text AS TIMESTAMP) AS ordered_at FROM fx_text_orders
""", "fx_text_orders")

# -- R12-R15 ---------------------------------------------------------------------------------
PRIO = "CASE type WHEN 'ori' THEN 1 WHEN 'rcm' THEN 2 WHEN 'age_rcm' THEN 3 WHEN 'freg_rcm' THEN 4 END"
TYPE_ORD = "CASE WHEN type = 'ori' THEN 0 ELSE 1 END"

LADDER = """
    mlab AS (
        SELECT label_no, label, min_age_months, range_months,
               CAST(row_number() OVER (ORDER BY min_age_months, range_months NULLS LAST, label) AS INTEGER)
                   AS ranking
        FROM fx_milk_labels WHERE label_no IN (SELECT label_no FROM fx_milk_product)),
    dia AS (
        SELECT product_id, coalesce(brand_id, 0) AS brand_id, '36' AS category_code,
               CAST(CASE size_label WHEN 'NB' THEN 1 WHEN 'XS' THEN 2 WHEN 'S' THEN 3 WHEN 'M' THEN 4
                    WHEN 'L' THEN 5 WHEN 'XL' THEN 6 WHEN 'XXL' THEN 7 WHEN 'XXXL' THEN 8 END AS INTEGER) AS ranking
        FROM fx_size_labels),
    milk AS (
        SELECT m.product_id, coalesce(m.brand_id, 0) AS brand_id, '99' AS category_code, l.ranking
        FROM fx_milk_product m JOIN mlab l ON m.label_no = l.label_no),
    ladder AS (
        SELECT * FROM (SELECT * FROM dia UNION ALL SELECT * FROM milk) WHERE ranking IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY product_id, brand_id ORDER BY ranking, category_code) = 1)"""

UPSIZE = LADDER + """,
    origin AS (
        SELECT DISTINCT c.customer_id, c.product_id, coalesce(k.brand_id, 0) AS brand_id
        FROM fx_cycle c LEFT JOIN fx_catalog k ON c.product_id = k.product_id
        WHERE c.score >= 0.5 AND c.category_code IN ('36', '99')),
    ori AS (
        SELECT o.customer_id, o.product_id, l.ranking, l.brand_id, l.category_code,
               (SELECT min(l2.ranking) FROM ladder l2 WHERE l2.category_code = l.category_code
                  AND l2.brand_id = l.brand_id AND l2.ranking > l.ranking) AS next_ranking
        FROM origin o JOIN ladder l ON o.product_id = l.product_id AND o.brand_id = l.brand_id),
    cands AS (
        SELECT category_code, brand_id, ranking, product_id,
               row_number() OVER (PARTITION BY category_code, brand_id, ranking ORDER BY product_id) - 1 AS idx,
               count(*) OVER (PARTITION BY category_code, brand_id, ranking) AS n
        FROM ladder),
    rcm AS (
        SELECT o.customer_id, c.product_id, c.ranking, o.brand_id, o.category_code, 'rcm' AS type,
               o.product_id AS product_id_ori
        FROM ori o JOIN cands c ON c.category_code = o.category_code AND c.brand_id = o.brand_id
          AND c.ranking = o.next_ranking
          AND c.idx = CAST(('0x' || substr(md5(concat_ws('|', '0', CAST(o.customer_id AS VARCHAR),
                                                           CAST(o.product_id AS VARCHAR))), 1, 15)) AS BIGINT) % c.n),
    allrows AS (
        SELECT customer_id, product_id, ranking, brand_id, category_code, 'ori' AS type,
               product_id AS product_id_ori FROM ori
        UNION ALL SELECT * FROM rcm),
    up AS (
        SELECT * FROM allrows
        QUALIFY row_number() OVER (PARTITION BY customer_id, product_id
                                   ORDER BY ranking, CASE WHEN type = 'ori' THEN 0 ELSE 1 END, product_id_ori) = 1)"""

LINKED = UPSIZE + f""",
    rk AS (
        SELECT customer_id, product_id AS product_id_ori, min(rank_cycle) AS rank_chu_ky
        FROM fx_cycle WHERE score >= 0.5 GROUP BY customer_id, product_id),
    rn AS (
        SELECT up.*, CAST(CASE WHEN type = 'ori' THEN 0 ELSE
                 sum(CASE WHEN type = 'rcm' THEN 1 ELSE 0 END) OVER (
                     PARTITION BY customer_id, category_code ORDER BY ranking, {TYPE_ORD}, product_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS BIGINT) AS row_num
        FROM up),
    j AS (SELECT rn.*, rk.rank_chu_ky FROM rn LEFT JOIN rk
          ON rn.customer_id = rk.customer_id AND rn.product_id_ori = rk.product_id_ori),
    o1 AS (SELECT * FROM j WHERE type = 'ori'
           QUALIFY row_number() OVER (PARTITION BY customer_id, product_id_ori ORDER BY ranking, product_id) = 1),
    rc AS (SELECT j.*, j.ranking - o1.ranking AS step FROM j JOIN o1
           ON j.customer_id = o1.customer_id AND j.product_id_ori = o1.product_id_ori
           WHERE j.type = 'rcm' AND j.ranking > o1.ranking),
    r1 AS (SELECT rc.*,
                  max(CASE WHEN step = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id, product_id_ori) AS has1,
                  row_number() OVER (PARTITION BY customer_id, product_id_ori ORDER BY step, product_id) AS srn
           FROM rc),
    kept AS (
        SELECT customer_id, product_id, ranking, brand_id, category_code, type, product_id_ori, row_num,
               rank_chu_ky FROM r1 WHERE (has1 = 1 AND step = 1) OR (has1 = 0 AND srn = 1)
        UNION ALL
        SELECT customer_id, product_id, ranking, brand_id, category_code, type, product_id_ori, row_num,
               rank_chu_ky FROM o1),
    lo AS (
        SELECT *, CAST(row_number() OVER (PARTITION BY customer_id
                       ORDER BY rank_chu_ky NULLS LAST, ranking, {TYPE_ORD}, product_id) AS INTEGER) AS rank
        FROM kept)"""

LATEST = LINKED + """,
    lp AS (SELECT customer_id, product_id AS product_id_ori, max(purchase_date) AS formatted_date
           FROM fx_purchases GROUP BY customer_id, product_id),
    lat AS (
        SELECT lo.*, lp.formatted_date FROM lo LEFT JOIN lp
          ON lo.customer_id = lp.customer_id AND lo.product_id_ori = lp.product_id_ori
        WHERE lo.category_code IS NOT NULL
        QUALIFY rank() OVER (PARTITION BY lo.customer_id, lo.category_code
                             ORDER BY lp.formatted_date DESC NULLS LAST) = 1)"""

UPSIZE_VIEWS = ("fx_milk_labels", "fx_milk_product", "fx_size_labels", "fx_cycle", "fx_catalog")

ORACLE["strict_label_rank"] = with_fx(f"""
    WITH {LADDER}
    SELECT m.product_id, l.label, l.min_age_months, l.range_months, l.ranking
    FROM fx_milk_product m JOIN mlab l ON m.label_no = l.label_no
""", *UPSIZE_VIEWS)
ORACLE["size_ladder"] = with_fx(f"WITH {LADDER} SELECT * FROM ladder", *UPSIZE_VIEWS)
ORACLE["next_rung"] = with_fx(f"""
    WITH {LADDER}
    SELECT l.*, (SELECT min(l2.ranking) FROM ladder l2 WHERE l2.category_code = l.category_code
                   AND l2.brand_id = l.brand_id AND l2.ranking > l.ranking) AS next_ranking
    FROM ladder l
""", *UPSIZE_VIEWS)
ORACLE["upsize_pairs"] = with_fx(f"WITH {UPSIZE} SELECT * FROM up", *UPSIZE_VIEWS)
ORACLE["origin_islands"] = with_fx(f"""
    WITH {UPSIZE},
    rn AS (
        SELECT up.*, CAST(CASE WHEN type = 'ori' THEN 0 ELSE
                 sum(CASE WHEN type = 'rcm' THEN 1 ELSE 0 END) OVER (
                     PARTITION BY customer_id, category_code ORDER BY ranking, {TYPE_ORD}, product_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS BIGINT) AS row_num,
               CAST(sum(CASE WHEN type = 'ori' THEN 1 ELSE 0 END) OVER (
                     PARTITION BY customer_id, category_code, brand_id ORDER BY ranking, {TYPE_ORD}, product_id
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS subgroup
        FROM up)
    SELECT customer_id, product_id, type, row_num, subgroup,
           first_value(product_id) OVER (PARTITION BY customer_id, category_code, brand_id, subgroup
                                         ORDER BY ranking, {TYPE_ORD}, product_id
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS product_id_ori_pos
    FROM rn
""", *UPSIZE_VIEWS)
ORACLE["link_origin"] = with_fx(f"WITH {LINKED} SELECT * FROM lo", *UPSIZE_VIEWS)
ORACLE["latest_purchase"] = with_fx(f"WITH {LATEST} SELECT * FROM lat", *UPSIZE_VIEWS, "fx_purchases")

# -- R16-R18 ------------------------------------------------------------------------------------
APPENDED = LATEST + "," + DIVERSIFIED.replace("mean AS", "mean AS", 1) + f""",
    f AS (SELECT lat.*, row_number() OVER (PARTITION BY customer_id ORDER BY rank, product_id) AS rr FROM lat),
    mxr AS (SELECT customer_id, max(rr) AS m FROM f GROUP BY customer_id),
    s AS (SELECT d.customer_id, d.product_id,
                 row_number() OVER (PARTITION BY d.customer_id ORDER BY d.pick, d.product_id) + mxr.m AS rr
          FROM div d JOIN mxr ON d.customer_id = mxr.customer_id),
    u AS (
        SELECT customer_id, product_id, rr, type, category_code, brand_id, product_id_ori, rank_chu_ky,
               formatted_date, row_num FROM f
        UNION ALL
        SELECT customer_id, product_id, rr, 'age_rcm', NULL, NULL, NULL, NULL, NULL, NULL FROM s),
    app AS (
        SELECT customer_id, product_id, CAST(rr AS INTEGER) AS rank, type, category_code, brand_id,
               product_id_ori, rank_chu_ky, formatted_date, row_num
        FROM u QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY rr, {PRIO}, product_id) <= 30)"""

COLD = """
    served AS (SELECT DISTINCT customer_id FROM fx_cycle WHERE score >= 0.5 AND category_code IN ('36', '99')),
    coldc AS (SELECT DISTINCT customer_id FROM fx_cycle
              WHERE customer_id NOT IN (SELECT customer_id FROM served)),
    fl AS (SELECT customer_id, product_id, count(DISTINCT purchase_date) AS freq, max(purchase_date) AS last_date
           FROM fx_purchases GROUP BY customer_id, product_id),
    cs AS (
        SELECT fl.customer_id, fl.product_id,
               CAST(row_number() OVER (PARTITION BY fl.customer_id
                                       ORDER BY freq DESC, last_date DESC, product_id) AS INTEGER) AS rank,
               'freg_rcm' AS type, last_date AS formatted_date
        FROM fl JOIN coldc ON fl.customer_id = coldc.customer_id)"""

BLEND_VIEWS = (*UPSIZE_VIEWS, "fx_purchases", "fx_person", "fx_product_label", "fx_age_labels")

ORACLE["append_ranked"] = with_fx(f"""
    WITH {APPENDED}
    SELECT customer_id, product_id, rank, type, category_code, product_id_ori, rank_chu_ky, formatted_date
    FROM app
""", *BLEND_VIEWS)

ORACLE["cap_30"] = with_fx("""
    WITH lp AS (SELECT customer_id, product_id, max(purchase_date) AS formatted_date
                FROM fx_purchases GROUP BY customer_id, product_id)
    SELECT customer_id, product_id, formatted_date,
           CAST(row_number() OVER (PARTITION BY customer_id ORDER BY formatted_date DESC, product_id) AS INTEGER)
               AS rn
    FROM lp QUALIFY rn <= 30
""", "fx_purchases")

ORACLE["cold_start"] = with_fx(f"WITH {COLD} SELECT * FROM cs", "fx_cycle", "fx_purchases")

ORACLE["blended"] = with_fx(f"""
    WITH {APPENDED}, {COLD},
    allr AS (
        SELECT customer_id, product_id, rank, type, category_code, brand_id, product_id_ori, rank_chu_ky,
               formatted_date, row_num FROM app
        UNION ALL
        SELECT customer_id, product_id, rank, type, NULL, NULL, NULL, NULL, formatted_date, NULL FROM cs),
    d1 AS (SELECT * FROM allr QUALIFY row_number() OVER (PARTITION BY customer_id, product_id
                                                        ORDER BY rank, {PRIO}, product_id) = 1),
    d2 AS (SELECT * FROM d1 QUALIFY row_number() OVER (PARTITION BY customer_id
                                                      ORDER BY rank, {PRIO}, product_id) <= 30)
    SELECT d2.customer_id, d2.product_id, d2.rank, coalesce(d2.brand_id, k.brand_id) AS brand_id,
           coalesce(d2.category_code, k.category_code) AS category_code, k.category_name, k.product_name,
           d2.rank_chu_ky, d2.formatted_date, d2.type, CAST(d2.row_num AS BIGINT) AS row_num,
           d2.product_id_ori, mm.model_code
    FROM d2 LEFT JOIN fx_catalog k ON d2.product_id = k.product_id
    LEFT JOIN fx_model_map mm ON trim(mm.product_code) = CAST(d2.product_id AS VARCHAR)
""", *BLEND_VIEWS, "fx_model_map")

# -- R9-R11 --------------------------------------------------------------------------------------
ACTIVE = """
    act AS (SELECT category_id, trim(product_code) AS code, product_name, property_id, property_name,
                   value_id AS value, brand_id, list_property
            FROM fx_properties WHERE status_id IN (4, 5)),
    lp AS (
        SELECT DISTINCT category_id, property_id FROM (
            SELECT category_id, TRY_CAST(trim(unnest(string_split(list_property, ','))) AS INTEGER) AS property_id
            FROM (SELECT DISTINCT category_id, list_property FROM act))
        WHERE property_id > 0),
    attrs AS (
        SELECT DISTINCT category_id, property_id, property_name FROM act a
        WHERE EXISTS (SELECT 1 FROM lp WHERE lp.category_id = a.category_id AND lp.property_id = a.property_id))"""

REAL = "value IS NOT NULL AND trim(value) <> '' AND value <> 'Đang cập nhật'"

ORACLE["property_list_explode"] = with_fx(f"WITH {ACTIVE} SELECT * FROM lp", "fx_properties")
ORACLE["attributes_in_list"] = with_fx(f"WITH {ACTIVE} SELECT * FROM attrs", "fx_properties")

ORACLE["attribute_importance"] = with_fx(f"""
    WITH {ACTIVE},
    ncat AS (SELECT category_id, count(DISTINCT code) AS n FROM act GROUP BY category_id),
    vals AS (SELECT a.* FROM act a WHERE {REAL} AND EXISTS (
                 SELECT 1 FROM attrs t WHERE t.category_id = a.category_id AND t.property_id = a.property_id
                   AND t.property_name = a.property_name)),
    pv AS (SELECT category_id, property_id, property_name, value, count(DISTINCT code) AS c
           FROM vals GROUP BY category_id, property_id, property_name, value),
    pa AS (SELECT category_id, property_id, property_name, count(DISTINCT code) AS w
           FROM vals GROUP BY category_id, property_id, property_name),
    ent AS (SELECT pv.category_id, pv.property_id, pv.property_name,
                   -sum((pv.c / pa.w) * ln(pv.c / pa.w)) AS h, any_value(pa.w) AS w
            FROM pv JOIN pa ON pv.category_id = pa.category_id AND pv.property_id = pa.property_id
                           AND pv.property_name = pa.property_name
            GROUP BY pv.category_id, pv.property_id, pv.property_name),
    sc AS (SELECT t.category_id, t.property_id, t.property_name,
                  round(coalesce(e.w, 0) / n.n * coalesce(e.h, 0.0) / ln(greatest(2, n.n)), 9) AS weight
           FROM attrs t LEFT JOIN ent e ON t.category_id = e.category_id AND t.property_id = e.property_id
                                       AND t.property_name = e.property_name
           JOIN ncat n ON t.category_id = n.category_id),
    nw AS (SELECT category_id, property_id, property_name,
                  CASE WHEN sum(weight) OVER (PARTITION BY category_id) > 0
                       THEN round(weight / sum(weight) OVER (PARTITION BY category_id), 6) ELSE weight END AS weight,
                  CAST(row_number() OVER (PARTITION BY category_id ORDER BY weight DESC, property_name) AS INTEGER)
                      AS attr_rank
           FROM sc)
    SELECT * FROM nw WHERE attr_rank <= 5
""", "fx_properties")

ORACLE["reply_attributes"] = with_fx(f"""
    WITH {ACTIVE},
    items AS (SELECT DISTINCT category_id AS request_id, property_id, trim(property_name) AS attribute,
                     CAST(CASE property_id WHEN 2 THEN 0.4 WHEN 3 THEN 2.0 ELSE NULL END AS DOUBLE) AS weight
              FROM fx_properties),
    kept AS (SELECT i.* FROM items i WHERE EXISTS (
                 SELECT 1 FROM attrs t WHERE t.category_id = i.request_id AND t.property_name = i.attribute)),
    f AS (SELECT request_id, property_id, attribute,
                 coalesce(weight, round(1.0 / count(*) OVER (PARTITION BY request_id), 6)) AS w FROM kept),
    nw AS (SELECT request_id, attribute,
                  CASE WHEN sum(w) OVER (PARTITION BY request_id) > 0
                       THEN round(w / sum(w) OVER (PARTITION BY request_id), 6) ELSE w END AS weight,
                  CAST(row_number() OVER (PARTITION BY request_id ORDER BY property_id) AS INTEGER) AS attr_rank
           FROM f)
    SELECT request_id, attr_rank, attribute, weight FROM nw WHERE attr_rank <= 5
""", "fx_properties")

ORACLE["product_profiles"] = with_fx("""
    WITH p AS (
        SELECT DISTINCT trim(product_code) AS product_code, trim(product_name) AS product_name, property_id,
               trim(property_name) AS property_name, trim(value_id) AS value, category_id, brand_id
        FROM fx_properties WHERE status_id IN (4, 5)),
    r AS (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY property_id, property_name, value) AS pos
          FROM p),
    g AS (SELECT product_code, product_name, category_id, brand_id,
                 string_agg(property_name || ': ' || value, '; ' ORDER BY pos) AS pairs
          FROM r WHERE pos <= 20 GROUP BY product_code, product_name, category_id, brand_id)
    SELECT product_code, product_name, category_id, brand_id,
           product_name || '@@' || product_code || ' | ' || pairs || ' | Category: '
           || coalesce(CAST(category_id AS VARCHAR), '') || ' | Brand: ' || coalesce(CAST(brand_id AS VARCHAR), '')
               AS text_for_llm
    FROM g
""", "fx_properties")


def _similar_sql(other_brand: bool) -> str:
    extra = "AND a.brand_id IS DISTINCT FROM b.brand_id" if other_brand else ""
    return with_fx(f"""
    WITH p AS (
        SELECT DISTINCT trim(product_code) AS code, category_id, property_id, value_id AS value, brand_id
        FROM fx_properties WHERE status_id IN (4, 5) AND value_id IS NOT NULL AND trim(value_id) <> ''
          AND value_id <> 'Đang cập nhật'),
    pr AS (SELECT a.code AS a, b.code AS b, count(*) AS shared
           FROM p a JOIN p b ON a.category_id = b.category_id AND a.property_id = b.property_id
                            AND a.value = b.value AND a.code <> b.code {extra}
           GROUP BY a.code, b.code),
    t AS (SELECT a, b, CAST(shared AS DOUBLE) AS score, shared,
                 CAST(row_number() OVER (PARTITION BY a ORDER BY shared DESC, b) AS INTEGER) AS alike_rank
          FROM pr QUALIFY alike_rank <= 10),
    names AS (SELECT DISTINCT trim(product_code) AS code, product_name, category_id
              FROM fx_properties WHERE status_id IN (4, 5))
    SELECT t.a AS product_code, n1.product_name, n1.category_id, t.b AS alike_product_code,
           n2.product_name AS alike_product_name, t.score, t.shared, t.alike_rank
    FROM t JOIN names n1 ON n1.code = t.a JOIN names n2 ON n2.code = t.b
""", "fx_properties")


ORACLE["similar_products"] = _similar_sql(False)
ORACLE["similar_other_brand"] = _similar_sql(True)

# -- S10 / S11 / R7 / J15-J18 ---------------------------------------------------------------------
GROWN = IMPUTED + """,
    b AS (
        SELECT i.customer_id, i.expected_age_last AS a,
               (SELECT max(age_months) FROM fx_growth WHERE age_months <= i.expected_age_last) AS a0,
               (SELECT min(age_months) FROM fx_growth WHERE age_months >= i.expected_age_last) AS a1
        FROM imp i),
    gg AS (
        SELECT b.customer_id, b.a AS expected_age_last,
               round(CASE WHEN b.a IS NULL THEN NULL WHEN b.a0 IS NULL THEN g1.weight_kg
                          WHEN b.a1 IS NULL OR b.a1 = b.a0 THEN g0.weight_kg
                          ELSE g0.weight_kg + (g1.weight_kg - g0.weight_kg) * (b.a - b.a0) / (b.a1 - b.a0) END, 6)
                   AS weight_kg
        FROM b LEFT JOIN fx_growth g0 ON g0.age_months = b.a0 LEFT JOIN fx_growth g1 ON g1.age_months = b.a1)"""

ORACLE["request_ages"] = with_fx(f"""
    WITH {GROWN}
    SELECT expected_age_last AS age_months, weight_kg, count(*) AS n_customers,
           'age_months=' || coalesce(CAST(expected_age_last AS VARCHAR), '') || '; weight_kg='
           || coalesce(CAST(weight_kg AS VARCHAR), '') || '; top_k=20' AS prompt
    FROM gg GROUP BY expected_age_last, weight_kg
""", "fx_person", "fx_growth")

ORACLE["request_attributes"] = with_fx(f"""
    WITH {ACTIVE},
    nm AS (SELECT DISTINCT category_id, property_name FROM attrs)
    SELECT category_id, CAST(count(*) AS INTEGER) AS n_attributes,
           'category=' || category_id || '; top_k=5' || chr(10)
           || string_agg('- ' || property_name, chr(10) ORDER BY property_name) AS prompt
    FROM nm GROUP BY category_id
""", "fx_properties")

NORM = "array_to_string(list_sort(string_split(lower(regexp_replace(trim({x}), '\\s+', ' ', 'g')), ' ')), ' ')"

REPLY_ITEMS = """
    it AS (
        SELECT request_id, pos, product_id, product_name,
               CASE WHEN pos = 4 AND request_id % 7 = 0 THEN concat(substr(nm, 1, 3), substr(nm, 5)) ELSE nm END
                   AS name
        FROM (SELECT *, CASE WHEN request_id % 3 = 0 THEN upper(product_name) ELSE product_name END AS nm
              FROM fx_reply_items))"""

RESOLVED = REPLY_ITEMS + f""",
    cn AS (SELECT DISTINCT product_name AS true_name FROM fx_catalog),
    ex AS (SELECT it.request_id, it.pos, cn.true_name, 1 AS stage FROM it JOIN cn ON it.name = cn.true_name),
    lw AS (SELECT it.request_id, it.pos, min(cn.true_name) AS true_name, 2 AS stage
           FROM it JOIN cn ON lower(it.name) = lower(cn.true_name) GROUP BY it.request_id, it.pos),
    hit AS (SELECT * FROM (SELECT * FROM ex UNION ALL SELECT * FROM lw)
            QUALIFY row_number() OVER (PARTITION BY request_id, pos ORDER BY stage) = 1),
    rest AS (SELECT it.*, {NORM.format(x='it.name')} AS qn FROM it
             WHERE NOT EXISTS (SELECT 1 FROM hit h WHERE h.request_id = it.request_id AND h.pos = it.pos)),
    cnn AS (SELECT true_name, {NORM.format(x='true_name')} AS cn FROM cn),
    fz AS (SELECT request_id, pos, true_name, 3 AS stage FROM (
               SELECT r.request_id, r.pos, c.true_name, levenshtein(r.qn, c.cn) AS lev,
                      greatest(length(r.qn), length(c.cn)) AS l
               FROM rest r CROSS JOIN cnn c)
           WHERE (l - lev) * 100 >= 89 * l
           QUALIFY row_number() OVER (PARTITION BY request_id, pos ORDER BY lev / l, true_name) = 1),
    allh AS (SELECT * FROM hit UNION ALL SELECT * FROM fz),
    firstuse AS (SELECT * FROM allh QUALIFY row_number() OVER (PARTITION BY request_id, true_name ORDER BY pos) = 1),
    res AS (SELECT f.request_id, f.pos, k.product_id, k.product_name,
                   CASE f.stage WHEN 1 THEN 'exact' WHEN 2 THEN 'lower' ELSE 'fuzzy' END AS match_kind
            FROM firstuse f JOIN fx_catalog k ON k.product_name = f.true_name)"""

ORACLE["reply_names"] = with_fx(f"WITH {REPLY_ITEMS} SELECT request_id, pos, name FROM it", "fx_reply_items")
ORACLE["resolve_names"] = with_fx(f"WITH {RESOLVED} SELECT * FROM res", "fx_reply_items", "fx_catalog")

ORACLE["fuzzy_names"] = with_fx(f"""
    WITH q AS (SELECT product_id, query_name, {NORM.format(x='query_name')} AS qn FROM fx_misspelt),
    c AS (SELECT DISTINCT product_name, {NORM.format(x='product_name')} AS cn FROM fx_catalog),
    s AS (SELECT q.product_id, q.query_name, c.product_name AS matched_name, levenshtein(q.qn, c.cn) AS lev,
                 greatest(length(q.qn), length(c.cn)) AS l
          FROM q CROSS JOIN c)
    SELECT product_id, query_name, matched_name, round(100.0 * (l - lev) / l, 4) AS score
    FROM s WHERE (l - lev) * 100 >= 89 * l
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY lev / l, matched_name) = 1
""", "fx_misspelt", "fx_catalog")

# edit matrix of the InDel ratio, row by row over the characters of qn, cell by cell over those of cn;
# a pair beyond the cutoff by Levenshtein is beyond it by InDel (which allows no replacement)
ORACLE["fuzzy_names_indel"] = with_fx(f"""
    WITH q AS (SELECT product_id, query_name, {NORM.format(x='query_name')} AS qn FROM fx_misspelt),
    c AS (SELECT DISTINCT product_name, {NORM.format(x='product_name')} AS cn FROM fx_catalog),
    p AS (SELECT a.qn, b.cn, length(a.qn) + length(b.cn) AS l, string_split(b.cn, '') AS ys
          FROM (SELECT DISTINCT qn FROM q) a CROSS JOIN (SELECT DISTINCT cn FROM c) b
          WHERE levenshtein(a.qn, b.cn) * 100 <= 11 * (length(a.qn) + length(b.cn))),
    d AS (SELECT qn, cn, l, list_reduce(
            list_prepend({{'x': '', 'r': list_transform(range(len(ys) + 1), lambda i: 0)}},
                         list_transform(string_split(qn, ''), lambda x: {{'x': x, 'r': []::INTEGER[]}})),
            lambda above, here: {{'x': '', 'r': list_reduce(
                list_prepend({{'y': '', 'j': 0, 'r': [0]}},
                             list_transform(range(1, len(ys) + 1), lambda j: {{'y': ys[j], 'j': j::INTEGER, 'r': []::INTEGER[]}})),
                lambda t, n: {{'y': '', 'j': n.j, 'r': list_append(t.r,
                    CASE WHEN n.y = here.x THEN above.r[n.j] + 1 ELSE greatest(above.r[n.j + 1], t.r[n.j]) END)}}).r}}).r[-1] AS lcs
          FROM p),
    s AS (SELECT q.product_id, q.query_name, c.product_name AS matched_name, d.l, d.l - 2 * d.lcs AS gap
          FROM q JOIN d USING (qn) JOIN c USING (cn))
    SELECT product_id, query_name, matched_name, round(100.0 * (l - gap) / l, 4) AS score
    FROM s WHERE (l - gap) * 100 >= 89 * l
    QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY gap / l, matched_name) = 1
""", "fx_misspelt", "fx_catalog")

ORACLE["reply_products"] = with_fx("""
    WITH cat AS (SELECT CAST(product_id AS VARCHAR) AS code, product_name FROM fx_catalog),
    hit AS (
        SELECT it.request_id, it.pos,
               CASE WHEN it.request_id % 3 = 0 THEN CAST(it.product_id AS VARCHAR)
                    ELSE (SELECT min(code) FROM cat WHERE lower(cat.product_name) = lower(it.product_name)) END AS code
        FROM fx_reply_items it),
    d AS (SELECT * FROM hit QUALIFY row_number() OVER (PARTITION BY request_id, code ORDER BY pos) = 1),
    t AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY request_id ORDER BY pos) <= 10)
    SELECT t.request_id, t.pos, t.code AS alike_product_code, cat.product_name AS alike_product_name
    FROM t JOIN cat ON cat.code = t.code
""", "fx_reply_items", "fx_catalog")

ORACLE["run_statistics"] = with_fx(f"""
    WITH {RESOLVED},
    b AS (SELECT request_id // 100 AS batch, request_id, product_id FROM res)
    SELECT batch, count(*) AS rows, count(DISTINCT request_id) AS distinct_request_id, count(DISTINCT product_id) AS distinct_product_id
    FROM b GROUP BY GROUPING SETS ((batch), ())
""", "fx_reply_items", "fx_catalog")

ORACLE["match_metrics"] = with_fx(f"""
    WITH {RESOLVED},
    per AS (SELECT request_id, count(*) AS n FROM res GROUP BY request_id),
    j AS (SELECT c.c_custkey AS request_id, per.n FROM customer c LEFT JOIN per ON per.request_id = c.c_custkey)
    SELECT count(*) AS requests, count(n) AS matched_requests, CAST(coalesce(sum(n), 0) AS BIGINT) AS product_rows,
           count(*) - count(n) AS unmatched_requests
    FROM j
""", "fx_reply_items", "fx_catalog")

ORACLE["no_match_rows"] = with_fx(f"""
    WITH {RESOLVED}
    SELECT c.c_custkey AS request_id, CASE WHEN c.c_custkey % 10 = 0 THEN '[]' ELSE '<has items>' END AS reply
    FROM customer c WHERE NOT EXISTS (SELECT 1 FROM res WHERE res.request_id = c.c_custkey)
""", "fx_reply_items", "fx_catalog")

# -- S7 / P19 -----------------------------------------------------------------------------------
ORACLE["batch_numbers"] = with_fx("""
    SELECT customer_id, row_no, CAST(floor(row_no / 500) AS BIGINT) AS batch FROM (
        SELECT customer_id, CAST(row_number() OVER (ORDER BY customer_id) - 1 AS BIGINT) AS row_no FROM fx_person)
""", "fx_person")
ORACLE["customer_range"] = with_fx("""
    SELECT customer_id, expected_age_last,
           CAST(row_number() OVER (ORDER BY customer_id) - 1 AS BIGINT) AS row_no
    FROM fx_person
""", "fx_person")

ORACLE["customer_range_inside"] = f"SELECT * FROM ({ORACLE['customer_range']}) WHERE row_no BETWEEN 50 AND 1049"

PROFILES = """
    pp AS (
        SELECT DISTINCT trim(product_code) AS product_code, trim(product_name) AS product_name, property_id,
               trim(property_name) AS property_name, trim(value_id) AS value, category_id, brand_id
        FROM fx_properties WHERE status_id IN (4, 5)),
    pr_ AS (SELECT *, row_number() OVER (PARTITION BY product_code ORDER BY property_id, property_name, value)
                 AS pos FROM pp),
    pg AS (SELECT product_code, product_name, category_id, brand_id,
                  string_agg(property_name || ': ' || value, '; ' ORDER BY pos) AS pairs
           FROM pr_ WHERE pos <= 20 GROUP BY product_code, product_name, category_id, brand_id),
    prof AS (SELECT product_code,
                    product_name || '@@' || product_code || ' | ' || pairs || ' | Category: '
                    || coalesce(CAST(category_id AS VARCHAR), '') || ' | Brand: '
                    || coalesce(CAST(brand_id AS VARCHAR), '') AS text_for_llm, category_id, brand_id
             FROM pg)"""

SIMILAR_TOP = """
    sp AS (
        SELECT DISTINCT trim(product_code) AS code, category_id, property_id, value_id AS value
        FROM fx_properties WHERE status_id IN (4, 5) AND value_id IS NOT NULL AND trim(value_id) <> ''
          AND value_id <> 'Đang cập nhật'),
    spr AS (SELECT a.code AS a, b.code AS b, count(*) AS shared
            FROM sp a JOIN sp b ON a.category_id = b.category_id AND a.property_id = b.property_id
                               AND a.value = b.value AND a.code <> b.code
            GROUP BY a.code, b.code),
    st AS (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY shared DESC, b) AS alike_rank
           FROM spr QUALIFY alike_rank <= 10)"""


def _requests_sql(gap: str) -> str:
    """Places of the others are numbered without the gap; a request takes 1000 of them from its start on."""
    return with_fx(f"""
    WITH {PROFILES},
    one AS (SELECT * FROM prof WHERE category_id IS NOT NULL),
    place AS (SELECT *, row_number() OVER (PARTITION BY category_id ORDER BY brand_id NULLS FIRST, product_code) - 1 AS pos,
                     count(*) OVER (PARTITION BY category_id) AS n FROM one),
    brand AS (SELECT *, min(pos) OVER (PARTITION BY category_id, brand_id) AS lo,
                     max(pos) OVER (PARTITION BY category_id, brand_id) + 1 AS hi FROM place),
    t AS (SELECT product_code, category_id, n, {gap} FROM brand),
    s AS (SELECT *, n - (hi - lo) AS others FROM t WHERE n > hi - lo),
    st AS (SELECT *, CAST(('0x' || substr(md5('similar|' || product_code), 1, 15)) AS BIGINT) % others AS start FROM s),
    c AS (SELECT st.product_code, p.text_for_llm,
                 ((CASE WHEN p.pos < st.lo THEN p.pos ELSE p.pos - (st.hi - st.lo) END) - start + others) % others AS turn
          FROM st JOIN place p ON p.category_id = st.category_id AND NOT (p.pos >= st.lo AND p.pos < st.hi)),
    g AS (SELECT product_code, count(*) AS k, string_agg(text_for_llm, chr(10) ORDER BY turn) AS lines
          FROM c WHERE turn < 1000 GROUP BY product_code)
    SELECT prof.product_code, prof.text_for_llm AS target_text, coalesce(g.k, 0) AS n_candidates,
           coalesce(g.lines, '') AS candidates
    FROM prof LEFT JOIN g ON g.product_code = prof.product_code
""", "fx_properties")


ORACLE["request_similar"] = _requests_sql("pos AS lo, pos + 1 AS hi")
ORACLE["request_similar_other_brand"] = _requests_sql("lo, hi")

ORACLE["request_catalog"] = with_fx("""
    SELECT DISTINCT product_name AS name, '- ' || product_name AS line FROM fx_catalog
    WHERE product_name IS NOT NULL
""", "fx_catalog")

# -- S9 ------------------------------------------------------------------------------------------
ORACLE["off_ladder"] = with_fx("""
    SELECT product_id, size_label AS label, '36' AS category_code FROM fx_size_labels
    WHERE size_label NOT IN ('NB', 'XS', 'S', 'M', 'L', 'XL', 'XXL', 'XXXL')
""", "fx_size_labels")

ORACLE["similar_errors"] = with_fx(f"""
    WITH {SIMILAR_TOP},
    t AS (SELECT DISTINCT trim(product_code) AS productcode, product_name AS productname
          FROM fx_properties WHERE status_id IN (4, 5))
    SELECT productcode, productname, 'no product shares a property value' AS error FROM t
    WHERE productcode NOT IN (SELECT a FROM spr)
""", "fx_properties")

ORACLE["age_no_match"] = with_fx(f"""
    WITH {CANDIDATES}
    SELECT customer_id FROM imp WHERE customer_id NOT IN (SELECT customer_id FROM cand)
""", "fx_person", "fx_product_label", "fx_age_labels")

ATTR_WEIGHTS = ACTIVE + f""",
    ncat AS (SELECT category_id, count(DISTINCT code) AS n FROM act GROUP BY category_id),
    vals AS (SELECT a.* FROM act a WHERE {REAL} AND EXISTS (
                 SELECT 1 FROM attrs t WHERE t.category_id = a.category_id AND t.property_id = a.property_id
                   AND t.property_name = a.property_name)),
    pv AS (SELECT category_id, property_id, property_name, value, count(DISTINCT code) AS c
           FROM vals GROUP BY category_id, property_id, property_name, value),
    pa AS (SELECT category_id, property_id, property_name, count(DISTINCT code) AS w
           FROM vals GROUP BY category_id, property_id, property_name),
    ent AS (SELECT pv.category_id, pv.property_id, pv.property_name,
                   -sum((pv.c / pa.w) * ln(pv.c / pa.w)) AS h, any_value(pa.w) AS w
            FROM pv JOIN pa ON pv.category_id = pa.category_id AND pv.property_id = pa.property_id
                           AND pv.property_name = pa.property_name
            GROUP BY pv.category_id, pv.property_id, pv.property_name),
    sc AS (SELECT t.category_id, t.property_id, t.property_name,
                  round(coalesce(e.w, 0) / n.n * coalesce(e.h, 0.0) / ln(greatest(2, n.n)), 9) AS weight
           FROM attrs t LEFT JOIN ent e ON t.category_id = e.category_id AND t.property_id = e.property_id
                                       AND t.property_name = e.property_name
           JOIN ncat n ON t.category_id = n.category_id),
    aw AS (SELECT category_id, property_id,
                  CASE WHEN sum(weight) OVER (PARTITION BY category_id) > 0
                       THEN round(weight / sum(weight) OVER (PARTITION BY category_id), 6) ELSE weight END AS weight,
                  row_number() OVER (PARTITION BY category_id ORDER BY weight DESC, property_name) AS attr_rank
           FROM sc QUALIFY attr_rank <= 5)"""

ORACLE["similar_weighted"] = with_fx(f"""
    WITH {ATTR_WEIGHTS},
    p AS (
        SELECT DISTINCT trim(product_code) AS code, category_id, property_id, value_id AS value
        FROM fx_properties WHERE status_id IN (4, 5) AND value_id IS NOT NULL AND trim(value_id) <> ''
          AND value_id <> 'Đang cập nhật'),
    pr AS (SELECT a.code AS a, b.code AS b, round(sum(coalesce(aw.weight, 1.0)), 9) AS score, count(*) AS shared
           FROM p a JOIN p b ON a.category_id = b.category_id AND a.property_id = b.property_id
                            AND a.value = b.value AND a.code <> b.code
           LEFT JOIN aw ON aw.category_id = a.category_id AND aw.property_id = a.property_id
           GROUP BY a.code, b.code),
    t AS (SELECT a, b, score, shared,
                 CAST(row_number() OVER (PARTITION BY a ORDER BY score DESC, shared DESC, b) AS INTEGER) AS alike_rank
          FROM pr QUALIFY alike_rank <= 10),
    names AS (SELECT DISTINCT trim(product_code) AS code, product_name, category_id
              FROM fx_properties WHERE status_id IN (4, 5))
    SELECT t.a AS product_code, n1.product_name, n1.category_id, t.b AS alike_product_code,
           n2.product_name AS alike_product_name, t.score, t.shared, t.alike_rank
    FROM t JOIN names n1 ON n1.code = t.a JOIN names n2 ON n2.code = t.b
""", "fx_properties")
