"""Inputs derived from the driver tables (see FIXTURES.md).

The driver tables are TPC-H shaped, so each retail input the jobs expect
(order history, catalog, property table, cycle scores, ...) is derived
from them here with DataFrame expressions.  Everything grows with the
driver tables; the only literal inputs are the small label and growth
sheets, which are joined to table-derived rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import Tables

PART_TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")


def case_map(col: Column, pairs, default=None) -> Column:
    """``CASE col WHEN k1 THEN v1 ... ELSE default END``."""
    out = None
    for k, v in pairs:
        out = (F.when(col == F.lit(k), F.lit(v)) if out is None
               else out.when(col == F.lit(k), F.lit(v)))
    return out.otherwise(F.lit(default)) if default is not None else out


def type_code(col: Column) -> Column:
    return case_map(col, [(t, i + 1) for i, t in enumerate(PART_TYPES)])


def brand_of(part_key: Column, brand: Column) -> Column:
    return F.when(part_key % 20 == 0, F.lit(None).cast("bigint")).otherwise(
        F.regexp_replace(brand, "Brand#", "").cast("bigint"))


def product_name_of(name: Column, key: Column) -> Column:
    return F.concat(name, F.lit(" "), (key % 100).cast("string"))


def _memo(method):
    """Build a derived input once per ``Fixtures`` instance (DataFrames are
    immutable plans, so sharing them between queries is safe)."""
    name = method.__name__

    def wrapper(self):
        if name not in self._built:
            self._built[name] = method(self)
        return self._built[name]
    wrapper.__name__ = name
    wrapper.__doc__ = method.__doc__
    return wrapper


def _materialized(method):
    """Like ``_memo``, and the result is checkpointed to the shared
    ``spark.checkpoint.dir``: these inputs are tables in production, read by
    several branches of one plan; without a table each branch would derive
    them from the order lines again."""
    name = method.__name__

    def wrapper(self):
        if name not in self._built:
            from ..session import ensure_checkpoint_dir
            ensure_checkpoint_dir(self.spark)
            self._built[name] = method(self).checkpoint(eager=True)
        return self._built[name]
    wrapper.__name__ = name
    wrapper.__doc__ = method.__doc__
    return wrapper


class Fixtures:
    """All derived inputs for one scale-factor folder.

    ``Fixtures(spark, d)`` returns the same instance for the same session
    and folder, so queries share the input definitions.
    """

    _instances: dict = {}

    def __new__(cls, spark: SparkSession, sf_dir: str):
        key = (id(spark), sf_dir)
        inst = cls._instances.get(key)
        if inst is None or inst.spark is not spark:
            inst = super().__new__(cls)
            inst.spark = spark
            inst.t = Tables(spark, sf_dir)
            inst._built = {}
            cls._instances[key] = inst
        return inst

    def __init__(self, spark: SparkSession, sf_dir: str):
        pass

    # -- order history -------------------------------------------------
    @_memo
    def order_lines(self) -> DataFrame:
        li = self.t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber")
        o = self.t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
        p = self.t.part.select("p_partkey", "p_type")
        j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
        return j.select(
            F.col("o_custkey").alias("customer_id"),
            F.col("o_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.when(F.col("l_partkey") % 40 == 0, F.lit(None))
             .otherwise(type_code(F.col("p_type"))).cast("int").alias("category_id"),
            F.col("l_linenumber").alias("output_type"),
            F.col("o_orderdate").alias("ordered_at"),
        )

    @_memo
    def excluded(self) -> DataFrame:
        return (self.t.customer.filter(F.col("c_acctbal") < 0)
                .select(F.col("c_custkey").alias("customer_id")))

    @_materialized
    def purchases(self) -> DataFrame:
        li = self.t.lineitem.select("l_orderkey", "l_partkey")
        o = self.t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
        return (li.join(o, li.l_orderkey == o.o_orderkey)
                .select(F.col("o_custkey").alias("customer_id"),
                        F.col("l_partkey").alias("product_id"),
                        F.to_date("o_orderdate").alias("purchase_date"))
                .distinct())

    @_materialized
    def cycle(self) -> DataFrame:
        li = self.t.lineitem.select("l_orderkey", "l_partkey", "l_discount")
        o = self.t.orders.select("o_orderkey", "o_custkey")
        p = self.t.part.select("p_partkey", "p_type").filter(F.col("p_type").isin("SMALL", "MEDIUM"))
        j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
        g = (j.groupBy(F.col("o_custkey").alias("customer_id"),
                       F.col("l_partkey").alias("product_id"),
                       F.when(F.col("p_type") == "SMALL", "36").otherwise("99").alias("category_code"))
             .agg(F.max(F.round(F.col("l_discount") * 100).cast("int")).alias("_d")))
        w = Window.partitionBy("customer_id").orderBy(F.col("_d").desc(), F.col("product_id"))
        return g.select("customer_id", "product_id", "category_code",
                        (F.col("_d").cast("double") / 10).alias("score"),
                        F.row_number().over(w).cast("int").alias("rank_cycle"))

    # -- catalog ---------------------------------------------------------
    @_memo
    def catalog(self) -> DataFrame:
        p = self.t.part
        return p.select(
            F.col("p_partkey").alias("product_id"),
            product_name_of(F.col("p_name"), F.col("p_partkey")).alias("product_name"),
            type_code(F.col("p_type")).cast("string").alias("category_code"),
            F.col("p_type").alias("category_name"),
            brand_of(F.col("p_partkey"), F.col("p_brand")).alias("brand_id"),
            F.when(F.col("p_partkey") % 15 == 0, F.lit(None).cast("bigint"))
             .otherwise(F.floor(F.col("p_partkey") / 4).cast("bigint")).alias("item_base_id"),
        )

    @_memo
    def model_map(self) -> DataFrame:
        p = self.t.part.filter(F.col("p_partkey") % 11 != 0)
        dup = F.explode(F.when(F.col("p_partkey") % 13 == 0, F.array(F.lit(0), F.lit(1)))
                        .otherwise(F.array(F.lit(0))))
        p = p.select("p_partkey", dup.alias("dup"))
        return p.select(
            F.concat(F.lit("  "), F.col("p_partkey").cast("string"), F.lit(" ")).alias("product_code"),
            F.concat(F.when(F.col("dup") == 0, "M").otherwise("X"),
                     F.floor(F.col("p_partkey") / 3).cast("bigint").cast("string")).alias("model_code"),
        )

    @_memo
    def product_label(self) -> DataFrame:
        return self.t.part.select(F.col("p_partkey").alias("product_id"),
                                  (F.col("p_partkey") % 16).cast("int").alias("label_no"))

    @_memo
    def weight_label(self) -> DataFrame:
        """Weight labels of three products in four; every seventh has a second, narrower one."""
        p = self.t.part.filter(F.col("p_partkey") % 4 != 0).select(
            "p_partkey", F.explode(F.when(F.col("p_partkey") % 7 == 0, F.array(F.lit(0), F.lit(3)))
                                   .otherwise(F.array(F.lit(0)))).alias("more"))
        return p.select(F.col("p_partkey").alias("product_id"), ((F.col("p_partkey") + F.col("more")) % 8).cast("int").alias("label_no"))

    @_memo
    def weighed(self) -> DataFrame:
        """Customers with their own weight: grams of their key over a growing base, NULL for every seventh."""
        age = F.col("expected_age_last")
        return self.person().select("customer_id", "expected_age_last", F.when(
            F.col("customer_id") % 7 != 0,
            F.round(F.lit(3.2) + 0.21 * F.coalesce(age, F.lit(0.0)) + (F.col("customer_id") % 37) / 16, 3)).alias("weight_kg"))

    @_memo
    def text_orders(self) -> DataFrame:
        """Order times as text, in the forms they arrive in; every tenth does not parse."""
        o, k = self.t.orders, F.col("o_orderkey")
        day = F.date_format("o_orderdate", "yyyy-MM-dd")
        text = (F.when(k % 10 == 3, F.concat(F.lit("day "), day)).when(k % 10 == 5, F.lit(None).cast("string"))
                .when(k % 2 == 0, F.concat(day, F.lit(" 10:"), F.lpad((k % 60).cast("string"), 2, "0"), F.lit(":07")))
                .otherwise(day))
        return o.select(k.alias("order_id"), text.alias("ordered_text"))

    @_memo
    def listed_label(self) -> DataFrame:
        """Age labels with the category and property they stand under."""
        k, names = F.col("p_partkey"), ["age_range", "age_usp", "recommended_age", "weight_usp", "color", "size"]
        return self.t.part.select(k.alias("product_id"), (k % 16).cast("int").alias("label_no"),
                                  (k % 310).cast("string").alias("category_code"),
                                  F.element_at(F.array(*[F.lit(n) for n in names]), (F.col("p_size") % 6 + 1).cast("int")).alias("propertyid"))

    @_memo
    def size_labels(self) -> DataFrame:
        p = self.t.part.filter(F.col("p_type") == "SMALL")
        sizes = ["FREE", "NB", "XS", "S", "M", "L", "XL", "XXL"]
        return p.select(
            F.col("p_partkey").alias("product_id"),
            brand_of(F.col("p_partkey"), F.col("p_brand")).alias("brand_id"),
            case_map(F.col("p_size") % 9, list(enumerate(sizes)), "XXXL").alias("size_label"),
        )

    @_memo
    def milk_product(self) -> DataFrame:
        p = self.t.part.filter(F.col("p_type") == "MEDIUM")
        return p.select(F.col("p_partkey").alias("product_id"),
                        brand_of(F.col("p_partkey"), F.col("p_brand")).alias("brand_id"),
                        (F.col("p_partkey") % 6).cast("int").alias("label_no"))

    # -- people ------------------------------------------------------------
    @_memo
    def person(self) -> DataFrame:
        c = self.t.customer
        return c.select(
            F.col("c_custkey").alias("customer_id"),
            (F.col("c_nationkey") % 5).cast("int").alias("prediction"),
            F.when(F.col("c_custkey") % 4 == 0, F.lit(None).cast("string"))
             .otherwise(F.col("c_mktsegment")).alias("stage_last"),
            F.when(F.col("c_custkey") % 3 == 0, F.lit(None).cast("double"))
             .otherwise(((F.col("c_custkey") * 7) % 73).cast("double")).alias("expected_age_last"),
        )

    @_memo
    def growth(self) -> DataFrame:
        ages = [0, 2, 4, 6, 9, 12, 18, 24, 36, 48, 60]
        g = self.spark.createDataFrame([(a,) for a in ages], "a int")
        a = F.col("a").cast("double")
        return g.select(a.alias("age_months"),
                        F.round(F.lit(3.5) + 2 * F.sqrt(a), 3).alias("weight_kg"),
                        F.round(F.lit(50.0) + 8 * F.sqrt(a), 3).alias("height_cm"))

    # -- property tables -----------------------------------------------------
    @_memo
    def properties(self) -> DataFrame:
        p = self.t.part
        props = F.explode(F.when(F.col("p_partkey") % 10 == 0, F.array(*[F.lit(i) for i in (1, 2, 3, 4)]))
                          .otherwise(F.array(*[F.lit(i) for i in (1, 2, 3)])))
        p = p.select("*", props.alias("prop"))
        prop = F.col("prop")
        value = (F.when(prop == 1, F.concat(F.col("p_brand"), F.lit("/"), (F.col("p_size") % 10).cast("string")))
                 .when(prop == 2, F.concat(F.col("p_name"), F.lit("/"), F.col("p_type")))
                 .when(prop == 3, F.round(F.col("p_retailprice") * 10).cast("bigint").cast("string"))
                 .otherwise(F.lit("Đang cập nhật")))
        return p.select(
            F.concat(F.col("p_partkey").cast("string"), F.lit(" ")).alias("product_code"),
            product_name_of(F.col("p_name"), F.col("p_partkey")).alias("product_name"),
            prop.cast("int").alias("property_id"),
            case_map(prop, [(1, "brand_size"), (2, "name_type"), (3, "price")], "note").alias("property_name"),
            value.alias("value_id"),
            F.col("p_type").alias("category_id"),
            brand_of(F.col("p_partkey"), F.col("p_brand")).alias("brand_id"),
            (F.col("p_partkey") % 6).cast("int").alias("status_id"),
            case_map(F.col("p_partkey") % 3, [(0, "1,2,-4"), (1, "1,3")], "2, x,3").alias("list_property"),
        )

    @_memo
    def property_map(self) -> DataFrame:
        p = self.t.part.select("*", F.explode(F.array(F.lit(1), F.lit(2))).alias("prop"))
        nxt = case_map(F.col("p_type"), [("ECONOMY", "LARGE"), ("LARGE", "MEDIUM"), ("MEDIUM", "PROMO"),
                                         ("PROMO", "SMALL"), ("SMALL", "STANDARD")], "ECONOMY")
        one = F.col("prop") == 1
        return p.select(
            F.col("prop").cast("int").alias("property_id"),
            F.when(one, F.concat(F.col("p_brand"), F.lit("/"), (F.col("p_size") % 10).cast("string")))
             .otherwise(F.concat(F.col("p_name"), F.lit("/"), F.col("p_type"))).alias("value_id"),
            F.col("prop").cast("int").alias("property_id_map"),
            F.when(one, F.concat(F.col("p_brand"), F.lit("/"), ((F.col("p_size") + 1) % 10).cast("string")))
             .otherwise(F.concat(F.col("p_name"), F.lit("/"), nxt)).alias("value_id_map"),
        ).distinct()

    # -- chat replies (built from table rows) ---------------------------------
    @_memo
    def reply_items(self) -> DataFrame:
        c = self.t.customer.select("c_custkey").filter(F.col("c_custkey") % 10 != 0)
        c = c.select("c_custkey", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("pos"))
        p = self.t.part.select("p_partkey", "p_name")
        keys = (p.agg(F.max("p_partkey")).first()[0] or 0) + 1  # names come from the whole part table
        j = c.join(p, p.p_partkey == (c.c_custkey * 7 + c.pos) % keys)
        return j.select(F.col("c_custkey").alias("request_id"),
                        F.col("pos").cast("int").alias("pos"),
                        product_name_of(F.col("p_name"), F.col("p_partkey")).alias("product_name"),
                        F.col("p_partkey").alias("product_id"))

    @_memo
    def name_replies(self) -> DataFrame:
        """One free-text reply per customer, in four list formats.

        ``request_id % 3 == 0`` upper-cases the names (found by the
        lower-case step); ``pos == 4`` with ``request_id % 7 == 0`` drops
        the fourth letter (found by the fuzzy step).
        """
        it = self.reply_items()
        rid = F.col("request_id")
        name = F.when(rid % 3 == 0, F.upper("product_name")).otherwise(F.col("product_name"))
        name = F.when((F.col("pos") == 4) & (rid % 7 == 0),
                      F.concat(F.substring(name, 1, 3), F.substring(name, F.lit(5), F.length(name)))
                      ).otherwise(name)
        it = it.select("request_id", "pos", name.alias("name"))
        g = it.groupBy("request_id").agg(
            F.array_sort(F.collect_list(F.struct("pos", "name"))).alias("items"))
        names = F.transform("items", lambda x: x["name"])
        quoted = F.transform("items", lambda x: F.concat(F.lit('"'), x["name"], F.lit('"')))
        bullets = F.transform("items", lambda x: F.concat(
            F.element_at(F.array(F.lit("- "), F.lit("* "), F.lit("• ")), (x["pos"] % 3 + 1).cast("int")), x["name"]))
        fmt = F.col("request_id") % 4
        reply = (F.when(fmt == 0, F.concat(F.lit("["), F.array_join(names, ", "), F.lit("]")))
                 .when(fmt == 1, F.concat(F.lit("Gợi ý: ["), F.array_join(quoted, ", "), F.lit("]")))
                 .when(fmt == 2, F.array_join(bullets, "\n"))
                 .otherwise(F.concat(F.array_join(names, "\n\n"), F.lit("\n"))))
        g = g.select("request_id", reply.alias("reply"))
        every = self.t.customer.select(F.col("c_custkey").alias("request_id"))
        return (every.join(g, "request_id", "left")
                .select("request_id", F.coalesce("reply", F.lit("[]")).alias("reply")))

    @_memo
    def product_replies(self) -> DataFrame:
        """JSON replies naming products by code, by name, or both."""
        it = self.reply_items()
        rid = F.col("request_id")
        code = F.col("product_id").cast("string")
        obj = (F.when(rid % 3 == 0, F.format_string('{"productcode": " %s ", "productname": ""}', code))
               .when(rid % 3 == 1, F.format_string('{"code": "", "name": "%s"}', F.upper("product_name")))
               .otherwise(F.format_string('{"productcode": "%s", "productname": "%s"}', code, F.col("product_name"))))
        g = it.groupBy("request_id").agg(
            F.array_sort(F.collect_list(F.struct("pos", obj.alias("o")))).alias("items"))
        text = F.concat(F.lit("Kết quả:\n["), F.array_join(F.transform("items", lambda x: x["o"]), ", "),
                        F.lit("]\n"))
        g = g.select("request_id", text.alias("reply"))
        every = self.t.customer.select(F.col("c_custkey").alias("request_id"))
        return (every.join(g, "request_id", "left")
                .select("request_id", F.coalesce("reply", F.lit("xin lỗi")).alias("reply")))

    @_memo
    def raw_replies(self) -> DataFrame:
        """Reply bodies as they arrive, one per customer, in seven forms by ``request_id % 7``: a list, a fenced list,
        a single object, elements of wrong types, an error body, a body cut short, none."""
        rid, form = F.col("request_id"), F.col("request_id") % 7
        g = self.reply_items().groupBy("request_id").agg(F.array_sort(F.collect_list(F.struct("pos", "product_id", "product_name"))).alias("i"))
        every = self.t.customer.select(F.col("c_custkey").alias("request_id")).join(g, "request_id", "left")
        objects = F.transform("i", lambda x: F.to_json(F.struct(
            x["product_id"].cast("string").alias("productcode"), x["product_name"].alias("productname"))))
        first = F.element_at("i", 1)
        listed = F.concat(F.lit("["), F.array_join(objects, ", "), F.lit("]"))
        content = (F.when(F.col("i").isNull(), F.lit("xin lỗi"))
                   .when(form == 1, F.concat(F.lit("Kết quả:\n```json\n"), listed, F.lit("\n```")))
                   .when(form == 2, F.concat(F.lit("Chọn "), F.to_json(F.struct(
                       first["product_id"].alias("code"), F.lit(" ").alias("productname"), first["product_name"].alias("name")))))
                   .when(form == 3, F.concat(F.lit('[7, "x", null, [1], '), F.element_at(objects, 1), F.lit("]")))
                   .otherwise(listed))
        body = F.to_json(F.struct(F.array(F.struct(F.struct(F.lit("assistant").alias("role"), content.alias("content")).alias("message")))
                                  .alias("choices")))
        raw = (F.when(form == 4, F.lit('{"error": {"code": 503}}')).when(form == 5, F.substring(body, 1, 40))
               .when(form == 6, F.lit(None).cast("string")).otherwise(body))
        return every.select(rid, raw.alias("raw"))

    @_memo
    def attribute_reply_items(self) -> DataFrame:
        """What each category's attribute reply holds, one row per element."""
        p = self.properties().select("category_id", "property_id", "property_name").distinct()
        w = (F.when(F.col("property_id") == 1, F.lit(None).cast("string"))
             .when(F.col("property_id") == 2, F.lit("0.4"))
             .when(F.col("property_id") == 3, F.lit("2"))
             .otherwise(F.lit("0.x")))
        return p.select("category_id", "property_id", "property_name", w.alias("weight_text"))

    @_memo
    def attribute_replies(self) -> DataFrame:
        it = self.attribute_reply_items()
        wt = F.col("weight_text")
        obj = (F.when(wt.isNull(), F.format_string('{"attribute": " %s ", "reason": "r"}', F.col("property_name")))
               .when(F.col("property_id") == 2, F.format_string('{"attribute": "%s", "weight": %s}',
                                                                F.col("property_name"), wt))
               .otherwise(F.format_string('{"attribute": "%s", "reason": "r", "weight": "%s"}',
                                          F.col("property_name"), wt)))
        g = it.groupBy("category_id").agg(
            F.array_sort(F.collect_list(F.struct("property_id", obj.alias("o")))).alias("items"))
        body = F.array_join(F.transform("items", lambda x: x["o"]), ", ")
        return g.select(F.col("category_id").alias("request_id"),
                        F.concat(F.lit("x ["), body, F.lit(', 3, {"weight": 1}]')).alias("reply"))

    @_memo
    def misspelt(self) -> DataFrame:
        p = self.t.part
        return p.select(F.col("p_partkey").alias("product_id"),
                        F.concat(F.substring("p_name", 1, 3), F.substring(F.col("p_name"), F.lit(5), F.length("p_name")), F.lit(" "),
                                 (F.col("p_partkey") % 100).cast("string")).alias("query_name"))


def growth_workbook(growth: DataFrame, path: str) -> None:
    """The growth table as a spreadsheet file, as it comes: blanks in headers, one weight that is no number."""
    import io
    import zipfile
    rows = [(r.age_months, "n/a" if r.age_months == 9 else r.weight_kg, r.weight_kg * 2, r.height_cm / 2, r.height_cm)
            for r in growth.orderBy("age_months").collect()]  # one row per sheet age

    def row(n, cells):
        return f'<row r="{n}">' + "".join(
            f'<c r="{"ABCDE"[i]}{n}" t="inlineStr"><is><t xml:space="preserve">{c}</t></is></c>' if isinstance(c, str)
            else f'<c r="{"ABCDE"[i]}{n}"><v>{c!r}</v></c>' for i, c in enumerate(cells)) + "</row>"

    header = ["Tuổi (tháng)", "Cân nặng (kg)", " Cân nặng (lb)", "Chiều cao (inch)", "Chiều cao (cm) "]
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="S" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
                                      '<Relationship Id="rId1" Type="w" Target="worksheets/sheet1.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>'
                                    + "".join(row(n + 1, r) for n, r in enumerate([header, *rows])) + "</sheetData></worksheet>"}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in parts.items():
            z.writestr(name, text)
    sc = growth.sparkSession.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(sc._jsc.hadoopConfiguration()).create(at)
    stream.write(bytearray(out.getvalue()))
    stream.close()


# Literal label sheets joined to table rows by label number (FIXTURES.md §3).
AGE_LABELS = [
    (0, "Trẻ sơ sinh"), (1, "Dưới 6 tháng"), (2, "Dưới 1,5 tuổi"), (3, "Từ 6 tháng đến 2 tuổi"),
    (4, "Từ 3 tuổi"), (5, "Từ 18 tháng"), (6, "0 - 6 tháng"), (7, "1 - 3 tuổi"),
    (8, "6 tháng - 2 tuổi"), (9, "2 tuổi"), (10, "9 tháng"), (11, "Đang cập nhật"),
    (12, "12 - 18"), (13, "Size L"), (14, "Freesize"), (15, "Mọi lứa tuổi"),
]

WEIGHT_LABELS = [
    (0, "Dưới 5,5 kg"), (1, "4 - 8 kg"), (2, "6 kg - 11,25 kg"), (3, "Từ 9 đến 14 kg"), (4, "Trên 12 kg"),
    (5, "7.5 kg"), (6, "Đang cập nhật"), (7, "Từ 3,05 kg"),
]

MILK_LABELS = [
    (0, "Trẻ sơ sinh"), (1, "0 - 6 tháng"), (2, "6 - 12 tháng"), (3, "1 - 2 tuổi"),
    (4, "Từ 1 tuổi"), (5, "Từ 2 tuổi"),
]


def label_sheet(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, T.StructType([
        T.StructField("label_no", T.IntegerType(), False),
        T.StructField("label", T.StringType(), False)]))
