"""Query catalogue: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query runs an operator of :mod:`cartwise.operators` over inputs derived
from the whole driver tables (:mod:`cartwise.sources.fixtures`).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.labels import size_like
from ..functions.text import as_timestamp, format_run_date
from ..operators import affinity as af
from ..operators import ages as ag
from ..operators import blend as bl
from ..operators import frequency as fq
from ..operators import fuzzy as fz
from ..operators import impute as im
from ..operators import intake, keys
from ..operators import replies as rp
from ..operators import requests as rq
from ..operators import similar as sm
from ..operators import statistics
from ..operators import upsize as up
from ..session import checkpoint_path, ensure_checkpoint_dir
from ..sources import batches, ranged, sinks
from ..sources import literals as lit
from ..sources.fixtures import AGE_LABELS, MILK_LABELS, WEIGHT_LABELS, Fixtures, growth_workbook, label_sheet
from ..sources.sheets import read_growth_sheet
from . import jobs

# The fixture's output-type codes (line numbers) that stand for kept sales.
FIXTURE_OUTPUT_TYPES = (1, 2, 4, 5)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def shared(fn):
    """Build an intermediate plan once per inputs folder and session; the
    queries of the catalogue reuse the same DataFrame definition."""
    def wrapper(fx: Fixtures) -> DataFrame:
        key = f"catalog:{fn.__name__}"
        if key not in fx._built:
            fx._built[key] = fn(fx)
        return fx._built[key]
    wrapper.__name__ = fn.__name__
    wrapper.__doc__ = fn.__doc__
    return wrapper


@shared
def _clean_lines(fx: Fixtures) -> DataFrame:
    return fq.clean_lines(fx.order_lines(), fx.excluded(), FIXTURE_OUTPUT_TYPES)


# -- R1 frequency profile ------------------------------------------------------
@query
def order_lines_clean(spark, sf_dir):
    """Kept order lines: output types, excluded customers removed, deduped."""
    return _clean_lines(Fixtures(spark, sf_dir))


@shared
def _filtered_lines(fx: Fixtures) -> DataFrame:
    return fq.filter_lines(fx.order_lines(), fx.excluded(), FIXTURE_OUTPUT_TYPES)


@query
def category_frequency(spark, sf_dir):
    """Distinct orders, share and rank of each category per customer."""
    return fq.category_frequency(_filtered_lines(Fixtures(spark, sf_dir)))


@query
def top_product_per_category(spark, sf_dir):
    """Most-ordered product per customer and category."""
    return fq.top_product_per_category(_filtered_lines(Fixtures(spark, sf_dir)))


@query
def frequency_profile(spark, sf_dir):
    """Top product per category with category statistics and model code."""
    fx = Fixtures(spark, sf_dir)
    return fq.frequency_profile(fx.order_lines(), fx.excluded(), fx.model_map(), FIXTURE_OUTPUT_TYPES)


@query
def model_code_map(spark, sf_dir):
    """Catalog products with their model codes, joined on trimmed codes."""
    fx = Fixtures(spark, sf_dir)
    cat = fx.catalog().select("product_id")
    return fq.attach_model_code(cat, fx.model_map())


# -- R2 companion products ------------------------------------------------------
@query
def companion_top1(spark, sf_dir):
    """R2: best companion per product and companion category, with model code."""
    fx = Fixtures(spark, sf_dir)
    return af.companion_products(fx.properties(), fx.property_map(), fx.model_map())


# -- R3 / R4 imputation -----------------------------------------------------------
@shared
def _imputed(fx: Fixtures) -> DataFrame:
    """Imputed customers, checkpointed: read by the age, growth, request
    and blend queries, each through several branches."""
    ensure_checkpoint_dir(fx.spark)
    return im.impute_by_group(fx.person()).checkpoint(eager=True)


@query
def group_mode(spark, sf_dir):
    """Most frequent stage per cluster, ties to the smallest."""
    return im.group_mode(Fixtures(spark, sf_dir).person(), "prediction", "stage_last")


@query
def impute_stage_age(spark, sf_dir):
    """Stage and age filled from group mode and mean."""
    return _imputed(Fixtures(spark, sf_dir))


@query
def growth_gap_fill(spark, sf_dir):
    """Growth values by age, linear between sheet ages."""
    fx = Fixtures(spark, sf_dir)
    cust = _imputed(fx).select("customer_id", "expected_age_last")
    return im.attach_growth(cust, fx.growth())


@query
def forward_fill(spark, sf_dir):
    """Growth values of the largest sheet age at or below each age."""
    fx = Fixtures(spark, sf_dir)
    cust = _imputed(fx).select("customer_id", "expected_age_last")
    return im.carry_growth_forward(cust, fx.growth())


@query
def growth_by_position(spark, sf_dir):
    """Gaps filled by row position over all customers, as the original does (W18 W19, two-pass scan)."""
    fx = Fixtures(spark, sf_dir)
    return im.growth_by_position(_imputed(fx), fx.growth())


# -- R5 / R6 / R8 age labels, candidates, diversification -----------------------------
@shared
def _product_labels(fx: Fixtures) -> DataFrame:
    sheet = label_sheet(fx.spark, AGE_LABELS)
    return fx.product_label().join(F.broadcast(sheet), "label_no").select("product_id", "label")


@query
def label_reject(spark, sf_dir):
    """Size-like age labels flagged."""
    pl = _product_labels(Fixtures(spark, sf_dir))
    return pl.select("product_id", "label", size_like(F.col("label")).alias("rejected"))


@query
def age_label_range(spark, sf_dir):
    """Age label -> [min, max] months, before the open-end fill."""
    pl = _product_labels(Fixtures(spark, sf_dir))
    return pl.join(ag.label_ranges(pl), "label", "left").select(
        "product_id", "label", "min_age_months", "max_age_months")


@shared
def _age_ranges(fx: Fixtures) -> DataFrame:
    return ag.age_ranges(_product_labels(fx))


@query
def age_ranges(spark, sf_dir):
    """Product age ranges after the open-end and catch-all fill."""
    return _age_ranges(Fixtures(spark, sf_dir)).select(
        "product_id", "label", "parsed", "min_age_months", "max_age_months")


@shared
def _age_candidates(fx: Fixtures) -> DataFrame:
    return ag.age_candidates(_imputed(fx), _age_ranges(fx))


@query
def age_candidates(spark, sf_dir):
    """Best 20 products per customer age."""
    return _age_candidates(Fixtures(spark, sf_dir))


@query
def weight_label_range(spark, sf_dir):
    """Weight label -> [min, max] kg, open ends NULL (F8 for the second interval of R6)."""
    return _weight_ranges(Fixtures(spark, sf_dir))


@shared
def _weight_ranges(fx: Fixtures) -> DataFrame:
    sheet = label_sheet(fx.spark, WEIGHT_LABELS)
    return ag.weight_ranges(fx.weight_label().join(F.broadcast(sheet), "label_no"))


@query
def age_weight_candidates(spark, sf_dir):
    """R6 with both intervals: best 20 products per customer age and fractional weight."""
    fx = Fixtures(spark, sf_dir)
    return ag.age_candidates(fx.weighed(), _age_ranges(fx), weights=_weight_ranges(fx))


@query
def age_ranges_listed(spark, sf_dir):
    """R5 behind the job's lists: 78 categories, 8 properties, maximum over the 6 age properties."""
    fx = Fixtures(spark, sf_dir)
    labels = fx.listed_label().join(F.broadcast(label_sheet(spark, AGE_LABELS)), "label_no")
    out = ag.age_ranges(labels, categories=lit.AGE_JOB_CATEGORIES, properties=lit.AGE_JOB_PROPERTIES,
                        label_properties=lit.AGE_LABEL_PROPERTIES)
    return out.select("product_id", "label", "parsed", "min_age_months", "max_age_months")


@shared
def _catalog_ids(fx: Fixtures) -> DataFrame:
    return fx.catalog().withColumn("category_id", F.col("category_code").cast("int"))


@shared
def _diversified(fx: Fixtures) -> DataFrame:
    attrs = _catalog_ids(fx).select("product_id", "category_id", "item_base_id")
    cands = ag.age_candidates(_imputed(fx), _age_ranges(fx), attributes=attrs)
    return ag.diversify(cands)


@query
def diversify(spark, sf_dir):
    """At most 2 variants per base item, round-robin over categories, 15 picks."""
    return _diversified(Fixtures(spark, sf_dir))


# -- R12-R15 upsize chain -------------------------------------------------------------
@shared
def _milk(fx: Fixtures) -> DataFrame:
    sheet = label_sheet(fx.spark, MILK_LABELS)
    return fx.milk_product().join(F.broadcast(sheet), "label_no").select("product_id", "brand_id", "label")


@shared
def _ladder(fx: Fixtures) -> DataFrame:
    return up.size_ladder(fx.size_labels(), _milk(fx))


@shared
def _upsize_rows(fx: Fixtures) -> DataFrame:
    return up.upsize(fx.cycle(), fx.catalog(), _ladder(fx))


@shared
def _linked(fx: Fixtures) -> DataFrame:
    return up.link_origin(_upsize_rows(fx), fx.cycle())


@shared
def _latest(fx: Fixtures) -> DataFrame:
    return up.latest_purchase(_linked(fx), fx.purchases())


@query
def strict_label_rank(spark, sf_dir):
    """Strict milk labels and their rank among the labels present."""
    milk = _milk(Fixtures(spark, sf_dir))
    ranks = up.milk_label_ranks(milk)
    return milk.join(ranks, "label").select("product_id", "label", "min_age_months", "range_months",
                                            "ranking")


@query
def size_ladder(spark, sf_dir):
    """Diaper and milk ladder, lowest rung per product and brand."""
    return _ladder(Fixtures(spark, sf_dir))


@query
def next_rung(spark, sf_dir):
    """Next higher rung per ladder row."""
    return up.ladder_next(_ladder(Fixtures(spark, sf_dir)))


@query
def upsize_pairs(spark, sf_dir):
    """Repurchased products and one next-rung suggestion each."""
    return _upsize_rows(Fixtures(spark, sf_dir))


@query
def origin_islands(spark, sf_dir):
    """Positional origin islands over the upsize rows."""
    out = up.origin_islands(_upsize_rows(Fixtures(spark, sf_dir)))
    return out.select("customer_id", "product_id", "type", "row_num", F.col("subgroup").cast("bigint"),
                      "product_id_ori_pos")


@query
def link_origin(spark, sf_dir):
    """Origin cycle rank, per-customer rank, origin + adjacent step."""
    return _linked(Fixtures(spark, sf_dir))


@query
def latest_purchase(spark, sf_dir):
    """Rows of the latest purchase date per customer and category."""
    return _latest(Fixtures(spark, sf_dir))


# -- R16-R18 blend -----------------------------------------------------------------------
@shared
def _appended(fx: Fixtures) -> DataFrame:
    age = _diversified(fx).select("customer_id", "product_id", "pick")
    return bl.append_ranked(_latest(fx), age)


@shared
def _cold(fx: Fixtures) -> DataFrame:
    return bl.cold_start(fx.cycle(), bl.frequency_list(fx.purchases(), customers=bl.cold_customers(fx.cycle())))


@query
def append_ranked(spark, sf_dir):
    """Age list appended after the upsize list, 30 per customer."""
    return _appended(Fixtures(spark, sf_dir)).select(
        "customer_id", "product_id", "rank", "type", "category_code", "product_id_ori", "rank_chu_ky",
        "formatted_date")


@query
def cap_30(spark, sf_dir):
    """Latest 30 products per customer."""
    last = up.last_purchase(Fixtures(spark, sf_dir).purchases())
    return bl.cap_per_customer(last, [F.col("formatted_date").desc(), F.col("product_id").asc()])


@query
def cold_start(spark, sf_dir):
    """Frequency list for customers without a usable cycle row."""
    return _cold(Fixtures(spark, sf_dir))


@query
def blended(spark, sf_dir):
    """The blended top-30 list with catalog columns and model code."""
    fx = Fixtures(spark, sf_dir)
    return bl.blend(_appended(fx), _cold(fx), fx.catalog(), fx.model_map())


# -- R9-R11 attributes, profiles, similar products ------------------------------------------
@shared
def _active(fx: Fixtures) -> DataFrame:
    return sm.active(fx.properties())


@query
def property_list_explode(spark, sf_dir):
    """Listed property ids per category: split, tolerant cast, positive."""
    return sm.listed_properties(_active(Fixtures(spark, sf_dir)))


@query
def attributes_in_list(spark, sf_dir):
    """Listed attributes per category."""
    return sm.attributes_in_list(_active(Fixtures(spark, sf_dir)))


@query
def attribute_importance(spark, sf_dir):
    """Attribute weights by coverage and value entropy, normalised."""
    return sm.attribute_importance(_active(Fixtures(spark, sf_dir)))


@query
def reply_attributes(spark, sf_dir):
    """Attribute replies parsed, filtered, weights filled and normalised."""
    fx = Fixtures(spark, sf_dir)
    return rp.reply_attributes(fx.attribute_replies(), sm.attributes_in_list(_active(fx)))


@query
def product_profiles(spark, sf_dir):
    """One profile text per product."""
    return sm.product_profiles(_active(Fixtures(spark, sf_dir)))


@query
def similar_products(spark, sf_dir):
    """Ten most similar products per product, same category."""
    props = _active(Fixtures(spark, sf_dir))
    return sm.similar_with_names(sm.similar_products(props), props)


@query
def similar_other_brand(spark, sf_dir):
    """R11 with other-brand partners only, NULL brand as other."""
    props = _active(Fixtures(spark, sf_dir))
    return sm.similar_with_names(sm.similar_products(props, exclude_same_brand=True), props)


# -- S10 / S11 / R7 / J15-J18 request and reply tables ------------------------------------------
@query
def request_ages(spark, sf_dir):
    """One request per distinct (age, weight)."""
    fx = Fixtures(spark, sf_dir)
    cust = im.attach_growth(_imputed(fx).select("customer_id", "expected_age_last"), fx.growth())
    return rp.age_requests(cust)


@query
def request_attributes(spark, sf_dir):
    """One attribute request per category."""
    return rp.attribute_requests(sm.attributes_in_list(_active(Fixtures(spark, sf_dir))))


@query
def reply_names(spark, sf_dir):
    """Name replies parsed into ordered names."""
    return rp.parse_name_replies(Fixtures(spark, sf_dir).name_replies())


@shared
def _resolved(fx: Fixtures) -> DataFrame:
    return rp.resolve_names(rp.parse_name_replies(fx.name_replies()), fx.catalog())


@shared
def _resolved_to_names(fx: Fixtures) -> DataFrame:
    """As above, one row per request and catalog name: counts need no row per product."""
    return rp.resolve_names(rp.parse_name_replies(fx.name_replies()), fx.catalog(), products=False)


@query
def resolve_names(spark, sf_dir):
    """Reply names resolved to products, exact -> lower -> fuzzy."""
    return _resolved(Fixtures(spark, sf_dir))


@query
def fuzzy_names(spark, sf_dir):
    """Misspelt names matched to catalog names through the segment index."""
    fx = Fixtures(spark, sf_dir)
    q = fx.misspelt().select(F.col("product_id").alias("qid"), F.col("query_name").alias("query"))
    best = fz.fuzzy_best(q, fx.catalog().select(F.col("product_name").alias("name")))
    return q.join(best, "qid").select(F.col("qid").alias("product_id"), F.col("query").alias("query_name"),
                                      F.col("name").alias("matched_name"), "score")


@query
def reply_products(spark, sf_dir):
    """JSON product replies mapped by code or name."""
    fx = Fixtures(spark, sf_dir)
    prof = fx.catalog().select(F.col("product_id").cast("string").alias("product_code"), "product_name")
    return rp.resolve_products(fx.product_replies(), prof)


@query
def match_metrics(spark, sf_dir):
    """Request / match counters of the name resolution."""
    fx = Fixtures(spark, sf_dir)
    return rp.match_metrics(fx.name_replies(), _resolved_to_names(fx))


@query
def no_match_rows(spark, sf_dir):
    """Requests whose reply resolved to no product."""
    fx = Fixtures(spark, sf_dir)
    return rp.unresolved_requests(fx.name_replies(), _resolved_to_names(fx))


# -- S7 / P19 positional batches ---------------------------------------------------------------
@query
def batch_numbers(spark, sf_dir):
    """Global row numbers and 500-row batches without a single-task window."""
    person = Fixtures(spark, sf_dir).person().select("customer_id")
    return keys.batch_numbers(person, ["customer_id"], 500)


@query
def customer_range(spark, sf_dir):
    """Rows by global position (P19); here the whole table."""
    person = Fixtures(spark, sf_dir).person().select("customer_id", "expected_age_last")
    return keys.row_range(person, ["customer_id"], start=0, end=None)


@query
def customer_range_inside(spark, sf_dir):
    """Rows 50 to 1049 by global position."""
    person = Fixtures(spark, sf_dir).person().select("customer_id", "expected_age_last")
    return keys.row_range(person, ["customer_id"], start=50, end=1049)


@query
def fuzzy_names_indel(spark, sf_dir):
    """J15 with the original matcher's InDel ratio (D8); its SQL folds the edit matrix over arrays."""
    fx = Fixtures(spark, sf_dir)
    q = fx.misspelt().select(F.col("product_id").alias("qid"), F.col("query_name").alias("query"))
    best = fz.fuzzy_best(q, fx.catalog().select(F.col("product_name").alias("name")), metric="indel")
    return q.join(best, "qid").select(F.col("qid").alias("product_id"), F.col("query").alias("query_name"),
                                      F.col("name").alias("matched_name"), "score")


@query
def request_similar(spark, sf_dir):
    """One similarity request per product: its profile and up to 1000 others of its category."""
    return rq.similarity_requests(sm.product_profiles(_active(Fixtures(spark, sf_dir))))


@query
def request_similar_other_brand(spark, sf_dir):
    """Similarity requests whose candidates are of another brand."""
    return rq.similarity_requests(sm.product_profiles(_active(Fixtures(spark, sf_dir))), other_brand=True)


@query
def request_catalog(spark, sf_dir):
    """The sorted catalog name list as its own table."""
    return rp.catalog_lines(Fixtures(spark, sf_dir).catalog())


# -- tables written and read back ---------------------------------------------------------------
def _place(spark, name: str) -> str:
    """A new folder for a table, in the shared checkpoint folder."""
    return checkpoint_path(spark, f"{name}-{uuid.uuid4().hex}")


@query
def frequency_sorted(spark, sf_dir):
    """The frequency profile written in global order, read back with its row numbers."""
    fx, path = Fixtures(spark, sf_dir), _place(spark, "frequency")
    jobs.frequency_job(fx.order_lines(), fx.excluded(), fx.model_map(), path, FIXTURE_OUTPUT_TYPES)
    return ranged.read_sorted(spark, path)


@query
def frequency_slice(spark, sf_dir):
    """Customers 100 to 299 of the sorted table, from the files that hold them."""
    fx, path = Fixtures(spark, sf_dir), _place(spark, "frequency")
    jobs.frequency_job(fx.order_lines(), fx.excluded(), fx.model_map(), path, FIXTURE_OUTPUT_TYPES)
    return ranged.read_sorted(spark, path, 100, 299)


@query
def growth_from_sheet(spark, sf_dir):
    """Growth values of all customers from the spreadsheet itself; a cell that is no number is a gap."""
    fx, path = Fixtures(spark, sf_dir), _place(spark, "growth") + ".xlsx"
    growth_workbook(fx.growth(), path)
    cust = _imputed(fx).select("customer_id", "expected_age_last")
    return im.attach_growth(cust, read_growth_sheet(spark, path, "xlsx"))


@query
def growth_sheet_cells(spark, sf_dir):
    """Rows of the spreadsheet with the customers of their age and the cells kept apart."""
    fx, path = Fixtures(spark, sf_dir), _place(spark, "growth") + ".xlsx"
    growth_workbook(fx.growth(), path)
    n = _imputed(fx).groupBy(F.col("expected_age_last").alias("age_months")).agg(F.count(F.lit(1)).alias("n_customers"))
    sheet = read_growth_sheet(spark, path, "xlsx", bad_cells=True)
    return sheet.join(n, "age_months", "left").select(
        "age_months", "weight_kg", "height_cm", "bad_cells", F.coalesce("n_customers", F.lit(0)).alias("n_customers"))


@query
def reply_intake(spark, sf_dir):
    """Raw reply bodies to items: lists, fences, single objects, wrong types, broken and missing bodies."""
    out = intake.reply_items(Fixtures(spark, sf_dir).raw_replies())
    return out.select("request_id", "state", "pos", "is_object", "code", "name")


@query
def run_statistics(spark, sf_dir):
    """Rows, distinct requests and products per batch of 100 requests and over the run, from mergeable bitmaps."""
    fx = Fixtures(spark, sf_dir)
    res = _resolved_to_names(fx).withColumn("batch", F.floor(F.col("request_id") / 100).cast("long"))
    return statistics.run_statistics(res.select("batch", "request_id", "product_name"), "batch", ["request_id", "product_id"],
                                     members=fx.catalog().select("product_name", "product_id"), on=["product_name"])


@query
def batch_commits(spark, sf_dir):
    """The age picks written as committed batches of 500 customers: the manifest."""
    picks = _diversified(Fixtures(spark, sf_dir)).select("customer_id", "product_id", "pick")
    return batches.write_batches(picks, _place(spark, "picks"), ["customer_id"], 500)


@query
def companion_files(spark, sf_dir):
    """The companion products in 48 files: files and rows as read back."""
    fx, path = Fixtures(spark, sf_dir), _place(spark, "companions")
    jobs.companion_job(fx.properties(), fx.property_map(), fx.model_map(), path)
    return spark.read.parquet(path).agg(F.count_distinct("_metadata.file_name").alias("files"), F.count(F.lit(1)).alias("rows"))


@query
def run_date_path(spark, sf_dir):
    """The catalog written under run date and category, one category twice, read back."""
    cat, path = Fixtures(spark, sf_dir).catalog().drop("category_name"), _place(spark, "catalog")
    day = F.to_date(F.lit("2024-02-29"))
    dated = cat.withColumn("run_date", format_run_date(day))
    sinks.write_table(dated, path, partition_by=["run_date", "category_code"])
    again = dated.filter("category_code = '3'").withColumn("product_name", F.upper("product_name"))
    sinks.write_table(again, path, partition_by=["run_date", "category_code"])
    back = spark.read.schema(dated.schema).parquet(path)
    return back.select("run_date", "category_code", "product_id", "product_name", "brand_id", "item_base_id")


@query
def text_timestamps(spark, sf_dir):
    """Purchase times that arrive as text, NULL where they do not parse."""
    t = Fixtures(spark, sf_dir).text_orders()
    return t.select("order_id", "ordered_text", as_timestamp("ordered_text").alias("ordered_at"))


# -- S9 quarantine tables ---------------------------------------------------------------------------
@query
def off_ladder(spark, sf_dir):
    """Products whose size or milk label is not on the ladder."""
    fx = Fixtures(spark, sf_dir)
    return up.off_ladder(fx.size_labels(), _milk(fx))


@query
def similar_errors(spark, sf_dir):
    """Active products without any similar product."""
    props = _active(Fixtures(spark, sf_dir))
    return sm.similar_errors(props, sm.similar_products(props))


@query
def age_no_match(spark, sf_dir):
    """Customers without any age candidate."""
    fx = Fixtures(spark, sf_dir)
    return ag.unmatched(_imputed(fx).select("customer_id"), _age_candidates(fx))


@query
def similar_weighted(spark, sf_dir):
    """R11 with R9 attribute weights: the similar job's scoring."""
    props = _active(Fixtures(spark, sf_dir))
    pairs = sm.similar_products(props, weights=sm.attribute_importance(props))
    return sm.similar_with_names(pairs, props)
