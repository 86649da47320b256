"""End-to-end jobs: inputs in, one write out (the five original scripts).

Each function takes the input DataFrames and output paths; all work is one
logical plan per written table.  ``Fixtures`` supplies test inputs of the
same shape from the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import affinity, ages, blend, frequency, impute, replies, requests, similar, upsize
from ..sources import literals as L
from ..sources import batches, ranged, sinks

FREQUENCY_ORDER = ["customer_id", "category_rank", "category_id", "product_id", "model_code"]


def frequency_job(lines: DataFrame, excluded: DataFrame, model_map: DataFrame, out: str,
                  output_types=L.OUTPUT_TYPES) -> None:
    """Frequency profile per customer and category in global order: sorted
    files that do not overlap, with a key-range manifest (O1)."""
    df = frequency.frequency_profile(lines, excluded, model_map, output_types)
    ranged.write_sorted(df, out, FREQUENCY_ORDER)


def companion_job(properties: DataFrame, mapping: DataFrame, model_map: DataFrame, out: str,
                  n_files: int = L.COMPANION_OUTPUT_FILES) -> None:
    """Best companion per product and companion category, in ``n_files`` files."""
    sinks.write_files(affinity.companion_products(properties, mapping, model_map), out, n_files)


def age_job(persons: DataFrame, growth: DataFrame, labels: DataFrame, catalog: DataFrame, out: str,
            no_match_out: str | None = None, batch_size: int | None = None,
            weight_labels: DataFrame | None = None, run_date: str | None = None) -> None:
    """Impute ages, attach growth values, match age ranges, diversify.

    Customers without any product go to ``no_match_out`` (S9).  With
    ``batch_size`` the result is written as numbered customer batches that
    a restarted job completes (S7);
    otherwise with ``run_date`` it lands in that day's partition (S8).
    ``weight_labels`` (product_id, label) adds the weight interval (R6).
    Labels with ``category_code`` or ``propertyid`` meet the job's
    allow-lists (P9).
    """
    lists = {}
    if "category_code" in labels.columns:
        lists["categories"] = L.AGE_JOB_CATEGORIES
    if "propertyid" in labels.columns:
        lists.update(properties=L.AGE_JOB_PROPERTIES, label_properties=L.AGE_LABEL_PROPERTIES)
    # customers feed the distinct ages, the final join and the no-match table
    cust = sinks.cut_lineage(impute.attach_growth(impute.impute_by_group(persons), growth), "age_customers")
    weights = ages.weight_ranges(weight_labels) if weight_labels is not None else None
    attrs = catalog.select("product_id", "category_id", "item_base_id")
    picks = ages.diversify(ages.age_candidates(cust, ages.age_ranges(labels, **lists), weights=weights, attributes=attrs))
    picks = picks.join(catalog.select("product_id", "product_name", "category_name"), "product_id", "left")
    if batch_size:
        batches.write_batches(picks, out, ["customer_id"], batch_size)
    elif run_date:
        sinks.write_table(sinks.with_run_date(picks, run_date), out, partition_by=["run_date"])
    else:
        sinks.write_table(picks, out)
    if no_match_out:
        sinks.write_table(ages.unmatched(cust.select("customer_id"), picks), no_match_out)


def similar_job(properties: DataFrame, out: str, errors_out: str | None = None,
                top_n: int = L.SIMILAR_TOP_N, exclude_same_brand: bool = False,
                attribute_top_k: int | None = None, requests_out: str | None = None) -> None:
    """Attribute weights, profiles and the top-N similar products of every
    active product, with profile texts; targets without any pair go to
    ``errors_out``.  By default all listed attributes count, weighted by
    R9.  ``attribute_top_k`` keeps each category's most important
    attributes only, as the original job does with its chosen one; with
    the entropy weights a near-unique attribute (a price) ranks first and
    shares few values, so the weighted form is the default.
    ``requests_out`` takes one request per product with up to 1000
    others of its category (S10)."""
    props = similar.active(properties)
    weights = similar.attribute_importance(props)
    if attribute_top_k is not None:
        props = similar.top_attributes(props, weights, attribute_top_k)
    pairs = similar.similar_products(props, weights, top_n, exclude_same_brand=exclude_same_brand)
    prof = similar.product_profiles(props).select("product_code", "text_for_llm")
    res = similar.similar_with_names(pairs, props)
    res = (res.join(prof.withColumnRenamed("text_for_llm", "text_for_llm_main"), "product_code", "left")
           .join(prof.select(F.col("product_code").alias("alike_product_code"),
                             F.col("text_for_llm").alias("text_for_llm_alike")), "alike_product_code", "left"))
    sinks.write_table(res, out, partition_by=["category_id"])
    if errors_out:
        sinks.write_table(similar.similar_errors(props, pairs), errors_out)
    if requests_out:
        sinks.write_table(requests.similarity_requests(similar.product_profiles(props), other_brand=exclude_same_brand),
                          requests_out)


def upsize_job(cycle: DataFrame, catalog: DataFrame, diapers: DataFrame, milk: DataFrame,
               purchases: DataFrame, age_picks: DataFrame, model_map: DataFrame, out: str,
               cut: bool = True) -> None:
    """Upsize rows, age list appended, cold-start frequency list, top 30.

    With ``cut`` the upsize rows are written to the checkpoint folder
    first, so the blend stage restarts from them after a failure.
    """
    ladder = upsize.size_ladder(diapers, milk)
    rows = upsize.latest_purchase(upsize.link_origin(upsize.upsize(cycle, catalog, ladder), cycle), purchases)
    if cut:
        rows = sinks.cut_lineage(rows, "upsize_rows")
    ranked = blend.append_ranked(rows, age_picks.select("customer_id", "product_id", "pick"))
    cold = blend.cold_start(cycle, blend.frequency_list(purchases, customers=blend.cold_customers(cycle)))
    sinks.write_table(blend.blend(ranked, cold, catalog, model_map), out)


def name_reply_job(replies_df: DataFrame, catalog: DataFrame, out: str,
                   unmatched_out: str) -> tuple[DataFrame, dict]:
    """Parse and resolve chat replies; unmatched requests kept apart.

    Returns the one-row metrics table and the counters observed during the
    write (A15)."""
    resolved = replies.resolve_names(replies.parse_name_replies(replies_df), catalog)
    observed = sinks.write_observed(resolved, out, "resolved", {
        "product_rows": F.count(F.lit(1)),
        "fuzzy_rows": F.count_if(F.col("match_kind") == "fuzzy")})
    written = resolved.sparkSession.read.parquet(out)
    sinks.write_table(replies.unresolved_requests(replies_df, written), unmatched_out)
    return replies.match_metrics(replies_df, written), observed
