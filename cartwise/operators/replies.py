"""S10, S11, R7, J15, J16, J18 — request tables out, reply tables in.

The choice steps that the original jobs hand to a chat model are exchanged
as tables: Spark builds one request row per distinct request key, replies
come back as a (request key, text) table, and parsing plus name resolution
run here as joins.

Fuzzy matching (J15) is :mod:`cartwise.operators.fuzzy`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.replies import attribute_list, name_list, product_list
from ..functions.text import before_marker, strip
from ..sources import literals as L
from ..session import ensure_checkpoint_dir
from .fuzzy import fuzzy_best
from .keys import first_per_key, top_k_per_key
from .similar import normalize_weights

IDS_PER_LIST = 1024


# -- S11 reply intake ---------------------------------------------------------------------
def reply_content(raw: Column) -> Column:
    """Message text of a chat-completion JSON body; ``[]`` when missing."""
    return F.coalesce(F.get_json_object(raw, "$.choices[0].message.content"), F.lit("[]"))


def attach_replies(requests: DataFrame, replies: DataFrame, key: str = "request_id",
                   text: str = "reply") -> DataFrame:
    """Each request with its reply text; a missing reply reads as ``[]``."""
    return (requests.join(replies.select(key, text), key, "left")
            .withColumn(text, F.coalesce(F.col(text), F.lit("[]"))))


# -- S10 request tables -------------------------------------------------------------------
def age_requests(customers: DataFrame, age_col: str = "expected_age_last",
                 weight_col: str = "weight_kg", k: int = L.AGE_POOL_K) -> DataFrame:
    """One request per distinct (age, weight) instead of one per customer.

    The catalog name list is not inlined: it is the separate, sorted
    ``catalog_lines`` table, so no row carries the whole catalog.
    """
    g = customers.groupBy(F.col(age_col).alias("age_months"), F.col(weight_col).alias("weight_kg")).agg(
        F.count(F.lit(1)).alias("n_customers"))
    prompt = F.concat(F.lit("age_months="), F.coalesce(F.col("age_months").cast("string"), F.lit("")),
                      F.lit("; weight_kg="), F.coalesce(F.col("weight_kg").cast("string"), F.lit("")),
                      F.lit(f"; top_k={k}"))
    return g.select("age_months", "weight_kg", "n_customers", prompt.alias("prompt"))


def catalog_lines(catalog: DataFrame, name_col: str = "product_name") -> DataFrame:
    """Distinct catalog names as ``- name`` lines, sorted by a distributed sort."""
    return (catalog.select(F.col(name_col).alias("name")).filter(F.col("name").isNotNull()).distinct()
            .select("name", F.concat(F.lit("- "), F.col("name")).alias("line")).orderBy("name"))


def attribute_requests(attributes: DataFrame, top_k: int = L.ATTRIBUTE_TOP_K,
                       group: str = "category_id") -> DataFrame:
    """One request per category listing its attributes, sorted."""
    g = attributes.groupBy(group).agg(F.array_sort(F.collect_set("property_name")).alias("_names"))
    lines = F.array_join(F.transform("_names", lambda n: F.concat(F.lit("- "), n)), "\n")
    prompt = F.concat(F.lit("category="), F.col(group).cast("string"), F.lit(f"; top_k={top_k}\n"), lines)
    return g.select(group, F.size("_names").alias("n_attributes"), prompt.alias("prompt"))


# -- R7 / F11 parsed names -------------------------------------------------------------------
def parse_name_replies(replies: DataFrame, key: str = "request_id", text: str = "reply") -> DataFrame:
    """(request, reply) -> (request, pos, name), reply order kept."""
    return replies.select(key, F.posexplode(name_list(F.col(text))).alias("pos", "name"))


# -- J16 name resolution --------------------------------------------------------------------
def resolve_names(names: DataFrame, catalog: DataFrame, cutoff: int = L.FUZZY_CUTOFF,
                  key: str = "request_id", fuzzy: bool = True, metric: str = "levenshtein",
                  materialize: bool = True, products: bool = True) -> DataFrame:
    """Reply names -> catalog products, in reply order.

    Each name is cut at ``@@`` and resolved by exact name, else lower-case
    name, else the fuzzy join; a catalog name is used once per request
    (first position wins) and expands to all products carrying it.
    Returns (request_id, pos, product_id, product_name, match_kind).
    ``materialize`` checkpoints the exact/lower-case step (shared folder):
    the fuzzy branch and the final join both read it, and it carries the
    parsing of every reply text.
    Where many products carry a name, the product rows are far more than both
    inputs hold: ``products=False`` leaves the names as one row each
    (request_id, pos, product_name, match_kind, n_products), for counts.
    """
    cat = catalog.select("product_id", "product_name").filter(F.col("product_name").isNotNull())
    names_u = cat.select(F.col("product_name").alias("true_name")).distinct()
    items = names.select(key, "pos", before_marker(F.col("name")).alias("base")).filter(F.col("base") != "")
    # exact and lower-case matches in one join on the lower-cased name
    low = names_u.select("true_name", F.lower("true_name").alias("_low"))
    m = items.join(low, F.lower(items.base) == low._low, "left").groupBy(key, "pos", "base").agg(
        F.max(F.col("base") == F.col("true_name")).alias("_exact"), F.min("true_name").alias("_lower"))
    stage = F.when(F.col("_exact"), 1).when(F.col("_lower").isNotNull(), 2)
    m = m.select(key, "pos", "base", F.when(F.col("_exact"), F.col("base")).otherwise(F.col("_lower"))
                 .alias("true_name"), stage.alias("_stage"))
    if materialize and fuzzy:
        ensure_checkpoint_dir(names.sparkSession)
        m = m.checkpoint(eager=True)
    if fuzzy:
        rest = m.filter(F.col("_stage").isNull()).select(F.col("base").alias("query")).distinct()
        fz = fuzzy_best(rest.withColumn("qid", F.col("query")), names_u, cutoff, qid="qid", qtext="query",
                        ctext="true_name", metric=metric).select(F.col("qid").alias("base"), F.col("true_name").alias("_fz"))
        m = m.join(fz, "base", "left").select(
            key, "pos", "base", F.coalesce("true_name", "_fz").alias("true_name"),
            F.coalesce(F.col("_stage"), F.when(F.col("_fz").isNotNull(), 3)).alias("_stage"))
    found = m.filter(F.col("true_name").isNotNull())
    first = first_per_key(found, [key, "true_name"], [F.col("pos").asc()])
    kinds = F.element_at(F.array(F.lit("exact"), F.lit("lower"), F.lit("fuzzy")), F.col("_stage"))
    if not products:
        held = cat.groupBy("product_name").agg(F.count(F.lit(1)).alias("n_products"))
        return (first.join(held, first.true_name == held.product_name)
                .select(key, "pos", "product_name", kinds.alias("match_kind"), "n_products"))
    # a name met by many requests and carried by many products gives a row for each pair: its ids
    # come as lists, so that the join meets lists and only their unfolding makes the rows.
    # Lists, names' counts and the join share one exchange of the catalog
    shares = F.ceil(F.count(F.lit(1)).over(Window.partitionBy("product_name")) / IDS_PER_LIST)
    lists = cat.withColumn("_share", F.pmod(F.xxhash64("product_id"), shares)).groupBy("product_name", "_share").agg(
        F.collect_list(F.struct("product_id")).alias("_ids"))
    # lists compress well: joined by shuffle, whatever their files' size
    met = first.select(key, "pos", F.col("true_name").alias("product_name"), kinds.alias("match_kind")).join(
        lists.drop("_share").hint("merge"), "product_name")
    return met.select(key, "pos", "product_name", "match_kind", F.inline("_ids")).select(
        key, "pos", "product_id", "product_name", "match_kind")


def unresolved_requests(replies: DataFrame, resolved: DataFrame, key: str = "request_id") -> DataFrame:
    """Requests whose reply resolved to no product, with their text."""
    return replies.join(resolved.select(key).distinct(), key, "left_anti")


def match_metrics(replies: DataFrame, resolved: DataFrame, key: str = "request_id") -> DataFrame:
    """One row of counters (A15): requests, matched requests, product rows.

    ``resolved`` holds product rows, or names with their number of products."""
    n = F.sum("n_products") if "n_products" in resolved.columns else F.count(F.lit(1))
    per = resolved.groupBy(key).agg(n.alias("_n"))
    j = replies.select(key).distinct().join(per, key, "left")
    return j.agg(F.count(F.lit(1)).alias("requests"),
                 F.count("_n").alias("matched_requests"),
                 F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("product_rows"),
                 F.count_if(F.col("_n").isNull()).alias("unmatched_requests"))


# -- J18 product replies --------------------------------------------------------------------
def resolve_products(replies: DataFrame, profiles: DataFrame, top_n: int = L.SIMILAR_TOP_N,
                     key: str = "request_id", text: str = "reply") -> DataFrame:
    """Reply items (code and/or name) -> profile rows.

    An item matches a profile by code, or by case-insensitive name; the
    first match in profile order (code) wins.  The OR join is two equi
    joins and a union.  One row per alike code per request (first item
    wins), at most ``top_n``.
    """
    items = replies.select(key, F.posexplode(product_list(F.col(text), top_n)).alias("pos", "it"))
    items = items.select(key, "pos", F.col("it.code").alias("code"), F.col("it.name").alias("name"))
    prof = profiles.select(F.col("product_code").alias("_code"), F.col("product_name").alias("_name"))
    # the first profile of a code, and of a name, is the only one an item can get:
    # chosen before the joins, which then give an item two rows at most and go by
    # shuffle, as both tables grow with the catalog
    low = F.lower(F.col("_name"))
    codes = first_per_key(prof, "_code", [low.asc(), F.col("_name").asc()])
    names = first_per_key(prof.withColumn("_low", low), "_low", [F.col("_code").asc(), F.col("_name").asc()])
    by_code = items.filter(F.col("code") != "").join(codes.hint("merge"), F.col("code") == F.col("_code"))
    by_name = items.filter(F.col("name") != "").join(names.hint("merge"), F.lower(F.col("name")) == F.col("_low")).drop("_low")
    # by request once, for the three windows, in as many parts as the cluster shuffles
    n = int(replies.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hits = by_code.unionByName(by_name).repartition(n, key)
    first = first_per_key(hits, [key, "pos"], [F.col("_code").asc()])
    first = first_per_key(first, [key, "_code"], [F.col("pos").asc()])
    first = top_k_per_key(first, key, [F.col("pos").asc()], top_n)
    return first.select(key, "pos", F.col("_code").alias("alike_product_code"),
                        F.col("_name").alias("alike_product_name"))


# -- F12 + A14 attribute replies --------------------------------------------------------------
def reply_attributes(replies: DataFrame, allowed: DataFrame, top_k: int = L.ATTRIBUTE_TOP_K,
                     key: str = "request_id", text: str = "reply",
                     allowed_key: str = "category_id", allowed_name: str = "property_name") -> DataFrame:
    """Parse attribute replies, keep allowed attributes (first position per
    attribute), fill and normalise weights, cut to ``top_k`` (F12 U3 A14)."""
    items = replies.select(key, F.posexplode(attribute_list(F.col(text))).alias("pos", "it"))
    items = items.select(key, "pos", F.col("it.attribute").alias("attribute"),
                         F.col("it.reason").alias("reason"), F.col("it.weight").alias("weight"))
    ok = allowed.select(F.col(allowed_key).alias(key), strip(F.col(allowed_name)).alias("attribute")).distinct()
    items = items.join(ok, [key, "attribute"], "left_semi")
    items = first_per_key(items, [key, "attribute"], [F.col("pos").asc()])
    out = normalize_weights(items, [key], [F.col("pos").asc()], top_k=top_k)
    return out.select(key, "attr_rank", "attribute", "weight")
