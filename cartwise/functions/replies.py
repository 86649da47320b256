"""Parsers for reply texts, as array-valued Column expressions.

Replies arrive as a string column; these turn each into an array that the
caller explodes with its position.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _c, clean_item, first_non_empty, strip, to_double

_STRICT_JSON = {"allowSingleQuotes": "false"}


def name_list(reply) -> Column:
    """Reply text -> array of names, in reply order.

    1. the first ``[...]`` block, split on commas (wins even when empty);
    2. else lines starting with ``-``, ``*`` or ``•``;
    3. else every non-blank line.
    Each item: stripped, quotes removed, blanks collapsed; empty items dropped.
    """
    t = _c(reply)
    bracket = r"(?s)\[(.*?)\]"
    bullets = F.regexp_extract_all(t, F.lit(r"(?m)^[-*•]\s*(.+)$"), 1)
    raw = (F.when(t.rlike(bracket), F.split(F.regexp_extract(t, bracket, 1), ","))
           .when(F.size(bullets) > 0, bullets)
           .otherwise(F.split(t, r"\R")))
    cleaned = F.transform(raw, clean_item)
    return F.filter(cleaned, lambda x: strip(x) != "")


def _json_elements(reply) -> Column:
    """The greedy ``[...]`` span of the text parsed as a JSON array of raw
    element texts; NULL when it is not valid JSON."""
    span = F.regexp_extract(_c(reply), r"(?s)\[.*\]", 0)
    return F.from_json(span, "array<string>", _STRICT_JSON)


def attribute_list(reply) -> Column:
    """Reply -> array<struct<attribute, reason, weight double>>.

    Elements that are not objects or have an empty attribute are dropped;
    a weight that is not a number becomes NULL.
    """
    elems = F.coalesce(_json_elements(reply), F.array().cast("array<string>"))
    parsed = F.transform(elems, lambda x: F.from_json(
        x, "attribute string, reason string, weight string", _STRICT_JSON))
    items = F.transform(parsed, lambda s: F.struct(
        strip(F.coalesce(s["attribute"], F.lit(""))).alias("attribute"),
        strip(F.coalesce(s["reason"], F.lit(""))).alias("reason"),
        to_double(strip(s["weight"])).alias("weight")))
    return F.filter(items, lambda s: s["attribute"] != "")


def product_list(reply, top_n: int = 10) -> Column:
    """Reply -> array<struct<code, name>> of the first ``top_n`` elements.

    ``code`` is the first non-empty of productcode/code, ``name`` of
    productname/name; elements with neither are dropped *after* the cut,
    as the original loop does.
    """
    elems = F.coalesce(_json_elements(reply), F.array().cast("array<string>"))
    elems = F.slice(elems, 1, top_n)
    parsed = F.transform(elems, lambda x: F.from_json(
        x, "productcode string, productname string, code string, name string", _STRICT_JSON))
    items = F.transform(parsed, lambda s: F.struct(
        strip(first_non_empty(s["productcode"], s["code"])).alias("code"),
        strip(first_non_empty(s["productname"], s["name"])).alias("name")))
    return F.filter(items, lambda s: (s["code"] != "") | (s["name"] != ""))
