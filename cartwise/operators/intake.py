"""S11 F12 F13 — replies as they arrive: from the raw body to items.

A reply body is parsed once into a VARIANT, its message content once more, and the
elements of the content's array are exploded with their positions.  Bodies that are
missing, broken or without content, contents without a list, and elements of a wrong
type keep a row each that says so, so nothing needs a second look at the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

STATES = ("missing", "broken", "no_content", "no_items", "ok")


def reply_items(replies: DataFrame, key: str = "request_id", raw: str = "raw") -> DataFrame:
    """One row per element: key, state, pos, is_object, code, name, attribute, reason, weight.

    ``state``: ``missing`` (no body), ``broken`` (the body is no JSON object), ``no_content``
    (no message text in it), ``no_items`` (the text holds neither an array nor an
    object that parses), ``ok``; only ``ok`` has positions.  The text's list is its longest
    span from ``[`` to ``]``, whatever stands around it (a fence, a sentence); without
    brackets a single object counts as a list of one.  ``code`` is the first non-empty
    of productcode and code, ``name`` of productname and name, numbers as text; a
    ``weight`` that is no number is NULL; an element that is no object has none of these.
    """
    spark = replies.sparkSession
    parsed = spark.sql(
        f"SELECT `{key}` AS k, `{raw}` AS raw, try_parse_json(`{raw}`) AS body FROM {{r}}", r=replies)
    content = spark.sql("""
        SELECT k, raw, coalesce(schema_of_variant(body) LIKE 'OBJECT%', false) AS is_body,
               try_variant_get(body, '$.choices[0].message.content', 'string') AS content
        FROM {p}""", p=parsed)
    found = spark.sql(r"""
        SELECT *, CASE WHEN content RLIKE '(?s)\\[.*\\]' THEN regexp_extract(content, '(?s)\\[.*\\]', 0)
                       WHEN content RLIKE '(?s)\\{{.*\\}}' THEN concat('[', regexp_extract(content, '(?s)\\{{.*\\}}', 0), ']') END AS list
        FROM {c}""", c=content)
    lists = spark.sql("SELECT k, raw, is_body, content, try_parse_json(list) AS items FROM {f}", f=found)
    rows = spark.sql("""
        SELECT l.k, CASE WHEN raw IS NULL THEN 'missing' WHEN NOT is_body THEN 'broken' WHEN content IS NULL THEN 'no_content'
                         WHEN items IS NULL THEN 'no_items' ELSE 'ok' END AS state,
               e.pos, e.value AS value, schema_of_variant(e.value) LIKE 'OBJECT%' AS is_object
        FROM {l} l, LATERAL variant_explode_outer(l.items) e""", l=lists)
    text = "trim(try_variant_get(value, '$.{0}', 'string'))"
    first = "coalesce(nullif({}, ''), nullif({}, ''))".format
    return spark.sql(f"""
        SELECT k AS `{key}`, state, pos, is_object, {first(text.format('productcode'), text.format('code'))} AS code,
               {first(text.format('productname'), text.format('name'))} AS name,
               nullif({text.format('attribute')}, '') AS attribute, {text.format('reason')} AS reason,
               try_cast({text.format('weight')} AS double) AS weight
        FROM {{r}}""", r=rows)
