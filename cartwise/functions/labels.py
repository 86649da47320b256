"""Age-label parsers as ordered ``CASE`` chains.

Both return a struct column; no Python runs per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..sources import literals as L
from .text import _c, strip

NUM = r"(\d+(?:[\.,]\d+)?)"
UNIT = f"({L.UNIT_MONTH}|{L.UNIT_YEAR})"


def _num(text: Column, pattern: str, idx: int) -> Column:
    return F.regexp_replace(F.regexp_extract(text, pattern, idx), ",", ".").cast("double")


def _months(text: Column, pattern: str, value_idx: int, unit_idx: int) -> Column:
    unit = F.regexp_extract(text, pattern, unit_idx)
    return _num(text, pattern, value_idx) * F.when(unit == L.UNIT_YEAR, 12.0).otherwise(1.0)


def age_range(label) -> Column:
    """Lenient age label -> struct(min_age_months, max_age_months).

    Rules in order, first hit wins, text lower-cased and stripped:
    newborn anywhere -> (0, 2); "dưới x U" -> (0, x); "từ x U đến y U";
    "từ x U" -> (x, NULL: open end); "x - y U"; "x U - y U"; "x U" -> (x, x).
    U is months or years (x 12); comma or dot decimals.  Else (NULL, NULL).
    """
    t = F.lower(strip(_c(label)))
    under = rf"^dưới\s+{NUM}\s*{UNIT}"
    from_to = rf"^từ\s+{NUM}\s*{UNIT}\s+đến\s+{NUM}\s*{UNIT}"
    from_ = rf"^từ\s+{NUM}\s*{UNIT}"
    dash = rf"^{NUM}\s*-\s*{NUM}\s*{UNIT}"
    dash_units = rf"^{NUM}\s*{UNIT}\s*-\s*{NUM}\s*{UNIT}"
    single = rf"^{NUM}\s*{UNIT}"
    dash_unit = F.regexp_extract(t, dash, 3)
    dash_mult = F.when(dash_unit == L.UNIT_YEAR, 12.0).otherwise(1.0)
    null = F.lit(None).cast("double")
    lo = (F.when(F.instr(t, L.NEWBORN) > 0, F.lit(0.0))
          .when(t.rlike(under), F.lit(0.0))
          .when(t.rlike(from_to), _months(t, from_to, 1, 2))
          .when(t.rlike(from_), _months(t, from_, 1, 2))
          .when(t.rlike(dash), _num(t, dash, 1) * dash_mult)
          .when(t.rlike(dash_units), _months(t, dash_units, 1, 2))
          .when(t.rlike(single), _months(t, single, 1, 2))
          .otherwise(null))
    hi = (F.when(F.instr(t, L.NEWBORN) > 0, F.lit(2.0))
          .when(t.rlike(under), _months(t, under, 1, 2))
          .when(t.rlike(from_to), _months(t, from_to, 3, 4))
          .when(t.rlike(from_), null)
          .when(t.rlike(dash), _num(t, dash, 2) * dash_mult)
          .when(t.rlike(dash_units), _months(t, dash_units, 3, 4))
          .when(t.rlike(single), _months(t, single, 1, 2))
          .otherwise(null))
    return F.struct(lo.alias("min_age_months"), hi.alias("max_age_months"))


def size_like(label, tokens=L.SIZE_LABEL_TOKENS) -> Column:
    """True when the label contains a size token, case-sensitive.

    NULL labels are not size-like (nothing is dropped for them).
    """
    pattern = "|".join(tokens)
    return F.coalesce(_c(label).rlike(pattern), F.lit(False))


def strict_milk_label(label, strict: bool = True) -> Column:
    """Strict milk label -> struct(min_age_months, range_months).

    "Trẻ sơ sinh" -> (0, 1); "Từ n tuổi" -> (12n, NULL); "a - b U" ->
    (a, b - a) scaled by U.  Integers only, case-sensitive.  Anything else
    raises in strict mode, or gives (NULL, NULL) otherwise so the caller
    can quarantine the row.
    """
    t = _c(label)
    from_ = rf"^Từ (\d+) {L.UNIT_YEAR}"
    rng = rf"^(\d+) - (\d+) {UNIT}"
    mult = F.when(F.regexp_extract(t, rng, 3) == L.UNIT_YEAR, 12).otherwise(1)
    low = F.regexp_extract(t, rng, 1).cast("int") * mult
    high = F.regexp_extract(t, rng, 2).cast("int") * mult
    unknown = (F.raise_error(F.concat(F.lit("unknown milk label: "), F.coalesce(t, F.lit("NULL"))))
               .cast("int") if strict else F.lit(None).cast("int"))
    lo = (F.when(t == L.STRICT_NEWBORN, F.lit(0))
          .when(t.rlike(from_), F.regexp_extract(t, from_, 1).cast("int") * 12)
          .when(t.rlike(rng), low)
          .otherwise(unknown))
    width = (F.when(t == L.STRICT_NEWBORN, F.lit(1))
             .when(t.rlike(from_), F.lit(None).cast("int"))
             .when(t.rlike(rng), high - low)
             .otherwise(F.lit(None).cast("int")))
    return F.struct(lo.alias("min_age_months"), width.alias("range_months"))


KG = r"\s*kg"


def weight_range(label) -> Column:
    """Weight label -> struct(min_kg, max_kg) for the optional second
    interval of the age candidates (R6).  Same rule shapes as the age labels:
    "dưới x kg" -> (0, x); "từ x (kg) đến y kg"; "trên/từ x kg" -> (x, NULL);
    "x - y kg"; "x kg" -> (x, x).  Comma or dot decimals; else (NULL, NULL).
    """
    t = F.lower(strip(_c(label)))
    under = rf"^dưới\s+{NUM}{KG}"
    from_to = rf"^từ\s+{NUM}(?:{KG})?\s+đến\s+{NUM}{KG}"
    above = rf"^(?:từ|trên)\s+{NUM}{KG}"
    dash = rf"^{NUM}(?:{KG})?\s*-\s*{NUM}{KG}"
    single = rf"^{NUM}{KG}"
    null = F.lit(None).cast("double")
    lo = (F.when(t.rlike(under), F.lit(0.0))
          .when(t.rlike(from_to), _num(t, from_to, 1))
          .when(t.rlike(above), _num(t, above, 1))
          .when(t.rlike(dash), _num(t, dash, 1))
          .when(t.rlike(single), _num(t, single, 1))
          .otherwise(null))
    hi = (F.when(t.rlike(under), _num(t, under, 1))
          .when(t.rlike(from_to), _num(t, from_to, 2))
          .when(t.rlike(above), null)
          .when(t.rlike(dash), _num(t, dash, 2))
          .when(t.rlike(single), _num(t, single, 1))
          .otherwise(null))
    return F.struct(lo.alias("min_kg"), hi.alias("max_kg"))
