"""Fixed values.

FIXED VALUES — these must equal the values the original jobs use, so that
results agree.  They are stated plainly, in their natural order.
"""

# Order-line output types kept by the frequency job.
OUTPUT_TYPES = (8, 222, 2163, 2283, 2683, 2884, 3483, 3503, 3625)

# Product status ids that count as on sale.
ACTIVE_STATUS_IDS = (4, 5)

# Property ids holding an age label (the distinct-label view).
AGE_LABEL_PROPERTIES = ("age_range_filter_multi", "recommended_age_usp", "age_usp",
                        "recommended_age", "age_range", "children_clothing_size")

# Property ids kept for the age job (adds the two weight properties).
AGE_JOB_PROPERTIES = ("age_range_filter_multi", "recommended_age_usp", "age_usp",
                      "recommended_age", "age_range", "weight_filter", "weight_usp",
                      "children_clothing_size")

# Category codes kept for the age job.
AGE_JOB_CATEGORIES = (114, 112, 209, 189, 271, 272, 270, 122, 123, 110, 108, 107, 121, 120,
                      124, 125, 126, 127, 106, 105, 113, 109, 116, 102, 103, 111, 279, 273,
                      274, 275, 276, 277, 278, 281, 284, 283, 232, 264, 263, 194, 200, 201,
                      254, 150, 13, 176, 208, 289, 290, 294, 299, 306, 307, 364, 59, 3, 353,
                      236, 237, 238, 239, 240, 241, 242, 243, 206, 193, 18, 38, 33, 28, 24,
                      268, 296, 300, 302, 303, 308)

# Size-like label parts: a label containing any of them (case-sensitive,
# anywhere) is not an age label.
SIZE_LABEL_TOKENS = ("L", "M", "S", "XS", "Freesize")

# Diaper sizes from smallest to largest; rung = position + 1.
DIAPER_SIZE_ORDER = ("NB", "XS", "S", "M", "L", "XL", "XXL", "XXXL")

# Category codes of the upsize job: diapers and milk.
DIAPER_CATEGORY = "36"
MILK_CATEGORY = "99"

# Placeholder value meaning "not filled in yet".
PLACEHOLDER_VALUE = "Đang cập nhật"

# Age-label words: newborn, under, from, to, month, year.
NEWBORN = "trẻ sơ sinh"
UNIT_MONTH = "tháng"
UNIT_YEAR = "tuổi"

# Strict milk labels.
STRICT_NEWBORN = "Trẻ sơ sinh"

# Source priority of the blended list, first wins on a tie.
SOURCE_PRIORITY = ("ori", "rcm", "age_rcm", "freg_rcm")

# Numeric defaults.
CYCLE_MIN_SCORE = 0.5
AGE_POOL_K = 20
AGE_FINAL_K = 15
MAX_PER_BASE_ITEM = 2
BLEND_CAP = 30
SIMILAR_TOP_N = 10
MAX_SIMILAR_CANDIDATES = 1000
MAX_PROPS_PER_PROFILE = 20
FUZZY_CUTOFF = 89
AGE_BATCH_SIZE = 500
SIMILAR_BATCH_SIZE = 100
COMPANION_OUTPUT_FILES = 48
ATTRIBUTE_TOP_K = 5

# Growth sheet headers (age months, weight kg, weight lb, height inch, height
# cm) and the column names used here.
GROWTH_SHEET_COLUMNS = {
    "Tuổi (tháng)": "age_months",
    "Cân nặng (kg)": "weight_kg",
    "Cân nặng (lb)": "weight_lb",
    "Chiều cao (inch)": "height_inch",
    "Chiều cao (cm)": "height_cm",
}
