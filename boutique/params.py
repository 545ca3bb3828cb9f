"""Parameters of the retail preference pipeline.

Everything a caller may want to change lives here as a plain constant and
is passed into the operators explicitly; operators never read this module
behind the caller's back except for their defaults.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values that must equal the surveyed pipeline's for the same results.
# Stated plainly, in the order the surveyed code lists them.
# ---------------------------------------------------------------------------

# Article attributes that are one-hot encoded, in encoding order.
ARTICLE_ATTRIBUTES = [
    "product_type_no",
    "graphical_appearance_no",
    "colour_group_code",
    "product_group_name",
    "perceived_colour_master_id",
    "department_no",
    "section_no",
    "garment_group_no",
]

# Customer categoricals that are one-hot encoded, in encoding order.
CUSTOMER_ATTRIBUTES = ["fashion_news_frequency", "club_member_status"]

# Newsletter cleaning: substring replacements applied in this order, then
# the null fill.
NEWS_REPLACEMENTS = [("None", "NONE"), ("Monthly", "Regularly")]
NEWS_NULL_FILL = "NONE"

# Product groups merged into one group called "Items" in the original data.
ITEMS_GROUPS_ORIGINAL = [
    "Garment and Shoe care",
    "Furniture",
    "Stationery",
    "Interior textile",
    "Fun",
]
ITEMS_LABEL = "Items"

# Gender flags: (index_group_no values, section_no value) per flag.
FEMALE_INDEX_GROUPS = [1, 2]
FEMALE_SECTION = 5
MALE_INDEX_GROUPS = [3]
MALE_SECTION = 22
CHILDREN_INDEX_GROUPS = [4]
CHILDREN_SECTION = 29

# Segment threshold on the gender shares (strict comparisons on both sides).
SEGMENT_THRESHOLD = 0.75

# Section lists used to subset articles.
MALE_SECTIONS = [26, 22, 31, 55, 21, 25, 23, 27, 20, 56, 29, 30, 24, 28]
FEMALE_SECTIONS = [16, 61, 62, 8, 66, 51, 65, 52, 60, 58, 15, 53, 57, 18, 64,
                   11, 50, 19, 6, 80, 14, 82, 97, 70, 71, 4, 17]

# Age handling: shift, then 86 categories for the model.
AGE_SHIFT = 16
AGE_CATEGORIES = 86

# Integer scaling of preference shares.
INT_SCALE = 10000

# Clustering: sample size of one sweep and the k grids (start, stop, step).
CLUSTER_SAMPLE = 20000
KGRID_MALE = (30, 130, 3)
KGRID_FEMALE = (75, 250, 3)
KGRID_FAMILY = (100, 600, 1)
KGRID_ALL = (200, 550, 5)

# Model widths.
PREFERENCE_WIDTH = 620
# Rank of the surveyed network's linear map, its bias apart: the age embedding's
# width and the two input widths.
PREFERENCE_RANK = 16 + 7 + 4
# Share of the smallest penalty that zeroes every coefficient of a target.
L1_STRENGTH = 0.1

# Model input columns.
INFO_COLS = ["FN", "fashion_news_frequency_Regularly", "club_member_status_LEFT CLUB",
             "club_member_status_PRE-CREATE", "female", "male", "children"]
CLUSTER_COLS = ["full_order", "mens_order", "womens_order", "fam_order"]

# ---------------------------------------------------------------------------
# Parameters for the driver's test tables (stand-ins for the original dates
# and group names, chosen to fall inside the generated date range).
# ---------------------------------------------------------------------------

LIVE_CUTOFF = "2001-04-12"     # live articles: last sale on/after this
SPLIT_CUTOFF = "2001-06-07"    # train/test split on last sale
TEST_CUTOFF = "2001-07-10"     # test articles / test purchases from this
ITEMS_GROUPS = ["ECONOMY", "PROMO"]

TOPK = 10
SEED = 42


# Cutoffs of the surveyed code for the original retail data.
ORIGINAL_LIVE_CUTOFF = "2020-08-27"
ORIGINAL_SPLIT_CUTOFF = "2019-09-01"
ORIGINAL_TEST_CUTOFF = "2020-09-06"


def original_settings() -> None:
    """Switch the date and group parameters to the surveyed values, for runs
    on the original CSV files: every transaction counts towards shares and
    preferences, and the five original product groups merge into Items."""
    global LIVE_CUTOFF, SPLIT_CUTOFF, TEST_CUTOFF, ITEMS_GROUPS
    LIVE_CUTOFF = ORIGINAL_LIVE_CUTOFF
    SPLIT_CUTOFF = ORIGINAL_SPLIT_CUTOFF
    TEST_CUTOFF = ORIGINAL_TEST_CUTOFF
    ITEMS_GROUPS = list(ITEMS_GROUPS_ORIGINAL)
