"""Fixed parameters of the catalog queries (shared by Spark and oracle)."""

TOP_N = 10
STAT_CLIENT = "8"
RANGE_START = "2024-01-10"
RANGE_END = "2024-01-20"
FILTER_CATEGORY = "STANDARD"
FILTER_SELLER = "3"
LOOKUP_SELLER = "7"
ALL_FILTERS_CLIENT = "8"
ALL_FILTERS_PRODUCT = "24"
ALL_FILTERS_START = "2024-01-01"
ALL_FILTERS_END = "2024-01-31"
LOAD_DATE = "2024-06-01"
