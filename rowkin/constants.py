"""Word lists, patterns and limits that results depend on, plainly stated."""

from __future__ import annotations

# Fixed values. Abbreviations of names and addresses.
ABBREVIATIONS = {
    "pvt": "private",
    "ltd": "limited",
    "inc": "incorporated",
    "corp": "corporation",
    "co": "company",
    "intl": "international",
    "mfg": "manufacturing",
    "svcs": "services",
    "mgmt": "management",
    "rd": "road",
    "ave": "avenue",
    "blvd": "boulevard",
    "hwy": "highway",
    "ste": "suite",
}

# Fixed values. Words that say nothing but a legal form.
LEGAL_WORDS = ["private", "limited", "incorporated", "corporation", "company", "llc", "llp", "pte", "pvt", "ltd", "inc", "corp", "co", "sa", "sas", "sarl", "eurl", "and", "the"]

# Fixed value. A web address, of which the first group stays.
WEB_ADDRESS = r"(?:https?://)?(?:www\.)?([a-z0-9-]+)\.(?:com|net|org|in|fr|co)(?:\.[a-z]+)?(?:/\S*)?"

# Fixed values. Most records a key of each family may have.
KEY_CAPS = {"n": 150, "c": 150, "s": 150, "a": 100, "p": 60, "q": 40, "t": 45, "w": 35, "h": 100, "d": 45, "b": 15, "e": 35, "j": 100, "k": 75, "m": 150, "f": 80, "v": 60, "x": 60}

# Fixed values. Names and order of the model's columns.
FIELD_SCORES = ["ratio", "sort", "set", "partial", "jw", "jaccard", "contain", "length_ratio", "exact", "missing"]
PAIR_COLUMNS = [
    "number_jaccard", "number_conflict", "number_common", "number_missing", "first_number_equal", "name_number_conflict",
    "name_length", "address_length", "source3", "name_addr_product", "compact_name_ratio", "compact_name_partial",
]
REFERENCE_COLUMNS = ["reference_name_frequency", "reference_core_frequency", "reference_address_frequency"]
SOURCE_COLUMNS = ["source_core_frequency", "source_core_address_frequency"]
EXTRA_COLUMNS = [
    "unmatched_left_numbers", "unmatched_right_numbers", "number_delta_log", "number_near_miss", "unmatched_number_similarity",
    "name_substitution_rate", "name_insertion_rate", "name_deletion_rate", "worst_name_token_similarity", "mean_name_token_similarity",
]
SCREEN_COLUMNS = [
    "name_ratio", "core_ratio", "core_sort", "core_set", "address_ratio", "address_sort", "address_set", "core_missing", "address_missing",
    *REFERENCE_COLUMNS, *SOURCE_COLUMNS,
]
BASE_COLUMNS = [f"{field}_{score}" for field in ("name", "core", "address") for score in FIELD_SCORES] + PAIR_COLUMNS
MODEL_COLUMNS = BASE_COLUMNS + REFERENCE_COLUMNS + SOURCE_COLUMNS + EXTRA_COLUMNS

# Fixed values. Thresholds that are searched, and screening cutoffs besides the initial one.
THRESHOLDS = [round(i / 100, 2) for i in range(1, 100)] + [0.995, 0.999, 0.9995]
SCREEN_CUTOFFS = [0.0003, 0.001, 0.003, 0.01, 0.03, 0.05, 0.1, 0.2, 0.3, 0.4, 0.5]
