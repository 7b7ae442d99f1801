"""Fixed values as the checks' SQL has them: written down a second time, apart from the recipes'
constants, so that a slip in one of the two shows."""

FAMILY_CELLS = {
    "no_children_u24": ("CH0_Y_LT25", "_T"),
    "one_child_u24": ("CH1_Y_LT25", "_T"),
    "two_children_u24": ("CH2_Y_LT25", "_T"),
    "three_children_u24": ("CH3_Y_LT25", "_T"),
    "four_or_more_children_u24": ("CH_GE4_Y_LT25", "_T"),
    "number_single_father_families": ("_T", "11"),
    "number_single_mother_families": ("_T", "12"),
    "number_traditional_families": ("_T", "223"),
    "number_couples_no_children_home": ("_T", "21"),
    "number_couples_children_home": ("_T", "22"),
}

MIGRATION_CELLS = {
    "number_french": ("2", None),
    "number_migrant": ("1", None),
    "number_migrant_male": ("1", "1"),
    "number_migrant_female": ("1", "2"),
    "number_french_male": ("2", "1"),
    "number_french_female": ("2", "2"),
    "number_male": (None, "1"),
    "number_female": (None, "2"),
    "number_total": (None, None),
}

BADGES = [
    ("10 communes visited", "n_visited", 10),
    ("100 communes visited", "n_visited", 100),
    ("1 000 communes visited", "n_visited", 1_000),
    ("10 000 communes visited", "n_visited", 10_000),
    ("department(s) completed", "departments_completed", 1),
    ("region(s) completed", "regions_completed", 1),
    ("5 departments visited", "n_departments", 5),
    ("10 departments visited", "n_departments", 10),
    ("20 departments visited", "n_departments", 20),
    ("Mountain commune visited", "mountain_visited", 1),
    ("Island commune visited", "island_visited", 1),
    ("100k population visited", "population_visited", 100_000),
    ("1M population visited", "population_visited", 1_000_000),
    ("10M population visited", "population_visited", 10_000_000),
    ("Overseas commune visited", "overseas_visited", 1),
    ("Paris visited", "paris_visited", 1),
]

NAME_QUALIFIERS = {
    "sur": "situated on (river/hill)",
    "sous": "under/below",
    "en": "in",
    "les": "the (plural)",
    "le": "the (masculine)",
    "la": "the (feminine)",
    "près": "near",
    "devant": "in front of",
    "derrière": "behind",
    "entre": "between",
}
