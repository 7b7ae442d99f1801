"""Fixed values of the published tables."""

# Sub-district codes folded into their city.
CITY_CODES = [
    ("^751[0-9]{2}$", "75056"),
    ("^6938[0-9]$", "69123"),
    ("^132[0-9]{2}$", "13055"),
]

# Postal code ranges of the three cities with their own districts.
CITY_ZIP_RANGES = [
    (75000, 75999, "75056"),
    (13000, 13020, "13055"),
    (69001, 69010, "69123"),
]

CORSICA = ["2A", "2B"]

# Departments that are islands as a whole.
INSULAR_DEPARTMENTS = [
    "2A", "2B", "971", "972", "974", "975", "976", "977", "978",
    "981", "984", "986", "987", "988", "989",
]

# Island communes by island.
ISLANDS = {
    "Île de Ré": [
        "17019", "17051", "17121", "17161", "17207", "17286", "17297", "17318", "17369", "17360",
    ],
    "Île d'Oléron": ["17486", "17093", "17140", "17485", "17323", "17337", "17385", "17411"],
    "Belle-Île": ["56009", "56114", "56152", "56241"],
    "Noirmoutier": ["85011", "85083", "85106", "85163"],
    "Îles du Ponant": [
        "17004", "56088", "29082", "22016", "56069", "56085", "56086", "56087", "29084",
        "29155", "29083", "85113",
    ],
}

# Monument domains behind each count.
MONUMENT_DOMAINS = {
    "religious_count": ["architecture religieuse"],
    "domestic_count": ["architecture domestique"],
    "administrative_count": ["architecture administrative"],
    "military_count": ["architecture militaire"],
    "funerary_count": ["architecture funéraire et commémorative", "architecture funéraire"],
    "civil_engineering_count": ["génie civil"],
    "industrial_count": ["industrie et artisanat", "industrie"],
    "agricultural_count": ["architecture agricole"],
    "educational_count": ["architecture scolaire et éducative"],
}

# Fixed values: (children, family type) behind each family count; _T is the total.
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

# Fixed values: (immigration, sex) behind each migration count; None takes all.
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
MIGRATION_YEAR = 2022

# Occupation codes and sexes of the salary measures.
OCCUPATIONS = {
    "management_position": "1T3",
    "intermediate_position": "4",
    "service_workers": "5",
    "manual_workers": "6",
}
SEXES = {"": "_T", "_men": "M", "_women": "F"}

# Age bands and sexes of the labour tables.
AGE_BANDS = {"15_64": "1564", "15_24": "1524", "25_54": "2554", "55_64": "5564"}
LABOUR_SEXES = {"total": "", "men": "H", "women": "F"}

# The common income measures.
INCOME_MEASURES = [
    "nb_tax_households", "nb_persons", "median_income", "poverty_rate", "decile1", "decile9",
    "gini", "s80_s20", "activity_income_share", "salary_share", "unemployment_share",
    "pension_share", "property_income_share", "social_benefits_share", "family_benefits_share",
    "minimum_social_share", "housing_benefits_share", "tax_share",
]

# Measure codes of the long income format.
LONG_INCOME = {
    "MED_SL": "median_income",
    "PR_MD60": "poverty_rate",
    "D1_SL": "decile1",
    "D9_SL": "decile9",
    "GI_SL": "gini",
    "S80S20_SL": "s80_s20",
    "S_EI_DI": "activity_income_share",
    "S_EI_DI_SAL": "salary_share",
    "S_EI_DI_UNE": "unemployment_share",
    "S_RET_PEN_DI": "pension_share",
    "S_INC_ASS_DI": "property_income_share",
    "S_SOC_BEN_DI": "social_benefits_share",
    "S_SOC_BEN_DI_FAM_BEN": "family_benefits_share",
    "S_SOC_BEN_DI_MIN_SOC": "minimum_social_share",
    "S_SOC_BEN_DI_HOU_BEN": "housing_benefits_share",
    "S_DIR_TAX_DI": "tax_share",
}

# Stem of each income measure in the yearly wide files (two-digit year appended).
INCOME_STEMS = {
    "nb_tax_households": "NBMEN",
    "nb_persons": "NBPERS",
    "median_income": "Q2",
    "decile1": "D1",
    "decile9": "D9",
    "gini": "GI",
    "s80_s20": "S80S20",
    "activity_income_share": "PACT",
    "salary_share": "PTSA",
    "unemployment_share": "PCHO",
    "pension_share": "PPEN",
    "property_income_share": "PPAT",
    "social_benefits_share": "PPSOC",
    "family_benefits_share": "PPFAM",
    "minimum_social_share": "PPMINI",
    "housing_benefits_share": "PPLOGT",
    "tax_share": "PIMPOT",
}

# Years whose files name a measure differently; None means it is not delivered.
INCOME_EXCEPTIONS = {
    2013: {
        "activity_income_share": "PTSAC", "salary_share": "PTSAC", "unemployment_share": None,
    },
    2014: {
        "nb_tax_households": "NBMENFISC", "nb_persons": "NBPERSMENFISC", "median_income": "MED",
        "poverty_rate": "TP60", "gini": None, "s80_s20": None, "activity_income_share": "PRA",
        "salary_share": "PTSAC", "unemployment_share": None,
    },
    2017: {
        "nb_tax_households": "NBMENFISC", "nb_persons": "NBPERSMENFISC", "median_income": "MED",
        "poverty_rate": "TP60", "gini": None, "s80_s20": None,
    },
}
POVERTY_STEM = "TP60"
# Years that deliver no income composition beyond the activity share.
LIMITED_INCOME_YEARS = [2020, 2021]

# Visit-time model.
VISIT_MINUTES = [(500, 10), (2000, 20), (10000, 45), (50000, 120), (100000, 240)]
VISIT_MINUTES_LARGEST = 480
VISIT_MINUTES_UNKNOWN = 10
MONUMENT_FLOOR = 5
MONUMENT_BONUS = 3
MONUMENT_CAP = 60
MOUNTAIN_FACTOR = 1.3
COAST_FACTOR = 1.15
ISLAND_FACTOR = 1.5
SINGLE_ISLAND_MINUTES = 300
SHARED_ISLAND_MINUTES = 75
MINUTES_PER_DAY = 480
DENSE_DRIVE_MINUTES = 8
RURAL_DRIVE_MINUTES = 15
DENSE_DEPARTMENTS = ["75", "92", "93", "94", "69", "13", "59"]
DEPARTMENT_DRIVE_HOURS = 1.5
HOURS_PER_DAY = 10
# Overseas trips (department, days, shared trip).
OVERSEAS_TRIPS = [
    ("971", 4, "Antilles"),
    ("972", 4, "Antilles"),
    ("977", 4, "Antilles"),
    ("978", 4, "Antilles"),
    ("973", 4, "Guyane"),
    ("974", 4, "Océan Indien"),
    ("976", 4, "Océan Indien"),
    ("975", 4, "Saint-Pierre-et-Miquelon"),
    ("987", 4, "Polynésie française"),
    ("988", 4, "Nouvelle-Calédonie"),
    ("986", 4, "Wallis-et-Futuna"),
    ("2A", 1, "Corse"),
    ("2B", 1, "Corse"),
]

# Badge thresholds (label, metric, minimum).
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

# Qualifiers counted in names, with their meaning.
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

# Which sources feed which table, by its key columns.
TABLE_SOURCES = {
    "fact_population": (
        ("id", "year"), ["historical_population", "family", "migration", "births", "deaths"],
    ),
    "fact_salaries": (("id", "year"), ["salaries"]),
    "fact_equipment": (("commune_id", "year", "equipment_type_id"), ["bpe"]),
    "dim_communes": (("id",), ["cog_ensemble"]),
    "dim_geography": (("commune_id",), ["french_communes"]),
    "dim_zip_codes": (("id",), ["zip_codes"]),
    "dim_equipment": (("equipment_type_id",), ["dim_equipment"]),
    "bridge_communes_zip_codes": (("commune_id", "zip_code_id"), ["zip_codes"]),
    "dim_neighbour_communes": (("parcel_id", "neighbor_id"), ["french_communes"]),
    "dim_criminality_indicateur": (("indicateur_id",), ["criminality"]),
    "fact_criminality": (("commune_id", "annee", "indicateur_id"), ["criminality"]),
}
# Label types, each named like its source.
LABEL_TYPES = [
    "petites_cites", "villes_fleuries", "plus_beaux_villages", "villes_prudentes",
    "village_etape", "famille_plus", "ville_sportive",
]

# Function words left out of word counts.
STOPWORDS = [
    "le", "la", "les", "un", "une", "des", "du", "de", "d'", "l'",
    "et", "ou", "mais", "donc", "or", "ni", "car",
    "sur", "sous", "dans", "avec", "sans", "par", "pour", "en", "vers", "entre",
    "au", "aux", "chez", "après", "avant", "pendant", "depuis", "jusque",
    "ce", "ces", "cet", "cette", "mon", "ton", "son", "notre", "votre", "leur",
    "a", "à", "est", "sont", "était", "étaient", "être", "avoir", "ont",
    "faire", "fait", "parce", "que", "qui", "qu'", "dont", "où", "quoi",
    "je", "tu", "il", "elle", "nous", "vous", "ils", "elles",
    "me", "te", "se", "y", "lui",
]
