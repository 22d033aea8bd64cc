"""Domain vocabularies.

FIXED VALUES: the entries below must equal the studied pipeline's values for
its results to be reproduced. They are stated as plain data, in natural order.
"""

# FIXED VALUES — level harmonisation rules (column, from, to), applied in order.
HARMONISE_RULES = [
    ("abdominal_distention", "None", "none"),
    ("nasogastric_tube", "None", "none"),
    ("nasogastric_reflux", "None", "none"),
    ("temp_of_extremities", "None", "normal"),
    ("peripheral_pulse", "None", "normal"),
    ("mucous_membrane", "None", "normal_pink"),
    ("capillary_refill_time", "None", "less_3_sec"),
    ("capillary_refill_time", "3", "less_3_sec"),
    ("pain", "None", "alert"),
    ("pain", "moderate", "mild_pain"),
    ("pain", "slight", "moderate"),
    ("peristalsis", "distend_small", "normal"),
    ("peristalsis", "None", "normal"),
    ("nasogastric_reflux", "slight", "none"),
    ("rectal_exam_feces", "None", "normal"),
    ("rectal_exam_feces", "serosanguious", "normal"),
    ("abdomen", "None", "normal"),
    ("abdomo_appearance", "None", "clear"),
]

# FIXED VALUES — integer codes of category levels; unmapped levels become null.
LEVEL_CODES = {
    "surgery": {"no": 0, "yes": 1},
    "age": {"young": 0, "adult": 1},
    "temp_of_extremities": {"cold": 0, "cool": 1, "normal": 2, "warm": 3},
    "peripheral_pulse": {"absent": 0, "reduced": 1, "normal": 2, "increased": 3},
    "mucous_membrane": {"normal_pink": 0, "bright_pink": 1, "pale_pink": 2,
                        "pale_cyanotic": 3, "bright_red": 4, "dark_cyanotic": 5},
    "capillary_refill_time": {"less_3_sec": 0, "more_3_sec": 1},
    "pain": {"alert": 0, "depressed": 1, "moderate": 2, "mild_pain": 3,
             "severe_pain": 4, "extreme_pain": 5},
    "peristalsis": {"hypermotile": 0, "normal": 1, "hypomotile": 2, "absent": 3},
    "abdominal_distention": {"none": 0, "slight": 1, "moderate": 2, "severe": 3},
    "nasogastric_tube": {"none": 0, "slight": 1, "significant": 2},
    "nasogastric_reflux": {"none": 0, "less_1_liter": 1, "more_1_liter": 2},
    "rectal_exam_feces": {"absent": 0, "decreased": 1, "normal": 2, "increased": 3},
    "abdomen": {"normal": 0, "other": 1, "firm": 2, "distend_small": 3,
                "distend_large": 4},
    "abdomo_appearance": {"clear": 0, "cloudy": 1, "serosanguious": 2},
    "surgical_lesion": {"no": 0, "yes": 1},
}

# FIXED VALUES — outcome label codes, and the label order used for factors.
OUTCOME_CODES = {"died": 2, "euthanized": 1, "lived": 0}
OUTCOME_LEVELS = ["died", "euthanized", "lived"]

# FIXED VALUES — lesion digit labels (spelling as in the studied pipeline).
LESION_SITE_LABELS = {
    11: "all intestinal sites", 1: "gastric", 2: "sm intestine", 3: "lg colon",
    4: "lg colon and cecum", 5: "cecum", 6: "transverse colon",
    7: "retum/descending colon", 8: "uterus", 9: "bladder", 0: "none",
}
LESION_TYPE_LABELS = {
    1: "simple", 2: "strangulation", 3: "inflammation", 4: "other", 5: "other",
    6: "other", 7: "other", 8: "other", 9: "other", 0: "other",
}
LESION_SUBTYPE_LABELS = {1: "mechanical", 2: "paralytic"}
LESION_SUBTYPE_DEFAULT = "n/a"
LESION_CODE_LABELS = {
    10: "displacement", 1: "obturation", 2: "intrinsic", 3: "extrinsic",
    4: "adynamic", 5: "volvulus/torsion", 6: "intussuption",
    7: "thromboembolic", 8: "hernia", 9: "lipoma/slenic incarceration", 0: "n/a",
}
LESION_LABEL_MISSING = "n/a"

# FIXED VALUES — the four right-skewed clinical columns.
SKEWED_COLUMNS = ["abdomo_protein", "pulse", "respiratory_rate", "total_protein"]


def collapse_rules(rules, column):
    """Fold an ordered list of exact-match rules for one column into one map.

    Each source value is followed through the rules that come after the one
    that rewrote it, so applying the map once equals applying the rules in
    sequence once.
    """
    col_rules = [(src, dst) for c, src, dst in rules if c == column]
    sources = []
    for src, _ in col_rules:
        if src not in sources:
            sources.append(src)
    mapping = {}
    for value in sources:
        cur = value
        for src, dst in col_rules:
            if cur == src:
                cur = dst
        if cur != value:
            mapping[value] = cur
    return mapping
