"""Fixed values of the curation domain: they must be these for right results."""

from __future__ import annotations

# Licences, regions (longitude and latitude bounds), taxon roots.
ALLOWED_LICENSES = ("CC0", "CC-BY", "CC-BY-NC")
REGION = {"longitude": (-32.0, 45.0), "latitude": (34.0, 73.0)}
PRIORITY_REGION = {"longitude": (14.05, 24.25), "latitude": (49.0, 55.05)}
REGION_BOXES = (
    {"longitude": (-25.0, 45.0), "latitude": (34.0, 72.0)},
    {"longitude": (-31.5, -13.0), "latitude": (63.0, 67.5)},
    {"longitude": (-11.0, 5.0), "latitude": (35.0, 44.5)},
)
KINGDOM_ROOTS = (("fungi", "47170"), ("plants", "47126"))
QUALITY_GRADES = ("research", "research grade", "needs_id", "needs id", "verifiable")

# Labels.
UNKNOWN = "unknown"
UNKNOWN_PLANT, UNKNOWN_FUNGUS, UNKNOWN_OTHER = "UNK_NON_TARGET_PLANT", "UNK_NON_TARGET_FUNGUS", "UNK_OTHER_OR_AMBIGUOUS"
INTERNAL_UNKNOWN = (UNKNOWN_PLANT, UNKNOWN_FUNGUS, UNKNOWN_OTHER)
UNKNOWN_ENTRY = ("unknown", "unknown", "unknown", "nieznane", "unknown")
INTERNAL_ENTRIES = (
    (UNKNOWN_PLANT, "plants", "unknown_non_target_plant", "nieznana roslina spoza taksonomii", "unknown non-target plant"),
    (UNKNOWN_FUNGUS, "fungi", "unknown_non_target_fungus", "nieznany grzyb spoza taksonomii", "unknown non-target fungus"),
    (UNKNOWN_OTHER, "unknown", "unknown_other_or_ambiguous", "inne lub niejednoznaczne", "other or ambiguous"),
)
HARD_NEGATIVES = ("FUN_01", "FUN_02", "FUN_07", "FUN_08", "FUN_09", "FUN_10", "FUN_18", "FUN_19", "PLANT_01", "PLANT_02", "PLANT_17", "PLANT_18")
ALIASES = {"Anemone nemorosa": ("Anemonoides nemorosa",)}
MANIFEST_SIZE = 40

# Default amounts.
KNOWN_QUOTAS = {"train": 300, "val": 50, "test": 50, "dev": 10}
UNKNOWN_QUOTAS = {"train": 2000, "val": 400, "test": 400, "dev": 10}
EXTRA_HARD_NEGATIVES, SEED = 60, 23
POOL_PER_LABEL, UNKNOWN_POOL, PER_OBSERVER = 450, 3200, 2
KNOWN_CAPS, UNKNOWN_CAPS = (1500, 2500), (12000, 30000)

# Addresses of photos.
PHOTO_URL = "https://inaturalist-open-data.s3.amazonaws.com/photos/{id}/large.{ext}"
PHOTO_PAGE = "https://www.inaturalist.org/photos/{id}"
PHOTO_SIZES = ("square", "small", "medium", "original")
FALLBACK_SIZES = ("large", "original", "medium", "small", "square")

# Substrings of file names in order of preference.
QUANTISATIONS = ("q3_k_s", "q3_k_m", "q2_k", "iq3", "iq2", "q4_k_m", "q4_k_s")

# Prompts.
LEGACY_SYSTEM = "You identify one forest organism from a fixed taxonomy and answer in JSON only."
LEGACY_USER = "<image>Identify the organism. If it is not in the supported taxonomy or the image is ambiguous, return unknown."
CLASSIFY = "You classify exactly one forest organism from a fixed taxonomy."
JSON_ONLY = "Return JSON only with the single key label_id."
NO_INVENTION = "Do not invent labels, synonyms, or alternate JSON keys."
CHOOSE = "Choose exactly one allowed label_id from the list below."
OUTPUTS = {True: "Allowed outputs are the known label_ids and the internal UNK_* fallback labels only.", False: "Allowed outputs are the known label_ids and the public unknown fallback label only."}
FALLBACK = {True: "If the organism is outside the supported taxonomy or the image is ambiguous, choose the best matching UNK_* label.", False: "If the organism is outside the supported taxonomy or the image is ambiguous, choose unknown."}
LAST_LINE = {True: "- unknown = fallback public label after collapsing any UNK_* prediction", False: "- unknown = fallback label for any unsupported or ambiguous image"}
INTERNAL_NOTE = " (collapse to public unknown outside training)"
USER = "<image>Classify the organism using the fixed taxonomy. Return JSON only. "
USER_FALLBACK = {True: "If no known label fits, return the best matching UNK_* label.", False: "If no known label fits, return unknown."}
NO_THINKING = "Do not output thinking, explanations, markdown, or <think> blocks."
MOBILE_SYSTEM = 'You identify one forest organism from an image. Do not think step by step. Do not output <think>. Return JSON only as {"label_id":"<id>"}. Allowed label_id values: '
MOBILE_USER = '<image>Classify the forest organism. If uncertain or out of taxonomy, return {"label_id":"unknown"}.'
UNKNOWN_TAXON_LINE = "unknown: organism spoza listy albo obraz niejednoznaczny"
NO_DESCRIPTION = "Brak opisu z Wikipedii dla {name}."
