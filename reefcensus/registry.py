"""Fixed values of the field-survey data model.

Everything in this module is data, not logic: project families, sheet-name
patterns, block coordinates, output layouts and small literal dimensions.
Operators read these values; nothing here touches Spark.
"""

from __future__ import annotations

# --------------------------------------------------------------------------
# FIXED VALUES: must equal the survey protocol's own values for right results.
# --------------------------------------------------------------------------

# Project family -> Project values.
PROJECT_FAMILIES: dict[str, list[str]] = {
    "Mediterranean Transects": ["Bioblitz", "ASSEMBLE"],
    "Eilat Transects": ["FunDiversity"],
    "Eilat Knolls": ["EcoCamp"],
    "Tel Aviv Transects": ["TLV"],
    "Eilat Juveniles Transects": ["Juveniles"],
    "Eilat Juveniles Knolls": ["Juveniles Knolls"],
    "Eilat Juveniles Artificial": ["Juveniles Artificial"],
}

JUVENILE_FAMILIES = (
    "Eilat Juveniles Transects",
    "Eilat Juveniles Knolls",
    "Eilat Juveniles Artificial",
)

# Family -> deployment id column on the metadata side, and the id field name
# inside the worksheet metadata block.
FAMILY_DEPLOYMENT_COLUMN = {
    "Mediterranean Transects": "SiteID",
    "Eilat Transects": "SiteID",
    "Eilat Knolls": "KnollID",
    "Tel Aviv Transects": "Spot",
    "Eilat Juveniles Transects": "SiteID",
    "Eilat Juveniles Knolls": "KnollID",
    "Eilat Juveniles Artificial": "SiteID",
}
FAMILY_SHEET_ID_FIELD = {
    "Mediterranean Transects": "Site",
    "Eilat Transects": "Site",
    "Eilat Knolls": "Knoll",
    "Tel Aviv Transects": "Site",
    "Eilat Juveniles Transects": "Site",
    "Eilat Juveniles Knolls": "Knoll",
    "Eilat Juveniles Artificial": "Site",
}

# Families that get a photo-folder tree (pair / deployment / A-D).
PHOTO_FAMILIES = (
    "Mediterranean Transects",
    "Eilat Transects",
    "Eilat Juveniles Transects",
)
PHOTO_LETTERS = ["A", "B", "C", "D"]
PHOTO_FOLDER = "Photos"

# Deployment CSV heading renames (old -> new) and dropped columns.
HEADING_RENAMES = {
    "Fish Observer": "First Observer",
    "Invertebrate Observer": "Second Observer",
    "Site": "SiteID",
    "Knoll": "KnollID",
}
HEADING_DROPS = ["Dive"]
DEFAULT_COUNTRY = "Israel"

OBSERVER_COLUMNS = ["First Observer", "Second Observer"]
JUVENILE_OBSERVER_COLUMNS = ["Juveniles First Observer", "Juveniles Second Observer"]

# Cleaned deployment schema (after scan, heading renames, fill-down, dates).
DEPLOYMENT_COLUMNS = [
    "Country", "Project", "Expedition", "Location", "Date", "SiteID", "KnollID",
    "Spot", "Lat", "Lon", "First Observer", "Second Observer",
    "Juveniles First Observer", "Juveniles Second Observer",
]

# Columns without which a file is no deployment plan.
PLAN_REQUIRED = ["First Observer", "Second Observer", "Date"]

# Layer letter from sheet name: first matching pattern wins.
LAYER_LETTER_PATTERNS = [("TRANSIENTS", "T"), ("CRYPTIC", "C"), ("Juveniles", "J")]
LAYER_LETTER_FAMILIES = ("Eilat Transects", "Eilat Juveniles Transects")

# A sheet that lists the tabs of its spreadsheet in their order, one a row.
SHEET_ORDER_SHEET = "sheet order"

# Older layout: group flag from sheet name.
GROUP_FLAG_TOKEN = "Fish"
GROUP_FLAG_MATCH = "Fish"
GROUP_FLAG_OTHER = "Invertebrates"

# Source (folder entry) names skipped when no explicit list is given.
SKIPPED_SOURCE_NAMES = ["Metadata", "Photos", "COMPLETE DATA"]
SKIPPED_DAY_FOLDER_NAMES = ["EXPEDITION DATA"]

# Worksheet pruning patterns (regex, matched anywhere in the sheet name).
FISH_SHEET_EXCLUDE = "Invertebrates|Species List|Readme.txt|Quadrate data"
INVERTEBRATE_SHEET_EXCLUDE = "Fish|Species List|Readme.txt|Quadrate data"
OLDER_SHEET_EXCLUDE = "Species List|Readme.txt|Quadrate data"
OLDER_QUADRAT_SHEET = "Quadrate data"

# Observation filters: every one of these that exists must be present.
OBSERVATION_REQUIRED = ["Observer", "Species", "Amount", "Length"]
TLV_OBSERVATION_REQUIRED = ["Species", "Amount", "Length", "Distance"]
OLDER_TLV_OBSERVATION_REQUIRED = [
    "Invertebrate|Taxon", "Abundance", "Species", "Amount", "Length", "Distance",
]
# Deployment form: a row is kept when any of these is present.
DEPLOYMENT_ANY_PRESENT = ["Site", "SiteID", "Knoll", "Spot"]

# Metadata columns forced numeric when a sheet leaves them all blank.
NUMERIC_WHEN_BLANK = ("Depth", "Visib")

# Older layout grouped fill: keys and filled columns.
OLDER_FILL_KEYS = ["Site", "Transect"]
OLDER_FILL_COLUMNS = ["Time Start", "Time End", "Depth Start", "Depth End"]
OLDER_QUADRAT_JOIN_KEYS = [
    "Fish Observer", "Invertebrate Observer", "Site", "Transect", "Quadrate",
]

# Season by month number.
SEASON_MONTHS = {
    "Winter": [12, 1, 2],
    "Spring": [3, 4, 5],
    "Summer": [6, 7, 8],
    "Fall": [9, 10, 11],
}

# Tel Aviv segments: Site_number -> Segment.
TLV_SEGMENTS = [
    (1, "Zuk_North"),
    (2, "Zuk_Tel_Baruch"),
    (3, "Tel_Baruch"),
    (4, "Sde_Dov"),
    (5, "Reading"),
    (6, "TLV_Port"),
    (7, "Mezizim_Seperate_Hilton"),
    (8, "Marina_Gordon_Frishman"),
    (9, "Bugrashov_Jerusalem_Aviv"),
    (10, "Dolfinarium"),
    (11, "Charles_Clore"),
    (12, "Jaffa"),
    (13, "Jaffa_Slope"),
    (14, "Givat_Alia"),
]

# Tel Aviv layouts apply to days on or after this date.
TLV_LAYOUT_CUTOFF = "2021-11-01"

# Percent cover divides by this many points, whatever was filled in.
POINTS_PER_QUADRAT = 16

# Cover categories (legend values) of the invertebrate layout, in output order.
COVER_CATEGORIES = [
    "Algae >2cm", "Bivalvia", "Bryozoa", "Cnidaria", "Crustacea", "Echinodermata",
    "Gastropoda", "Other live cover", "Polychaeta", "Rock", "Sand", "Tunicata",
    "CCA Algae", "Algae <2cm", "Sponge",
]

# Invertebrate worksheet blocks. Rows are 1-based data rows (row 0 is the
# header), columns are 1-based sheet columns.
INVERT_METADATA_ROWS = (1, 14)
INVERT_LEGEND_ROWS = (17, 35)
INVERT_BLOCK_ROWS = [(1, 16), (19, 34)]          # top, bottom
INVERT_COVER_COLS = [(4, 6), (10, 12)]           # left, right: Point, Code, Species
INVERT_COUNT_COLS = [(7, 8), (13, 14)]           # left, right: Taxon, Count
INVERT_COMPLEXITY_ROWS = [3, 21]                 # top, bottom
INVERT_COMPLEXITY_COLS = [3, 9]                  # left, right
INVERT_WIDTH = 14

# Metadata keys of the Tel Aviv worksheets (inferred from the output layouts).
TLV_METADATA_KEYS = [
    "Fish Observer", "Invertebrate Observer", "Site", "Transect", "Segment",
    "Substrate Type", "Depth Start", "Depth End", "Time Start", "Time End",
    "Visibility", "Logger", "Photos", "Notes",
]

# Output layouts: (output name, source column). Numbered columns are the
# per-point / per-observation columns of the sheet.
FISH_LAYOUT = (
    [
        ("Project", "Project"), ("Site", "Site"), ("Site_number", "Site_number"),
        ("Survey_id", "Survey_id"), ("Spot", "Spot"), ("Date", "Date"),
        ("Season", "Season"), ("Fish_Observer", "Fish_Observer"),
        ("Invertebrate_Observer", "Invertebrate_Observer"), ("Lat", "Lat"),
        ("Lon", "Lon"), ("Transect", "Transect"), ("Transect_id", "Transect_id"),
        ("Substrate_type", "Substrate Type"), ("Depth Start", "Depth Start"),
        ("Depth End", "Depth End"), ("Time Start", "Time Start"),
        ("Time End", "Time End"), ("Visibility", "Visibility"), ("Logger", "Logger"),
        ("Photos", "Photos"), ("Notes", "Notes"), ("Group", "Group"),
        ("Species", "Species"), ("Amount", "Amount"), ("Length", "Length"),
        ("Distance", "Distance"), ("Confidence", "Confidence"), ("a", "a"), ("b", "b"),
        ("weight_kg", "weight_kg"), ("IUCN", "IUCN"),
    ]
    + [(str(i), str(i)) for i in range(1, 26)]
)

INVERT_LAYOUT = (
    [
        ("Project", "Project"), ("Site", "Site"), ("Site_number", "Site_number"),
        ("Survey_id", "Survey_id"), ("Spot", "Spot"), ("Date", "Date"),
        ("Season", "Season"), ("Fish_Observer", "Fish_Observer"),
        ("Invertebrate_Observer", "Invertebrate_Observer"), ("Group", "Group"),
        ("Method", "Method"), ("Lat", "Lat"), ("Lon", "Lon"), ("Transect", "Transect"),
        ("Transect_id", "Transect_id"), ("Depth_Start", "Depth Start"),
        ("Depth_End", "Depth End"), ("Time_Start", "Time Start"),
        ("Time_End", "Time End"), ("Visibility", "Visibility"), ("Logger", "Logger"),
        ("Photos", "Photos"), ("Notes", "Notes"), ("Substrate_type", "Substrate Type"),
        ("Quadrate_number", "Quadrate"), ("Quadrate_id", "Quadrate_id"),
        ("Taxon", "Taxon"), ("Count", "Count"), ("Complexity", "Complexity"),
    ]
    + [(c, c) for c in COVER_CATEGORIES]
    + [(str(i), str(i)) for i in range(1, 17)]
)
INVERT_METHOD = "Quadrate"

# Expected worksheets per family: (letters, layers, sheet-name pattern,
# prefilled metadata values). Patterns use {dep}, {letter}; prefill uses
# field names resolved per deployment.
SHEET_MANIFEST = {
    "Tel Aviv Transects": (
        ["B", "A"], ["Invertebrates", "Fish"], "{dep} - {letter} - {layer}",
        ["first", "second", "dep", "letter"],
    ),
    "Mediterranean Transects": (
        ["D", "C", "B", "A"], [None], "Site {dep} - Transect {letter}",
        ["first", "second", "dep", "letter"],
    ),
    "Eilat Transects": (
        ["D", "C", "B", "A"], ["CRYPTIC", "TRANSIENTS"],
        "Site {dep} - Transect {letter} - {layer}",
        ["first", "second", "dep", "letter"],
    ),
    "Eilat Knolls": (
        [None], [None], "Knoll {dep}", ["first", "second"],
    ),
    "Eilat Juveniles Transects": (
        ["C", "B", "A"], ["CRYPTIC", "TRANSIENTS", "Juveniles"],
        "Site {dep} - Transect {letter} - {layer}",
        ["first", "second", "jfirst", "jsecond", "=Transects", "location", "dep", "letter"],
    ),
    "Eilat Juveniles Knolls": (
        [None], [None, "Juveniles"], "{layer_prefix}Knoll {dep}",
        ["first", "second", "jfirst", "jsecond", "=Knoll", "location", "dep"],
    ),
    "Eilat Juveniles Artificial": (
        [None], [None, "Juveniles"], "{layer_prefix}Artificial {dep}",
        ["first", "second", "jfirst", "jsecond", "=Artificial", "location", "dep"],
    ),
}

BACKUP_FLAG_TEXT = "This is a local backup file and should not be used for further analyses!"

NA_TEXT = "NA"


def family_of(project: str) -> str | None:
    for family, projects in PROJECT_FAMILIES.items():
        if project in projects:
            return family
    return None


def project_family_rows() -> list[tuple[str, str]]:
    """(Project, family) pairs, the literal project dimension."""
    return [(p, f) for f, ps in PROJECT_FAMILIES.items() for p in ps]
