"""Names, lookups, limits and patterns that results depend on."""

from __future__ import annotations

# The analysed variables.
VARIABLES = (
    "AMMONIA TOTAL",
    "CARBON TOTAL ORGANIC (TOC)",
    "CHLORIDE DISSOLVED",
    "ESCHERICHIA COLI",
    "NITROGEN TOTAL (CALCD.)",
    "NITROGEN, NITRATE",
    "PH",
    "PHOSPHORUS TOTAL (P)",
    "PHOSPHORUS TOTAL DISSOLVED",
    "SODIUM ADSORPTION RATIO (CALCD.)",
    "SPECIFIC CONDUCTANCE (FIELD)",
    "SULPHATE DISSOLVED",
    "TOTAL DISSOLVED SOLIDS (CALCD.)",
    "TOTAL SUSPENDED SOLIDS (TSS)",
    "TURBIDITY",
)

# Agencies as they appear in the data.
CITY_AGENCY = "CITY OF CALGARY"
PROVINCIAL_AGENCY = "ALBERTA ENVIRONMENT AND PROTECTED AREAS"
FEDERAL_AGENCY = "ENVIRONMENT CANADA"

# Stations kept per agency.
CITY_STATIONS = (
    "Bow River Upstream of Highwood River",
    "Bow River Cushing Bridge",
    "Big Hill Creek Mouth",
    "Fish Creek Mouth",
    "Bow River Below Bearspaw Dam",
    "Nose Creek Mouth",
    "Jumpingpound Creek Mouth",
)
PROVINCIAL_STATIONS = (
    "BOW RIVER, AT CLUNY",
    "BOW RIVER, AT COCHRANE",
    "BOW RIVER, BELOW CARSELAND DAM",
    "BOW RIVER, NEAR RONALANE BRIDGE",
    "WEST ARROWWOOD CREEK, D/S OF SYPHON",
    "EAST ARROWWOOD CREEK, NEAR THE MOUTH",
    "CROWFOOT CREEK, ON HWY 1",
    "SHEEP RIVER, 1.6 KM D/S OF HWY 2",
    "HIGHWOOD RIVER, AT HWY 552",
    "PINE CREEK, NEAR THE MOUTH",
    "ELBOW RIVER, AT 9TH AVE BRIDGE",
    "JUMPINGPOUND CREEK, NEAR MOUTH",
    "COAL CREEK, 1/2 MILE WEST OF BOW CITY",
    "NEW WEST COULEE, AT HWY 36 CROSSING",
    "TWELVE MILE CREEK, AT GAUGING STATION (RANGE ROAD 525)",
    "NOSE CREEK, NEAR THE MOUTH-MEMORIAL DRIVE",
    "GHOST RIVER, ABOVE CONFLUENCE WITH WAIPAROUS CREEK",
)
FEDERAL_STATION_NAMES = {
    "AL05BA0011": "Bow River at Highway 1 Above Lake Louise",
    "AL05BE0013": "Bow River About 4.5km Above Canmore",
}

# Reach of each station; the second entry is the reach of every other station.
CITY_REACHES = ({"Big Hill Creek Mouth": "Upper Foothills"}, "Lower Foothills")
PROVINCIAL_REACHES = (
    {
        "GHOST RIVER, ABOVE CONFLUENCE WITH WAIPAROUS CREEK": "Upper Foothills",
        "JUMPINGPOUND CREEK, NEAR MOUTH": "Upper Foothills",
        "BOW RIVER, AT COCHRANE": "Lower Foothills",
        "ELBOW RIVER, AT 9TH AVE BRIDGE": "Lower Foothills",
        "NOSE CREEK, NEAR THE MOUTH-MEMORIAL DRIVE": "Lower Foothills",
        "PINE CREEK, NEAR THE MOUTH": "Lower Foothills",
        "HIGHWOOD RIVER, AT HWY 552": "Lower Foothills",
        "SHEEP RIVER, 1.6 KM D/S OF HWY 2": "Lower Foothills",
        "BOW RIVER, BELOW CARSELAND DAM": "Middle Bow",
        "WEST ARROWWOOD CREEK, D/S OF SYPHON": "Middle Bow",
        "EAST ARROWWOOD CREEK, NEAR THE MOUTH": "Middle Bow",
        "BOW RIVER, AT CLUNY": "Middle Bow",
        "CROWFOOT CREEK, ON HWY 1": "Middle Bow",
    },
    "Lower Bow",
)
FEDERAL_REACHES = ({"AL05BA0011": "Upper Bow", "AL05BE0013": "Upper Foothills"}, None)

# Variable names per agency that stand for an analysed variable.
CITY_VARIABLES = {
    "Total Dissolved Solids (TDS)(Calculated)": "TOTAL DISSOLVED SOLIDS (CALCD.)",
    "pH": "PH",
    "Specific Conductance (Field)": "SPECIFIC CONDUCTANCE (FIELD)",
    "Turbidity": "TURBIDITY",
    "Nitrate (NO3-N)": "NITROGEN, NITRATE",
    "Total Nitrogen": "NITROGEN TOTAL (CALCD.)",
    "Ammonia (NH3-N)": "AMMONIA TOTAL",
    "Total Phosphorus (TP)": "PHOSPHORUS TOTAL (P)",
    "Total Dissolved Phosphorus (TDP)": "PHOSPHORUS TOTAL DISSOLVED",
    "Chloride (Cl)": "CHLORIDE DISSOLVED",
    "Sulphate (SO4)": "SULPHATE DISSOLVED",
    "Sodium Adsorption Ratio (SAR)(Calculated)": "SODIUM ADSORPTION RATIO (CALCD.)",
    "Total Organic Carbon (TOC)": "CARBON TOTAL ORGANIC (TOC)",
    "E.coli": "ESCHERICHIA COLI",
    "Total Suspended Solids (TSS)": "TOTAL SUSPENDED SOLIDS (TSS)",
}
PROVINCIAL_VARIABLES = {
    "PH (FIELD)": "PH",
    "RESIDUE NONFILTERABLE": "TOTAL SUSPENDED SOLIDS (TSS)",
}
FEDERAL_VARIABLES = {
    "TOTAL DISSOLVED SOLIDS (FILTERABLE RESIDUE) (CALCD.)": "TOTAL DISSOLVED SOLIDS (CALCD.)",
    "PH (FIELD)": "PH",
    "SPECIFIC CONDUCTANCE": "SPECIFIC CONDUCTANCE (FIELD)",
    "DISSOLVED NITRITE/NITRATE": "NITROGEN, NITRATE",
    "PHOSPHORUS TOTAL": "PHOSPHORUS TOTAL (P)",
    "CARBON TOTAL ORGANIC (CALCD.)": "CARBON TOTAL ORGANIC (TOC)",
    "OXYGEN DISSOLVED": "OXYGEN DISSOLVED (FIELD METER)",
    "TEMPERATURE WATER (FIELD)": "TEMPERATURE WATER",
    "RESIDUE NONFILTERABLE": "TOTAL SUSPENDED SOLIDS (TSS)",
}
# Fixed value: the laboratory pH that is dropped in favour of the field reading.
FEDERAL_DROPPED_VARIABLE = "PH"

# Spellings of units.
UNITS = {
    "°C": "deg C",
    "DEG C": "deg C",
    "åµS/CM": "µS/cm",
    "uS/cm": "µS/cm",
    "PH": "pH units",
    "ratio": "rel units",
    "REL UNIT": "rel units",
    "NO/100ML": "No/100 mL",
    "MG/L": "mg/L",
}
# Fixed values: (variable, wrong unit, right unit).
UNIT_REPAIRS = (
    ("ESCHERICHIA COLI", "MPN/100mL", "No/100 mL"),
    ("SODIUM ADSORPTION RATIO (CALCD.)", "mg/L", "rel units"),
)

# The derived nitrogen total and its parts, calculated after this year.
TOTAL_COMPONENTS = ("NOx (Calculated)", "Total Kjeldahl Nitrogen (TKN)")
TOTAL_NAME = "Total Nitrogen"
TOTAL_AFTER_YEAR = 2018
# Variables taken from the later provincial extract, and the one it replaces.
SUPPLIED_VARIABLES = ("SODIUM ADSORPTION RATIO (CALCD.)", "NITROGEN TOTAL (CALCD.)")
REPLACED_VARIABLE = "SODIUM ADSORPTION RATIO (CALCD.)"

# Study period.
FIRST_YEAR, LAST_YEAR = 2002, 2022

# Time patterns of the inputs.
CITY_TIME = "M/d/yyyy H:mm"
PROVINCIAL_TIME = "M/d/yyyy H:mm"
PROVINCIAL_SUPPLEMENT_TIME = "M/d/yyyy H:mm:ss"
FEDERAL_TIME = "yyyy-M-d H:mm"
GAUGE_TIME = "yyyy/MM/dd HH:mm:ss"

# Measurement flags.
BELOW_LIMIT_FLAGS = ("L", "<")
ABOVE_LIMIT_FLAGS = ("G", ">")
DETECTION_CONDITIONS = ("below detection limit", "detected", "above detection limit")

# Seasons as (name, first month, last month) and the name of the other months.
SEASONS = {
    "water": ((("high flow", 5, 7), ("open water", 8, 10)), "under ice"),
    "ice": ((("Open", 4, 10),), "Ice"),
    "flow": ((("OpenWater", 4, 11),), "Winter"),
}
SEASON_ORDER = ("high flow", "open water", "under ice")
MONTHS = ("Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec")

# Year ranking.
CUTOFF_YEAR = 2022
RANK_FLOOR = 0.01
RANK_BREAKS = (0.0, 0.1, 0.25, 0.75, 0.90, 1.0)
RANK_LABELS = ("<10th", "10th - 24th", "25th - 75th", "76th - 90th", ">90th")
NOT_RANKED = "Not ranked"

# Flux.
FLUX_UNITS = ("mg/L", "No/100 mL")
COUNT_UNIT = "No/100 mL"
COUNT_VARIABLE = "ESCHERICHIA COLI"
DRAFT_FLUX_VARIABLES = (
    "CHLORIDE DISSOLVED",
    "SULPHATE DISSOLVED",
    "NITROGEN TOTAL (CALCD.)",
    "TOTAL DISSOLVED SOLIDS (CALCD.)",
    "CARBON TOTAL ORGANIC (TOC)",
    "NITROGEN, NITRATE",
    "AMMONIA TOTAL",
    "ESCHERICHIA COLI",
    "PHOSPHORUS TOTAL (P)",
    "PHOSPHORUS TOTAL DISSOLVED",
    "TOTAL SUSPENDED SOLIDS (TSS)",
)

# Flow gauges.
FLOW_STATIONS = (
    "05BE004", "05BA001", "05BH004", "05BN012", "05BM008", "05BJ001", "05BK001", "05BG010",
    "05BL024", "05BH015", "05BN006", "05BL012", "05BN002", "05BM014", "05BG006",
)
SYNTHETIC_FLOW_STATION = ("BRHR", "05BM002", "05BL024")
GAUGE_SITE_STATIONS = ({"PC2A": "PC"}, "NC")
SPRING_FLOW_STATION = "BHC"

# Guideline bounds and their order, and the bounds themselves
# (source, variable, lower, upper, unit, exposure).
GUIDELINE_BOUNDS = ("Upper acute", "Upper chronic", "Lower chronic")
GUIDELINES = (
    ("AEPA Protection of Aquatic Life (PAL)", "CHLORIDE DISSOLVED", None, 120.0, "mg/L", "chronic"),
    ("AEPA Protection of Aquatic Life (PAL)", "CHLORIDE DISSOLVED", None, 640.0, "mg/L", "acute"),
    ("AEPA Protection of Aquatic Life (PAL)", "NITROGEN, NITRATE", None, 3.0, "mg/L", "chronic"),
    ("AEPA Protection of Aquatic Life (PAL)", "NITROGEN, NITRATE", None, 124.0, "mg/L", "acute"),
    ("AEPA Protection of Aquatic Life (PAL)", "PH", 6.5, 9.0, "pH units", "chronic"),
    ("AEPA Protection of Aquatic Life (PAL)", "SULPHATE DISSOLVED", None, 309.0, "mg/L", "chronic"),
    ("AEPA Protection of Agricultural Uses", "SODIUM ADSORPTION RATIO (CALCD.)", None, 5.0, "rel units", "chronic"),
    ("AEPA Recreation and Aesthetics", "ESCHERICHIA COLI", None, 100.0, "No/100 mL", "chronic"),
)

# Guideline lines of the earlier panels (panel, exposure, value).
DRAFT_GUIDELINES = (
    ("CHLORIDE DISSOLVED (mg/L)", "Chronic", 120.0),
    ("CHLORIDE DISSOLVED (mg/L)", "Acute", 640.0),
    ("NITROGEN, NITRATE (mg/L)", "Chronic", 3.0),
    ("NITROGEN, NITRATE (mg/L)", "Acute", 124.0),
    ("OXYGEN DISSOLVED (FIELD METER) (mg/L)", "Chronic", 6.5),
    ("OXYGEN DISSOLVED (FIELD METER) (mg/L)", "Acute", 5.0),
)
DRAFT_EXCLUDED_UNIT = "JTU"

# Titles, labels and scales of the charts.
TITLE_WITHOUT_UNIT = ("PH", "SODIUM ADSORPTION RATIO (CALCD.)")
LINEAR_ONLY_VARIABLES = ("PH",)
FILE_NAME_REPLACEMENTS = {"u/s": "upstream"}
UNAVAILABLE = "Unavailable"
NOT_A_FLUX = "Not a flux parameter"
FLOW_PANEL = "FLOW (cms)"
PANEL_FIRST_DATE = "2000-01-01"
CONCENTRATION_PANELS = (
    "FLOW (cms)",
    "AMMONIA TOTAL (mg/L)",
    "CARBON TOTAL ORGANIC (TOC) (mg/L)",
    "CHLORIDE DISSOLVED (mg/L)",
    "ESCHERICHIA COLI (No/100 mL)",
    "NITROGEN TOTAL (CALCD.) (mg/L)",
    "NITROGEN, NITRATE (mg/L)",
    "PH",
    "PHOSPHORUS TOTAL (P) (mg/L)",
    "PHOSPHORUS TOTAL DISSOLVED (mg/L)",
    "SODIUM ADSORPTION RATIO (CALCD.)",
    "SPECIFIC CONDUCTANCE (FIELD) (µS/cm)",
    "SULPHATE DISSOLVED (mg/L)",
    "TOTAL DISSOLVED SOLIDS (CALCD.) (mg/L)",
    "TOTAL SUSPENDED SOLIDS (TSS) (mg/L)",
    "TURBIDITY (NTU)",
)
FLUX_PANELS = (
    "FLOW (cms)",
    "AMMONIA TOTAL (mg/s)",
    "CARBON TOTAL ORGANIC (TOC) (mg/s)",
    "CHLORIDE DISSOLVED (mg/s)",
    "ESCHERICHIA COLI (No/s)",
    "NITROGEN TOTAL (CALCD.) (mg/s)",
    "NITROGEN, NITRATE (mg/s)",
    "PH",
    "PHOSPHORUS TOTAL (P) (mg/s)",
    "PHOSPHORUS TOTAL DISSOLVED (mg/s)",
    "SODIUM ADSORPTION RATIO (CALCD.)",
    "SPECIFIC CONDUCTANCE (FIELD)",
    "SULPHATE DISSOLVED (mg/s)",
    "TOTAL DISSOLVED SOLIDS (CALCD.) (mg/s)",
    "TOTAL SUSPENDED SOLIDS (TSS) (mg/s)",
    "TURBIDITY",
)
NON_FLUX_PANELS = ("PH", "SODIUM ADSORPTION RATIO (CALCD.)", "SPECIFIC CONDUCTANCE (FIELD)", "TURBIDITY")

# The limit to substitute per (agency, variable), chosen after review of the reported limits.
CHOSEN_LIMITS = (
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "AMMONIA TOTAL", 0.05),
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "CARBON TOTAL ORGANIC (TOC)", 0.5),
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "CHLORIDE DISSOLVED", 1.0),
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "ESCHERICHIA COLI", 10.0),
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "NITROGEN, NITRATE", 0.003),
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "PHOSPHORUS TOTAL (P)", 0.003),
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "PHOSPHORUS TOTAL DISSOLVED", 0.003),
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "TOTAL SUSPENDED SOLIDS (TSS)", 1.0),
    ("ALBERTA ENVIRONMENT AND PROTECTED AREAS", "TURBIDITY", 1.0),
    ("CITY OF CALGARY", "AMMONIA TOTAL", 0.05),
    ("CITY OF CALGARY", "CARBON TOTAL ORGANIC (TOC)", 0.5),
    ("CITY OF CALGARY", "ESCHERICHIA COLI", 10.0),
    ("CITY OF CALGARY", "NITROGEN, NITRATE", 0.005),
    ("CITY OF CALGARY", "PHOSPHORUS TOTAL (P)", 0.003),
    ("CITY OF CALGARY", "PHOSPHORUS TOTAL DISSOLVED", 0.003),
    ("CITY OF CALGARY", "TOTAL SUSPENDED SOLIDS (TSS)", 2.0),
    ("ENVIRONMENT CANADA", "ESCHERICHIA COLI", 10.0),
    ("ENVIRONMENT CANADA", "PHOSPHORUS TOTAL (P)", 0.002),
    ("ENVIRONMENT CANADA", "PHOSPHORUS TOTAL DISSOLVED", 0.002),
    ("ENVIRONMENT CANADA", "TOTAL SUSPENDED SOLIDS (TSS)", 1.0),
)
