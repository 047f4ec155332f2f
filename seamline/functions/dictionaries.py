"""Word lists and tables that results depend on."""

# Spellings of street types and their canonical form.
TYPE_WORDS = {
    "ST": "ST", "STREET": "ST", "AVE": "AVE", "AV": "AVE", "AVENUE": "AVE", "SQ": "SQ", "SQUARE": "SQ", "ALLEY": "ALLEY", "ALY": "ALLEY",
    "LANE": "LANE", "LN": "LANE", "RD": "RD", "ROAD": "RD", "PL": "PL", "PLACE": "PL", "DR": "DR", "DRIVE": "DR", "BLVD": "BLVD",
    "BOULEVARD": "BLVD", "CRES": "CRES", "CRESCENT": "CRES", "TERR": "TERR", "TERRACE": "TERR", "CT": "CRT", "CRT": "CRT", "COURT": "CRT",
    "WAY": "WAY", "HWY": "HWY", "HIGHWAY": "HWY", "MEWS": "MEWS", "ROW": "ROW",
    "STRASSE": "STRASSE", "STR": "STRASSE", "GASSE": "GASSE", "PLATZ": "PLATZ", "MARKT": "MARKT", "STEIG": "STEIG", "ZEILE": "ZEILE",
    "ALLEE": "ALLEE", "BRUECKE": "BRUECKE", "BRUCKE": "BRUECKE", "PROMENADE": "PROMENADE", "STRAAT": "STRAAT", "GRACHT": "GRACHT",
    "PLEIN": "PLEIN", "SINGEL": "SINGEL",
}
# Type words that are written as a suffix of the name, longest first.
FUSED_SUFFIXES = ["PROMENADE", "STRASSE", "BRUECKE", "BRUCKE", "STRAAT", "GRACHT", "SINGEL", "GASSE", "PLATZ", "MARKT", "STEIG", "ZEILE", "ALLEE", "PLEIN"]
# Directions, words that may lead a name, and words of plan furniture.
DIRECTIONS = ["N", "S", "E", "W", "NORTH", "SOUTH", "EAST", "WEST", "NE", "NW", "SE", "SW"]
LEADING = [
    "AM", "AN", "IM", "IN", "AUF", "ZUM", "ZUR", "ZU", "BEI", "BEIM", "HINTER", "VOR", "UNTER", "UEBER", "DER", "DEM", "DEN", "DIE", "DAS",
    "AAN", "OP", "DE", "HET", "RUE", "PLACE", "LA", "LE", "LES", "DU", "DES", "THE",
]
FURNITURE = [
    "BLK", "BLOCK", "BLDG", "BUILDING", "HOTEL", "HALL", "WHARF", "LOT", "LOTS", "DISTRICT", "TOWNSITE", "PROPOSED", "OFFICIAL", "PLAN",
    "SCALE", "FEET", "SHEET", "KEY", "INDEX", "CITY", "TOWN", "VILLAGE", "LIMITS", "RESERVE", "ROOF", "SHINGLES", "SHINGLE", "WALL", "WALLS",
    "WHSE", "WAREHOUSE", "PLATFORM", "DRIVEWAY", "PREMISES", "STABLE", "SHED", "OFFICE", "DWELLING", "DWG", "BRICK", "FRAME", "IRON",
    "STONE", "GLASS", "INCLINED", "BONDED", "VACANT", "STORIES", "STORY", "BASEMENT", "CELLAR", "TANK", "BOILER", "ENGINE", "YARD", "FENCE",
    "STEPS", "PORCH", "VERANDAH",
]
# Colour words and their hue bands in degrees, wrapping at 360; None is grey.
HUE_BANDS = {
    "yellow": (35, 75), "gelb": (35, 75), "jaune": (35, 75), "orange": (15, 40), "brown": (10, 45), "braun": (10, 45), "brun": (10, 45),
    "pink": (320, 20), "red": (330, 25), "rot": (330, 25), "rouge": (330, 25), "rose": (320, 20), "rosa": (320, 20),
    "green": (80, 170), "gruen": (80, 170), "grün": (80, 170), "vert": (80, 170), "blue": (180, 260), "blau": (180, 260), "bleu": (180, 260),
    "purple": (260, 320), "violet": (260, 320), "violett": (260, 320), "grey": None, "gray": None, "grau": None, "gris": None,
}
# Keys of an address that name a municipality, the first that is there.
MUNICIPALITY_KEYS = ["city", "town", "village", "municipality", "city_district", "borough", "hamlet", "suburb"]
SIDES = ["N", "NE", "E", "SE", "S", "SW", "W", "NW"]
