"""Class sets, default sizes, palettes, rule tables. They must equal the values other tools use,
so they are stated as they are and used as literals (never as joined tables)."""

EARTH_M_PER_DEG = 111320.0
WGS84_A, WGS84_F = 6378137.0, 1 / 298.257223563
GRS80_F = 1 / 298.257222101
METRES_PER_ENGINE_UNIT = 0.28

STOREY_M, GROUND_STOREY_M, FLOATING_M = 3.0, 3.8, 2.5

# Road classes with default widths in metres.
CAR_WIDTH = {
    "motorway": 12, "trunk": 11, "primary": 10, "secondary": 9, "tertiary": 8, "unclassified": 6, "residential": 6.5,
    "living_street": 5.5, "service": 4.2, "pedestrian": 6, "track": 3.5, "busway": 7, "road": 6, "raceway": 8,
    "motorway_link": 7, "trunk_link": 7, "primary_link": 7, "secondary_link": 7, "tertiary_link": 6,
}
SOFT_WIDTH = {"footway": 2.4, "path": 2.2, "cycleway": 2.6, "steps": 2.4, "bridleway": 2.5, "platform": 3.0}
SERVICE_WIDTH = {"parking_aisle": 5.0, "driveway": 3.2, "alley": 3.6}
UNBUILT_ROADS = ["proposed", "construction", "corridor", "elevator", "bus_stop"]
SIDEWALK_CLASSES = ["trunk", "primary", "secondary", "tertiary", "residential", "unclassified", "primary_link",
                    "secondary_link", "tertiary_link"]
COBBLE_SURFACES = ["sett", "cobblestone", "unhewn_cobblestone", "cobblestone:flattened", "paving_stones", "bricks", "stone"]
SOFT_SURFACES = ["gravel", "fine_gravel", "compacted", "dirt", "ground", "earth", "grass", "sand", "mud", "unpaved",
                 "woodchips", "pebblestone"]
WATERWAY_WIDTH = {"river": 14, "canal": 9, "stream": 2.5, "ditch": 1.4, "drain": 1.2}
WALL_SIZE = {"city_wall": (7.5, 2.2), "wall": (1.8, 0.4), "hedge": (1.4, 1.1), "retaining_wall": (1.0, 0.5)}
SPAWN_ROADS = ["trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "living_street", "pedestrian",
               "service", "primary_link", "secondary_link", "tertiary_link", "road", "busway"]
MAIN_ROADS = ["trunk", "primary", "secondary", "tertiary", "unclassified", "residential"]
WALKWAYS = ["footway", "path", "steps", "cycleway"]

# Building kinds.
NOT_BUILT = ["no", "roof", "construction", "proposed", "demolished", "collapsed"]
HOUSE_KINDS = ["house", "detached", "semidetached_house", "terrace", "bungalow", "cabin", "farm", "farm_auxiliary", "villa",
               "barn", "stable", "hut", "shed", "cowshed", "static_caravan", "boathouse", "chapel", "church", "cathedral", "kiosk"]
SMALL_KINDS = ["garage", "garages", "shed", "carport", "hut", "kiosk", "toilets", "service", "transformer_tower", "bunker",
               "container"]
CHURCH_KINDS = ["church", "cathedral", "chapel", "basilica"]
LANDMARK_KINDS = CHURCH_KINDS + ["castle", "tower", "townhall", "train_station", "museum", "palace", "fort", "monastery",
                                 "mosque", "synagogue", "temple", "government", "civic"]
LANDMARK_TAGS = ["historic", "tourism", "heritage"]
LANDMARK_AMENITIES = ["place_of_worship", "townhall", "theatre", "library"]
DWELLING_KINDS = ["house", "detached", "semidetached_house", "bungalow", "cabin", "villa", "farm"]
FLAT_KINDS = ["apartments", "residential", "dormitory"]
HALL_KINDS = ["industrial", "warehouse", "manufacture", "hangar", "factory", "sports_hall", "supermarket", "retail"]
CIVIC_KINDS = ["commercial", "office", "hotel", "school", "hospital", "university", "public", "civic", "government", "college"]
SHED_KINDS = ["industrial", "warehouse", "manufacture", "hangar", "factory", "garages", "garage", "shed", "carport"]
UNPITCHED_KINDS = ["industrial", "warehouse", "retail", "supermarket", "commercial", "office"]

# Priority of feature keys when counting categories.
CATEGORY_KEYS = ["building", "building:part", "highway", "railway", "waterway", "landuse", "leisure", "natural", "barrier"]

# sRGB colours by name.
NAMED_COLOURS = {
    "white": (0.93, 0.92, 0.89), "black": (0.15, 0.15, 0.15), "grey": (0.6, 0.6, 0.6), "gray": (0.6, 0.6, 0.6),
    "silver": (0.72, 0.72, 0.72), "red": (0.62, 0.22, 0.18), "darkred": (0.45, 0.15, 0.12), "maroon": (0.42, 0.14, 0.12),
    "brown": (0.45, 0.30, 0.22), "orange": (0.85, 0.55, 0.30), "yellow": (0.92, 0.82, 0.50), "beige": (0.88, 0.82, 0.68),
    "cream": (0.93, 0.89, 0.76), "ivory": (0.92, 0.89, 0.80), "tan": (0.80, 0.68, 0.52), "green": (0.45, 0.58, 0.42),
    "darkgreen": (0.25, 0.36, 0.26), "olive": (0.50, 0.50, 0.30), "blue": (0.48, 0.58, 0.72), "lightblue": (0.68, 0.78, 0.86),
    "navy": (0.20, 0.25, 0.40), "pink": (0.88, 0.66, 0.66), "salmon": (0.88, 0.62, 0.52), "terracotta": (0.74, 0.44, 0.32),
    "lightgrey": (0.78, 0.78, 0.76), "lightgray": (0.78, 0.78, 0.76), "darkgrey": (0.38, 0.38, 0.38),
    "darkgray": (0.38, 0.38, 0.38),
}
# Palettes of wall and roof styles.
WALL_PALETTES = {
    "plaster": {"ivory": (0.90, 0.86, 0.74), "ochre": (0.84, 0.66, 0.40), "yellow": (0.93, 0.83, 0.54), "salmon": (0.87, 0.63, 0.52),
                "rose": (0.82, 0.62, 0.60), "white": (0.93, 0.92, 0.89), "grey": (0.71, 0.71, 0.69), "green": (0.71, 0.79, 0.67),
                "blue": (0.64, 0.72, 0.80), "terracotta": (0.74, 0.44, 0.32)},
    "brick": {"red": (0.64, 0.33, 0.25), "brown": (0.48, 0.31, 0.25), "yellow": (0.82, 0.70, 0.50), "dark": (0.36, 0.28, 0.25)},
    "wood": {"falu": (0.56, 0.18, 0.14), "yellow": (0.91, 0.79, 0.47), "white": (0.93, 0.93, 0.90), "grey": (0.63, 0.67, 0.69),
             "green": (0.47, 0.57, 0.46), "blue": (0.50, 0.60, 0.72)},
    "stone": {"limestone": (0.80, 0.76, 0.66), "grey": (0.60, 0.60, 0.58), "sandstone": (0.78, 0.64, 0.48)},
    "concrete": {"light": (0.76, 0.75, 0.72), "dark": (0.54, 0.54, 0.52)},
    "glass": {"blue": (0.58, 0.68, 0.76), "dark": (0.38, 0.41, 0.45)},
    "metal": {"grey": (0.62, 0.64, 0.65), "blue": (0.38, 0.47, 0.58), "red": (0.60, 0.27, 0.22), "green": (0.42, 0.52, 0.44)},
}
# Colours of a wall style that only a correction may ask for.
WALL_EXTRA = {
    "plaster": ["beige", "red"], "brick": ["salmon", "tan"],
    "wood": ["teal", "pale", "pine", "cream", "ochre", "petrol", "brown", "weathered", "black"],
}
ROOF_PALETTES = {
    "tiles": {"red": (0.62, 0.30, 0.22), "brown": (0.42, 0.27, 0.21), "dark": (0.24, 0.22, 0.22)},
    "metal": {"grey": (0.45, 0.47, 0.48), "red": (0.52, 0.20, 0.16), "black": (0.16, 0.17, 0.18), "copper": (0.33, 0.55, 0.47)},
    "slate": {"dark": (0.26, 0.27, 0.30)},
}
# Regional weights.
REGION_COUNTRIES = {
    "nordic": ["se", "no", "fi", "dk", "is", "ax"],
    "brick_north": ["gb", "ie", "nl", "be", "de", "pl", "ee", "lv", "lt"],
    "mediterranean": ["es", "pt", "it", "gr", "hr", "mt", "cy", "fr", "mc", "sm"],
}
REGION_HOUSE = {
    "nordic": {"wood": 0.55, "plaster": 0.35, "brick": 0.10}, "brick_north": {"brick": 0.6, "plaster": 0.35, "wood": 0.05},
    "mediterranean": {"plaster": 0.8, "stone": 0.15, "brick": 0.05}, "default": {"plaster": 0.5, "brick": 0.3, "wood": 0.2},
}
REGION_BLOCK = {
    "nordic": {"plaster": 0.6, "brick": 0.4}, "brick_north": {"brick": 0.55, "plaster": 0.35, "concrete": 0.10},
    "mediterranean": {"plaster": 0.75, "stone": 0.15, "concrete": 0.10}, "default": {"plaster": 0.5, "brick": 0.3, "concrete": 0.2},
}
REGION_ROOF = {
    "nordic": {"tiles": 0.55, "metal": 0.35, "slate": 0.10}, "brick_north": {"tiles": 0.6, "slate": 0.3, "metal": 0.1},
    "mediterranean": {"tiles": 0.85, "slate": 0.1, "metal": 0.05}, "default": {"tiles": 0.55, "metal": 0.3, "slate": 0.15},
}
NORDIC_WOOD = {"falu": 0.45, "yellow": 0.2, "white": 0.2, "grey": 0.1, "green": 0.05}
# Tag values to styles.
WALL_MATERIALS = {
    "brick": "brick", "wood": "wood", "timber_framing": "wood", "stone": "stone", "sandstone": "stone", "limestone": "stone",
    "concrete": "concrete", "glass": "glass", "metal": "metal", "plaster": "plaster", "render": "plaster",
    "cement_block": "concrete",
}
ROOF_SHAPES = {
    "gabled": "gabled", "half-hipped": "hipped", "saltbox": "gabled", "gambrel": "gabled", "mansard": "hipped", "hipped": "hipped",
    "side_hipped": "hipped", "pyramidal": "pyramidal", "dome": "pyramidal", "onion": "pyramidal", "cone": "pyramidal",
    "round": "gabled", "skillion": "flat", "flat": "flat", "quadruple_saltbox": "hipped", "crosspitched": "hipped",
}
ROOF_MATERIALS = {
    "roof_tiles": "tiles", "tile": "tiles", "tiles": "tiles", "clay": "tiles", "metal": "metal", "copper": "metal", "tin": "metal",
    "slate": "slate", "eternit": "slate", "asbestos": "slate", "concrete": "slate", "tar_paper": "slate",
}
# Ground layers by rank, the layers that may lie over water, and where a class comes from.
GROUND_LAYERS = ["asphalt", "cobble", "sidewalk", "pier", "paving", "path", "parking", "rail", "sand", "pitch", "park", "grass",
                 "cemetery", "forest", "field", "dirt"]
DECK_LAYERS = ["asphalt", "cobble", "paving", "path"]
MAP_KINDS = {"park": "green", "grass": "green", "cemetery": "green", "forest": "green", "pitch": "green", "asphalt": "road",
             "cobble": "road", "parking": "road", "paving": "path", "path": "path"}

# Street furniture kinds.
PROP_KINDS = {"street_lamp": "lamp", "traffic_signals": "signal", "bus_stop": "busstop", "bench": "bench",
              "waste_basket": "bin", "fountain": "fountain", "post_box": "postbox", "telephone": "phone",
              "bicycle_parking": "bikerack"}

# Known elevation licences, recognised by a phrase in the attribution.
TERRAIN_LICENCES = [
    ("Markhöjdmodell © Lantmäteriet", "Lantmäteriet Markhöjdmodell", "CC-BY-4.0"),
    ("Copernicus DEM GLO-30", "Copernicus DEM GLO-30", "Copernicus DEM licence (free of charge, attribution required)"),
]

# Packet types a relay forwards.
PACKET_TYPES = ["state", "gun", "rocket", "mine", "flame", "hit", "death", "respawn", "match", "request-sync", "pickup",
                "impact", "prop"]
