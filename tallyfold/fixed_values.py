"""Values that results depend on and that no rule derives.

FIXED VALUES: codes, labels, cut-offs and coordinates; change them only together with the
data they describe.
"""

# Country and territory prefixes of the station ids.
TERRITORY_PREFIXES = ["US", "CQ", "GQ", "AQ", "RQ", "VQ"]
UNINCORPORATED_FIRST_PREFIXES = ["RQ", "VQ", "CQ", "AQ", "US"]

# Observed elements.
ELEMENTS = ["TMIN", "PRCP", "SNOW", "AWND"]

# A (station, element) pair is kept when it reports on more days than this.
MIN_REPORTED_DAYS = 350

# Distances are EARTH_RADIUS_KM x atan2(sqrt a, sqrt(1 - a)): half the great circle.
EARTH_RADIUS_KM = 6371
MAX_DISTANCE = 600

# Only locations ranked before this one are worth resolving by hand.
SIGNIFICANT_RANK = 500

UNKNOWN_ELEVATION = -999.9
UNKNOWN_COUNTY = "Unknown"

# Open box around the Hawaiian islands.
HAWAII_LATITUDE = (18.0, 22.5)
HAWAII_LONGITUDE = (-160.5, -154.0)

# Fixed-width station register: field, first column (from 1), width (0: to the end), type.
STATION_FIELDS = [
    ("station_id", 1, 11, "string"),
    ("latitude", 14, 7, "double"),
    ("longitude", 22, 9, "double"),
    ("elevation", 32, 7, "double"),
    ("state", 39, 2, "string"),
    ("station_name", 42, 0, "string"),
]

# Columns in the gazetteer header; a county name of n words adds n - 1 tokens.
GAZETTEER_HEADER_COLUMNS = 10

AGE_GROUPS = [
    (0, "0 - 9 Years"),
    (10, "10 - 19 Years"),
    (20, "20 - 29 Years"),
    (30, "30 - 39 Years"),
    (40, "40 - 49 Years"),
    (50, "50 - 59 Years"),
    (60, "60 - 69 Years"),
    (70, "70 - 79 Years"),
    (80, "80+ Years"),
    (1000, "Missing"),
    (2000, "NA"),
]

RACES = [
    (0, "American Indian/Alaska Native", False),
    (1, "Asian", False),
    (2, "Black", False),
    (3, "Native Hawaiian/Other Pacific Islander", False),
    (4, "White", False),
    (5, "Hispanic/Latino", True),
    (10, "Multiple/Other", None),
    (1000, "Missing", None),
    (2000, "NA", None),
    (3000, "Unknown", None),
]

SEXES = [
    (0, "Female"),
    (1, "Male"),
    (2, "Other"),
    (1000, "Missing"),
    (2000, "NA"),
    (3000, "Unknown"),
]

# State names in the coordinate list that differ from the case reports.
STATE_RENAMES = [("Washington State", "Washington")]

# Territories that only report under an unknown county: state, latitude, longitude.
TERRITORY_COORDINATES = [
    ("Puerto Rico", 18.2223, -66.4303),
    ("Virgin Islands", 18.34, -64.90),
    ("Guam", 13.4440, 144.7671),
    ("Northern Mariana Islands", 15.16, 145.7),
]

# Reporting places without a gazetteer entry: county, latitude, longitude.
PLACE_COORDINATES = [
    ("New York City", 40.712740, -74.005974),
    ("Kansas City", 39.099724, -94.578331),
    ("Joplin", 37.0842, -94.5133),
    ("St. Croix", 17.73, -64.78),
    ("St. John", 18.33, -64.794),
    ("St. Thomas", 18.34, -64.93),
    ("Valdez-Cordova Census Area", 61.129050, -146.360130),
    ("Saipan", 15.27, 145.72),
    ("Tinian", 14.98, 145.636),
]
