"""Code lists, aliases, rules and policies that results depend on."""

# Service-level policies: agency, complaint type, descriptor (None = any), days, business hours only.
SLA_POLICIES = [
    ("NYPD", "Noise - Residential", None, 30, False),
    ("NYPD", "Noise - Commercial", None, 30, False),
    ("NYPD", "Noise - Vehicle", None, 30, False),
    ("NYPD", "Blocked Driveway", None, 5, False),
    ("NYPD", "Illegal Parking", None, 5, False),
    ("DOB", "General Construction/Plumbing", None, 5, False),
    ("DOB", "Illegal Construction", None, 5, False),
    ("DOHMH", "Rodent", None, 14, False),
    ("DOHMH", "Food Poisoning", None, 3, False),
    ("DSNY", "Missed Collection", None, 2, False),
    ("DSNY", "Recyclables Not Collected", None, 2, False),
    ("DSNY", "Garbage Not Collected", None, 2, False),
    ("DOT", "Street Light Condition", None, 10, False),
    ("DOT", "Pothole", None, 10, False),
    ("DOT", "Traffic Signal Condition", None, 5, False),
    ("DPR", "Damaged Tree", None, 30, False),
    ("DPR", "Park Maintenance", None, 30, False),
    ("DEP", "Water Leak", None, 3, False),
    ("DEP", "Sewer Backup", None, 1, False),
    ("DEP", "Catch Basin Clogged", None, 5, False),
    ("HPD", "Heat/Hot Water", None, 1, False),
    ("HPD", "Plumbing", None, 5, False),
    ("HPD", "Paint/Plaster", None, 14, False),
    ("DOF", "Property Tax", None, 30, False),
    ("DCA", "Consumer Complaint", None, 30, False),
    ("FDNY", "Fire Hazard", None, 1, False),
    ("TLC", "Taxi Complaint", None, 14, False),
    ("NYCHA", "Maintenance", None, 14, False),
    ("*", "*", None, 30, False),
]

# The shorter list that the ordered lookup searches.
LOOKUP_POLICIES = [
    ("NYPD", "Noise - Residential", None, 30, False),
    ("NYPD", "Noise - Commercial", None, 30, False),
    ("DOB", "General Construction/Plumbing", None, 5, False),
    ("DOHMH", "Rodent", None, 14, False),
    ("DSNY", "Missed Collection", None, 2, False),
    ("DOT", "Street Light Condition", None, 10, False),
    ("HPD", "Heat/Hot Water", None, 1, False),
    ("DEP", "Water Leak", None, 3, False),
    ("*", "*", None, 30, False),
]

DEFAULT_SLA_DAYS = 30

# Borough name -> accepted spellings.
BOROUGH_ALIASES = {
    "MANHATTAN": ["MANHATTAN", "NEW YORK", "MN"],
    "BRONX": ["BRONX", "BX"],
    "BROOKLYN": ["BROOKLYN", "BK", "KINGS"],
    "QUEENS": ["QUEENS", "QN"],
    "STATEN ISLAND": ["STATEN ISLAND", "SI", "RICHMOND"],
}
UNSPECIFIED = "UNSPECIFIED"

BOROUGH_COUNTY = {
    "MANHATTAN": "New York County",
    "BRONX": "Bronx County",
    "BROOKLYN": "Kings County",
    "QUEENS": "Queens County",
    "STATEN ISLAND": "Richmond County",
}
BOROUGH_ORDER = ["MANHATTAN", "BRONX", "BROOKLYN", "QUEENS", "STATEN ISLAND"]

# Agency long name -> code.
AGENCY_ALIASES = {
    "NEW YORK POLICE DEPARTMENT": "NYPD",
    "POLICE DEPARTMENT": "NYPD",
    "DEPARTMENT OF BUILDINGS": "DOB",
    "DEPARTMENT OF HEALTH": "DOHMH",
    "DEPARTMENT OF SANITATION": "DSNY",
    "DEPARTMENT OF TRANSPORTATION": "DOT",
    "DEPARTMENT OF PARKS": "DPR",
    "DEPARTMENT OF ENVIRONMENTAL PROTECTION": "DEP",
    "HOUSING PRESERVATION": "HPD",
    "DEPARTMENT OF FINANCE": "DOF",
    "DEPARTMENT OF CONSUMER AFFAIRS": "DCA",
    "FIRE DEPARTMENT": "FDNY",
    "LAW DEPARTMENT": "LAW",
    "TAXI AND LIMOUSINE": "TLC",
    "HOUSING AUTHORITY": "NYCHA",
}

AGENCY_DOMAINS = {
    "Public Safety": ["NYPD", "FDNY"],
    "Housing & Buildings": ["DOB", "HPD"],
    "Environmental Services": ["DSNY", "DEP"],
    "Transportation": ["DOT", "TLC"],
    "Parks & Recreation": ["DPR"],
    "Health & Housing": ["DOHMH", "NYCHA"],
    "Administrative": ["DOF", "DCA", "LAW", "OATH", "DOITT"],
}
OTHER_DOMAIN = "Other"

# Category label -> substrings of the lower-case complaint type; the first label that matches wins.
CATEGORY_RULES = [
    ("Noise", ["noise"]),
    ("Heat/Hot Water", ["heat", "hot water"]),
    ("Rodent/Pest", ["rodent", "pest"]),
    ("Sanitation", ["garbage", "trash", "sanitation"]),
    ("Streets/Sidewalks", ["street", "sidewalk", "pothole"]),
    ("Water/Sewer", ["water", "leak", "sewer"]),
    ("Parks/Trees", ["park", "tree"]),
    ("Construction/Building", ["building", "construction", "permit"]),
    ("Vehicles/Parking", ["vehicle", "parking", "abandoned"]),
]
OTHER_CATEGORY = "Other"
CATEGORIES = [label for label, _ in CATEGORY_RULES] + [OTHER_CATEGORY]
EMERGENCY_WORDS = ["heat", "hot water"]

# The second taxonomy: substrings of complaint type or descriptor.
KEYWORD_RULES = [
    ("noise", ["noise"]),
    ("sanitation", ["garbage", "trash", "recycling", "missed collection", "sanitation"]),
    ("housing", ["heat", "hot water", "housing", "maintenance", "plumbing", "vermin", "rodent", "pest"]),
    ("streets", ["street", "sidewalk", "pothole", "light", "sign", "traffic"]),
    ("vehicles", ["vehicle", "parking", "abandoned", "towed"]),
    ("construction", ["construction", "building", "permit", "renovation"]),
    ("environment", ["water", "air", "odor", "pollution", "sewer"]),
    ("parks", ["park", "tree", "playground"]),
    ("animals", ["dog", "cat", "animal", "wildlife"]),
]
OTHER_KEYWORD = "other"

# House number, street name, street type and unit of an upper-case address.
ADDRESS_PATTERN = (
    r"^([0-9]+)\s+(.+?)\s+"
    r"(ST|AVE|AVENUE|BLVD|BOULEVARD|RD|ROAD|DR|DRIVE|LN|LANE|CT|COURT|PL|PLACE|PKWY|PARKWAY|TER|TERRACE|CIR|CIRCLE)"
    r"(?:\s+(APT|UNIT|#)\s*([A-Za-z0-9_]+))?$"
)

ZIP_LOW, ZIP_HIGH = 10001, 11697

# Value sets and bounds used by the expectation suite and the column tests.
AGENCY_CODES = [
    "NYPD", "DOB", "DOHMH", "DSNY", "DOT", "DPR", "DEP", "HPD",
    "DOF", "DCA", "DOITT", "FDNY", "LAW", "OATH", "TLC", "NYCHA",
]
LOCATION_TYPES = ["Address", "Intersection", "Block Face", "Latitude/Longitude", "N/A"]
BOROUGHS = BOROUGH_ORDER + [UNSPECIFIED]
STATUSES = ["Open", "Closed", "In Progress", "Pending"]
LATITUDE_BOUNDS = (40.47, 40.92)
LONGITUDE_BOUNDS = (-74.26, -73.70)
ROW_COUNT_BOUNDS = (1000, 10000000)
ZIP_PATTERN = "^[0-9]{5}$"
KEY_PATTERN = "^[0-9]{10}$"

# Legal status changes of one request; repeating a status is always legal.
STATUS_CHANGES = [
    ("Open", "In Progress"),
    ("In Progress", "Closed"),
    ("Open", "Pending"),
    ("In Progress", "Pending"),
    ("Pending", "Open"),
    ("Pending", "In Progress"),
]

# (month, day) of the fixed holidays.
FIXED_HOLIDAYS = [(1, 1), (7, 4), (12, 25)]
CALENDAR_START, CALENDAR_END_EXCLUSIVE = "2020-01-01", "2030-12-31"

# Text that stands for null inside a surrogate key.
SURROGATE_NULL = "_dbt_utils_surrogate_key_null_"

LOOKBACK_DAYS = 7
FIRST_RUN_DAYS = 30
FULL_LOAD_START = "2023-01-01"

# Monitor thresholds.
ROW_COUNT_SIGMAS = 3
ROW_COUNT_DROP = 0.5
NULL_RATE_INCREASE_POINTS = 5
MAX_DATA_AGE_HOURS = 24
SOURCE_WARN_HOURS, SOURCE_ERROR_HOURS = 24, 48
CRITICAL_COMPLETENESS = 0.99
CRITICAL_COLUMNS = ["unique_key", "created_date", "agency", "complaint_type", "borough"]

SLA_TARGET_FRACTION = 0.85
AGE_BUCKET_EDGES = [7, 30, 60, 90]
