"""Word lists of the detectors.

Fixed values: every list below is compared with cells as it stands, misspelt
and fused entries included.  Corrections are additions, made on request only.
The neighbourhood list is long and local, so it is a parameter: a list, or a table of
any length such as :func:`names_table` reads.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Lists become literals of the plan, so their length is bounded; longer ones are tables.
MAX_NAMES = 5_000

# Substrings looked for in lower-cased cells.
SCHOOL_NAME_WORDS = ("school", "academy")
STREET_NAME_WORDS = ("avenue", "lane", "road", "boulevard", "drive", "street", "ave", "dr", "rd", "blvd", "ln", "st")
COLLEGE_NAME_WORDS = ("college", "university")
PARK_WORDS = ("park",)
BUSINESS_NAME_WORDS = ("corp", "inc", "llc", "ltd")
CITY_AGENCY_WORDS = (
    "system", "tribunal", "agency", "library", "council", "board", "commission", "president",
    "services", "office", "department", "nyc", "administration", "authority",
)
SCHOOL_LEVEL_WORDS = (
    "elementary", "kindergarten", "middle", "nursery", "primary", "secondary", "senior", "high",
    "transfer", "k-2", "k-3", "k-8",
)

# Lower-cased school subjects.
SUBJECTS = (
    "algebra", "art", "biology", "calculus", "chemistry", "cinema", "composition", "craft",
    "drawing", "economics", "economy", "english", "arts", "geography", "geometry", "gym",
    "history", "humanities", "language", "literature", "math", "mathematics", "music", "painting",
    "physical development", "physics", "science", "social science", "social studies", "statistics",
)

# Lower-cased areas of study ("animal ccience" is spelt so).
AREAS_OF_STUDY = (
    "engineering", "teaching", "communications", "animal ccience", "science & math",
    "law & government", "architecture", "business", "culinary arts", "performing arts",
    "health profession", "visual art & design", "film/video", "cosmetology",
    "humanities & interdisciplinary", "computer science & technology", "project-based learning",
    "hospitality, travel, & tourism", "performing arts/visual art & design",
    "environmental science", "zoned",
)

# Car makes and models, upper case ("BMW  7 SERIES" has two blanks).
CAR_MAKES = (
    "MERCEDES-BENZ S550", "LEXUS ES 330", "TOYOTA AVALON", "HYUNDAI EQUUS", "FORD FUSION",
    "GMC YUKON DINALI", "AUDI Q5", "LINCOLN MKZ", "HYUNDAI SONATA", "MERCEDES-BENZ E350",
    "FORD FREESTAR", "MERCEDES-BENZ SPRINTER", "CADILLAC ESCALADE", "MERCURY MONTEREY",
    "ACURA MDX", "DODGE SPRINTER", "CADILLAC XTS", "MERCEDES-BENZ GL CLASS", "GMC YUKON",
    "LEXUS RX 350", "NISSAN QUEST", "HONDA ACCORD", "CHEVROLET SUBURBAN", "FORD EXPLORER",
    "TOYOTA VENZA", "GMC DENALI", "NISSAN ROGUE", "FORD", "AUDI Q7", "TOYOTA HIGHLANDER",
    "LEXUS RX 400H", "TOYOTA COROLLA", "CHEVROLET CRUZE", "CHEVROLET TRAILBLAZER",
    "FORD WINDSTAR", "BMW  7 SERIES", "HONDA PILOT", "CADILLAC ESCALADE ESV",
    "VOLKSWAGEN ROUTAN", "FORD FREESTYLE", "LEXUS GX 460",
    "CHRYSLER TOWN AND COUNTRY,TOYOTA HIGHLANDER", "GMC YUKON XL", "HONDA CR-V",
    "LINCOLN NAVIGATOR", "UNKNOWN", "CHRYSLER 300", "CHRYSLER TOWN AND COUNTRY",
    "CHEVROLET MALIBU", "DODGE CHARGER", "FORD E350", "CHEVROLET LUMINA", "FORD TAURUS WAGON",
    "JAGUAR XJ SERIES", "CHRYSLER TOWN AND COUNTRY,LINCOLN TOWN CAR,", "LEXUS LS 460",
    "DODGE DURANGO", "FORD FUSION SE", "MERCEDES-BENZ E-CLASS", "FORD ESCAPE", "NISSAN NV200",
    "BMW 5 SERIES", "HONDA ODYSSEY", "NISSAN PATHFINDER", "LINCOLN MKT", "TOYOTA RAV4",
    "LINCOLN TOWN CAR", "TOYOTA CAMRY", "FORD EXPEDITION", "BMW 7-SERIES",
    "FORD CROWN VICTORIA", "CHEVROLET EXPRESS,GMC YUKON XL", "DODGE CARAVAN",
    "TOYOTA PRIUS V", "HONDA ODYSSEY,LINCOLN TOWN CAR,TOYOTA HIGHLANDER", "NISSAN SENTRA",
    "CHEVROLET EXPRESS LT 3500", "MITSUBISHI MONTERO", "GMC YUKON DENALI",
    "JEEP GRAND CHEROKEE LAREDO", "FORD FLEX", "FORD ESCAPE,FORD FUSION,HONDA ODYSSEY",
    "TOYOTA PRIUS", "MERCEDES-BENZ S-CLASS", "TOYOTA SIENNA", "HYUNDAI VERACRUZ",
    "MERCEDES-BENZ S350", "NISSAN VERSA", "FORD TAURUS", "LEXUS ES 350", "MERCEDES-BENZ R350",
    "LINCOLN MKS", "MERCURY GRAND MARQUIS", "CHRYSLER PACIFICA", "MERCEDES BENZ SPRINTER",
    "FORD EXCURSION", "FORD ESCAPE XLS 4WD", "FORD C-MAX", "CHEVROLET TAHOE",
    "CHEVROLET UPLANDER", "MERCEDES-BENZ", "CADILLAC DTS", "NISSAN ALTIMA",
    "CHRYSLER SEBRING", "FORD FIVE HUNDRED", "CHEVROLET IMPALA", "FORD EDGE", "MAZDA MAZDA5",
)

# Location types, upper case ("FAST FOODGROCERY/BODEGA" is fused so).
LOCATION_TYPES = (
    "STORE UNCLASSIFIED", "PARK/PLAYGROUND", "SOCIAL CLUB/POLICY", "BUS STOP",
    "HOMELESS SHELTER", "AIRPORT TERMINAL", "TRANSIT - NYC SUBWAY", "PHOTO/COPY",
    "CLOTHING/BOUTIQUE", "CANDY STORE", "MARINA/PIER", "BUS TERMINAL", "COMMERCIAL BUILDING",
    "PARKING LOT/GARAGE (PRIVATE)", "TRAMWAY", "GAS STATION", "LOAN COMPANY", "ATM",
    "PUBLIC SCHOOL", "BAR/NIGHT CLUB", "RESIDENCE-HOUSE", "BOOK/CARD", "BEAUTY & NAIL SALON",
    "FOOD SUPERMARKET", "BUS (NYC TRANSIT)", "HIGHWAY/PARKWAY", "SHOE", "STORAGE FACILITY",
    "CHAIN STORE", "PRIVATE/PAROCHIAL SCHOOL", "ABANDONED BUILDING", "SYNAGOGUE", "CEMETERY",
    "FACTORY/WAREHOUSE", "TUNNEL", "HOTEL/MOTEL", "SMALL MERCHANT", "MAILBOX OUTSIDE",
    "TAXI (YELLOW LICENSED)", "RESIDENCE - APT. HOUSE", "CONSTRUCTION SITE", "MAILBOX INSIDE",
    "VIDEO STORE", "PARKING LOT/GARAGE (PUBLIC)", "CHECK CASHING BUSINESS", "VARIETY STORE",
    "STREET", "LIQUOR STORE", "BUS (OTHER)", "PUBLIC BUILDING", "JEWELRY", "RESTAURANT/DINER",
    "OPEN AREAS (OPEN LOTS)", "HOSPITAL", "DAYCARE FACILITY", "TELECOMM. STORE", "MOSQUE",
    "DEPARTMENT STORE", "BANK", "TAXI/LIVERY (UNLICENSED)", "DRY CLEANER/LAUNDRY",
    "TAXI (LIVERY LICENSED)", "TRANSIT FACILITY (OTHER)", "FAST FOODGROCERY/BODEGA", "BRIDGE",
    "DRUG STORE", "FERRY/FERRY TERMINAL", "OTHER HOUSE OF WORSHIP",
    "RESIDENCE - PUBLIC HOUSING", "OTHER", "GYM/FITNESS FACILITY", "DOCTOR/DENTIST OFFICE",
    "CHURCH",
)

# Colours, upper case.
COLORS = (
    "JADE", "RED", "RED APPLE PIN", "WHITE", "BLACK", "4 - COLOR LOGO", "BLACK AND BLACK",
    "GOLD APPLE PIN", "GREEN", "GRAY", "HUNTER GREEN", "ROYAL BLUE", "SILVER", "GOLD",
    "MULTICOLOR", "NAVY", "BLUE PERIWINKLE", "BROWN", "BLACK AND GOLD", "CLEAR",
    "GREEN APPLE PIN", "TURQUOISE", "NAVY WITH ORANGE LOGO", "BLUE", "PINK", "ORANGE",
    "NAVY WITH WHITE LOGO",
)

# Additions of fix_vocab=True.
FIXED_AREAS_OF_STUDY = ("animal science",)
FIXED_LOCATION_TYPES = ("FAST FOOD", "GROCERY/BODEGA")


def names_table(spark: SparkSession, path: str) -> DataFrame:
    """Names from text files, one a line, trimmed and in lower case: a table for a membership detector."""
    return spark.read.text(path).select(F.lower(F.trim("value")).alias("name")).where("name <> ''").distinct()


def load_names(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The same as a list, for short files.  The read is cut at the bound plus one, so a wrong path cannot flood the driver."""
    rows = names_table(spark, path).limit(MAX_NAMES + 1).collect()
    if len(rows) > MAX_NAMES:
        raise ValueError(f"more than {MAX_NAMES} names: use them as a table")
    return tuple(sorted(r.name for r in rows))
