"""Fixed values that results depend on. They are facts of the input data."""

# Mean Earth radius and kilometre-to-mile factor used for centroid distances.
EARTH_RADIUS_KM = 6371.0088
MILES_PER_KM = 0.621371192

# Industry sector code -> definition (2022 edition).
SECTOR_DEFINITIONS = [
    ("11", "Agriculture, Forestry, Fishing and Hunting"),
    ("21", "Mining, Quarrying, and Oil and Gas Extraction"),
    ("22", "Utilities"),
    ("23", "Construction"),
    ("31", "Manufacturing"),
    ("32", "Manufacturing"),
    ("33", "Manufacturing"),
    ("42", "Wholesale Trade"),
    ("44", "Retail Trade"),
    ("45", "Retail Trade"),
    ("48", "Transportation and Warehousing"),
    ("49", "Transportation and Warehousing"),
    ("51", "Information"),
    ("52", "Finance and Insurance"),
    ("53", "Real Estate and Rental and Leasing"),
    ("54", "Professional, Scientific, and Technical Services"),
    ("55", "Management of Companies and Enterprises"),
    ("56", "Administrative and Support and Waste Management and Remediation Services"),
    ("61", "Educational Services"),
    ("62", "Health Care and Social Assistance"),
    ("71", "Arts, Entertainment, and Recreation"),
    ("72", "Accommodation and Food Services"),
    ("81", "Other Services (except Public Administration)"),
    ("92", "Public Administration"),
    ("95", "Unknown"),
    ("99", "Unknown"),
]


# Suppression flag -> size-band columns it hides.
SUPPRESSION_BANDS = {
    "A": ["est<5", "est5_9", "est10_19"],
    "B": ["est20_49", "est50_99"],
    "C": ["est100_249"],
    "E": ["est250_499"],
    "F": ["est500_999"],
    "G": ["est1000_1500", "est1500_2500"],
    "H": ["est2500_5000"],
    "I": ["est>5000"],
}

# Business-pattern headers -> table columns.
BUSINESS_PATTERN_NAMES = {
    "naics": "naics_industry_code",
    "emp": "tot_employee_count",
    "ap": "annual_payroll",
    "est": "tot_establishment_count",
    "n1_4": "est<5",
    "n<5": "est<5",
    "n5_9": "est5_9",
    "n10_19": "est10_19",
    "n20_49": "est20_49",
    "n50_99": "est50_99",
    "n100_249": "est100_249",
    "n250_499": "est250_499",
    "n500_999": "est500_999",
    "n1000": "est>1000",
    "n1000_1": "est1000_1500",
    "n1000_2": "est1500_2500",
    "n1000_3": "est2500_5000",
    "n1000_4": "est>5000",
}

# State prefixes of the lower 48 states and DC.
MAINLAND_PREFIXES = [
    "01", "04", "05", "06", "08", "09", "10", "11", "12", "13",
    "16", "17", "18", "19", "20", "21", "22", "23", "24", "25",
    "26", "27", "28", "29", "30", "31", "32", "33", "34", "35",
    "36", "37", "38", "39", "40", "41", "42", "44", "45", "46",
    "47", "48", "49", "50", "51", "53", "54", "55", "56",
]


# Planning-region ids that do not match the older county ids.
NEW_REGION_IDS = [
    "09110", "09120", "09130", "09140", "09150", "09160", "09170", "09180", "09190",
]

# Independent city or synthetic id -> surrounding county id.
CITY_PARENTS = {
    "51510": "51013", "51515": "51019", "51520": "51191", "51530": "51163",
    "51540": "51003", "51550": "51131", "51560": "51005", "51570": "51053",
    "51580": "51005", "51590": "51143", "51595": "51081", "51600": "51059",
    "51610": "51059", "51620": "51175", "51630": "51177", "51640": "51035",
    "51650": "51095", "51660": "51165", "51670": "51149", "51678": "51163",
    "51680": "51031", "51683": "51153", "51685": "51153", "51690": "51089",
    "51700": "51095", "51710": "51095", "51720": "51195", "51730": "51053",
    "51735": "51199", "51740": "51095", "51750": "51121", "51760": "51087",
    "51770": "51161", "51775": "51161", "51790": "51015", "51800": "51131",
    "51810": "51131", "51820": "51015", "51830": "51095", "51840": "51069",
    "51901": "51003", "51903": "51005", "51907": "51015", "51911": "51031",
    "51913": "51035", "51918": "51053", "51919": "51059", "51921": "51069",
    "51923": "51081", "51929": "51089", "51931": "51095", "51933": "51121",
    "51939": "51143", "51941": "51149", "51942": "51153", "51944": "51161",
    "51945": "51163", "51947": "51165", "51949": "51175", "51951": "51177",
    "51953": "51191", "51955": "51195", "51958": "51199",
}

# Other children merged into a neighbouring county.
COUNTY_PARENTS = {
    "46113": "46102",
    "12025": "12086",
    "24510": "24005",
    "29510": "29189",
    "32510": "32005",
}

# Ids of the independent cities that keep a code of their own. 51560 is
# not among them: it gave up its charter and is a town of its county.
INDEPENDENT_CITIES = [
    "51510", "51515", "51520", "51530", "51540", "51550", "51570", "51580", "51590", "51595", "51600",
    "51610", "51620", "51630", "51640", "51650", "51660", "51670", "51678", "51680", "51683", "51685",
    "51690", "51700", "51710", "51720", "51730", "51735", "51740", "51750", "51760", "51770", "51775",
    "51790", "51800", "51810", "51820", "51830", "51840",
]
