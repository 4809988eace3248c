"""Results depend on these exact words, codes and numbers."""

# Text that stands for NULL inside a surrogate key.
KEY_NULL_TEXT = "_dbt_utils_surrogate_key_null_"

# Base temperature of heating and cooling degrees, in degrees Celsius.
DEGREE_BASE_C = 18.3

# Day part: label, first hour, last hour (both inclusive); every other hour is OFF_PEAK.
DAY_PARTS = [
    ("MORNING_PEAK", 6, 9),
    ("MIDDAY", 10, 16),
    ("EVENING_PEAK", 17, 21),
]
DAY_PART_DEFAULT = "OFF_PEAK"

# Temperature category: label, exclusive lower bound in degrees Celsius.
TEMPERATURE_BANDS = [
    ("HOT", 26.7),
    ("WARM", 15.6),
    ("MILD", 4.4),
    ("COLD", -6.7),
]
TEMPERATURE_BELOW_ALL = "VERY_COLD"
TEMPERATURE_MISSING = "UNKNOWN"

# Wind chill: coefficients and the range in which it applies.
WIND_CHILL_CONSTANT = 13.12
WIND_CHILL_TEMPERATURE = 0.6215
WIND_CHILL_WIND = 11.37
WIND_CHILL_CROSS = 0.3965
WIND_CHILL_EXPONENT = 0.16
WIND_CHILL_BELOW_C = 10.0
WIND_CHILL_ABOVE_WIND = 1.3

# Meteorological seasons of the northern hemisphere.
SEASONS = [
    ("Winter", [12, 1, 2]),
    ("Spring", [3, 4, 5]),
    ("Summer", [6, 7, 8]),
    ("Fall", [9, 10, 11]),
]

# Holidays on a fixed day: month, day.
FIXED_HOLIDAYS = [(1, 1), (7, 4), (12, 25)]
# Holiday on a weekday of a month: month, day of week (0 is Sunday), days after the first of the month.
FLOATING_HOLIDAY = (11, 4)
FLOATING_HOLIDAY_OFFSETS = (22, 28)

# Fuels by flag.
RENEWABLE_FUELS = ["SUN", "SPV", "REN", "WND", "HYC", "DPV"]
FOSSIL_FUELS = ["COW", "NG", "NGO", "PET", "PEL"]
NUCLEAR_FUEL = "NUC"
ALL_FUELS = "ALL"

# Unit of generation that is scaled to MWh.
THOUSAND_MWH_UNIT = "thousand megawatthours"

# Fuel attributes: fuel, category, kg CO2 per MWh, dispatchable.
FUEL_ATTRIBUTES = [
    ("COW", "Coal", 1000, True),
    ("NG", "Natural Gas", 450, True),
    ("NGO", "Natural Gas & Other", 450, True),
    ("NUC", "Nuclear", 10, False),
    ("PET", "Petroleum", 800, True),
    ("PEL", "Petroleum Liquids", 800, True),
    ("HYC", "Hydroelectric", 0, True),
    ("WWW", "Wood & Waste", None, None),
    ("SUN", "Solar", 0, False),
    ("SPV", "Solar Photovoltaic", 0, False),
    ("WND", "Wind", 0, False),
    ("GEO", "Geothermal", 0, None),
    ("OTH", "Other", None, None),
    ("REN", "Renewables", None, None),
    ("DPV", "Distributed Solar", None, None),
    ("ALL", "All Sources", None, None),
]

# Emission estimate of the generation mix: tons CO2 per MWh by fuel, 0 for every other fuel.
EMISSION_TONS_PER_MWH = [
    ("COW", 0.9),
    ("NG", 0.4),
    ("NGO", 0.4),
    ("PET", 0.75),
    ("PEL", 0.75),
]

# Known weather stations: id, latitude, longitude, elevation, name.
KNOWN_STATIONS = [
    ("723060-13722", 35.8801, -78.7880, 416, "Raleigh-Durham International Airport"),
    ("723140-13881", 35.2144, -80.9494, 748, "Charlotte Douglas International Airport"),
    ("723170-93807", 36.0977, -79.9437, 925, "Piedmont Triad International Airport"),
    ("723150-03812", 35.4361, -82.5375, 2165, "Asheville Regional Airport"),
    ("723013-13748", 34.2681, -77.9053, 32, "Wilmington International Airport"),
    ("723086-93759", 36.2605, -76.1747, 12, "Elizabeth City CGAS Airport"),
    ("722201-53871", 35.7111, -82.4878, 2170, "Asheville Mountain Research Station"),
]

# Counties: name, latitude range, longitude range (inclusive); the first match counts.
COUNTY_BOXES = [
    ("Forsyth", (35.43, 36.52), (-80.87, -80.02)),
    ("Mecklenburg", (35.11, 36.08), (-81.20, -80.56)),
    ("Wake", (35.72, 36.35), (-79.22, -78.28)),
    ("Brunswick", (34.09, 34.48), (-78.10, -77.70)),
    ("Buncombe", (35.43, 36.07), (-83.19, -82.17)),
]
COUNTY_MISSING = "Unknown County"
COUNTY_OTHER = "Other NC County"
STATE_NAME = "North Carolina"
STATE_CODE = "NC"
COUNTRY = "USA"

# Population in millions by location code.
POPULATION_MILLIONS = [("NC", 10.7), ("CPLE", 1.8), ("DUK", 2.7)]

# Names of balancing authorities; every other authority is named by its code.
AUTHORITY_NAMES = [("CPLE", "Duke Energy Progress East"), ("DUK", "Duke Energy Carolinas")]

# Location types and the geography level of each.
STATE_TYPE = "State"
STATION_TYPE = "Weather Station"
AUTHORITY_TYPE = "Balancing Authority"
GEOGRAPHY_LEVELS = [
    (AUTHORITY_TYPE, "Regional"),
    (STATE_TYPE, "State"),
    (STATION_TYPE, "Local"),
]
GEOGRAPHY_DEFAULT = "Unknown"

# Pairs of the bridge: authority code, station name.
BRIDGE_PAIRS = [
    ("DUK", "Charlotte Douglas International Airport"),
    ("CPLE", "Raleigh-Durham International Airport"),
]

# Validity bounds that stand for "always".
VALID_FROM_OPEN = "1900-01-01"
VALID_TO_OPEN = "9999-12-31"

# Demand states: label, percentile a reading must exceed, from the highest down.
DEMAND_STATES = [
    ("CRITICAL", 0.95),
    ("PEAK", 0.85),
    ("HIGH", 0.5),
    ("NORMAL", 0.25),
]
DEMAND_STATE_DEFAULT = "LOW"

# Trigger rules of a state change.
MORNING_RAMP_HOURS = (5, 9)
EVENING_PEAK_HOURS = (17, 21)
TRIGGER_HOT_C = 30.0
TRIGGER_COLD_C = 0.0

# Peak hours and extreme temperatures.
PEAK_RANK = 0.95
EXTREME_HOT_RANK = 0.9
EXTREME_COLD_RANK = 0.1

# Bands of daily mean temperature used for conditional demand averages.
HOT_DAY_ABOVE_C = 25.0
MILD_DAY_C = (15.0, 25.0)
COLD_DAY_BELOW_C = 5.0

# First load of cumulative patterns, in days.
INITIAL_LOAD_DAYS = 730

# Start of each feed when nothing has been loaded yet.
DEMAND_FEED_START = "2023-01-01 00:00:00"

# Fixed-width weather record: zero-based start, length.
ISD_FIELDS = {
    "usaf": (4, 6),
    "wban": (10, 5),
    "year": (15, 4),
    "month": (19, 2),
    "day": (21, 2),
    "hour": (23, 2),
    "minute": (25, 2),
    "temperature": (87, 5),
    "dew_point": (93, 5),
    "pressure": (99, 5),
}
ISD_WIND_STARTS = [65, 61, 69]
ISD_WIND_LENGTH = 5
ISD_LONGER_THAN = 105
ISD_SIGNED_MISSING = "+9999"
ISD_MISSING = "99999"
ISD_SCALE = 10.0
