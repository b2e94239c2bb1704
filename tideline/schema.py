"""Schemas, catalog and constants shared by all modules."""

from __future__ import annotations

# Raw time columns in the order they are tried, and per-instrument overrides.
TIME_ALIASES = ["System Date and Time", "timestamp", "Timestamp", "NMEA_UTC_(Time)"]
PREFERRED_TIME_COLUMN = {"Ferrybox_CTD": "dataTimestamp"}

# Folders the format audit passes over, and types of raw files that are converted to tables.
SKIPPED_INSTRUMENTS = ["GPS-MERGED-SOURCES", "EK80-RAW", "EK80_echos_ncdf"]
CONVERTED_TYPES = [".zip", ".json", ".csv", ".cnv"]

# Position sources, highest priority first.
POSITION_SOURCES = ["GGA", "EK80_gps", "Ferrybox", "Bridge"]

# Hydrophone serial numbers and the instruments of each experiment.
HYDROPHONE_SERIALS = ["6952", "6954", "6955", "7526"]
INSTRUMENTS = {
    "NAVIGATION": ["GGA", "HDT", "SXN23", "VTG", "ZDA", "GPS-MERGED-SOURCES"],
    "OCEANOGRAPHY": ["Ferrybox_CTD", "Seabird_CTD"],
    "ACOUSTIC": ["EK80-RAW", "EK80_echos_csv", "EK80_echos_ncdf", "EK80_CP300-ADCP"]
    + [f"Hydrophone_{serial}" for serial in HYDROPHONE_SERIALS],
    "METEOROLOGY": ["GMX300", "GMX560", "Lufft_WS100-1", "Gill_2310037-WC76"],
    "RADIATION": ["Apogee_SI431", "Apogee_SQ522"],
}

# Thresholds of the processing rules.
GAP_THRESHOLD_MINUTES = 1.0
GAP_THRESHOLD_MINUTES_BY_INSTRUMENT = {"GPS-MERGED-SOURCES": 15.0}
GGA_GAP_FILL_THRESHOLD_MINUTES = 0.06
BRIDGE_GAP_FILL_THRESHOLD_MINUTES = 10.0
PRESSURE_BUFFER_MINUTES = 15.0
HAMPEL_WINDOW_MINUTES = 10.0
HAMPEL_SIGMAS = 3.0
MAD_TO_SIGMA = 1.4826
GEOTAG_TOLERANCE_S = 1.0
NAVIGATION_TOLERANCE_S = 2.0
VELOCITY_HALF_WINDOW_S = 30.0
GEOTAGGED_INTERVALS = ["1min", "3min", "5min", "1h", "1D"]
PLAIN_INTERVALS = ["1min", "3min", "5min"]
COMBINED_INTERVALS = ["1D", "1h", "5min"]

# Columns with special treatment.
OPTICAL_COLUMNS = ["trilux_chlorophyll", "trilux_phycoerythrin", "trilux_turbidity"]
SPIKE_EXCLUDED_NAMES = ["lat", "lon", "pressure"]
LEVEL_PREFIXES = ["level_", "spec_"]
CATEGORY_COLUMNS = {"Lufft_WS100-1": "precipitation_type"}
FERRYBOX = ("OCEANOGRAPHY", "Ferrybox_CTD")
WIND_INSTRUMENT = ("METEOROLOGY", "Gill_2310037-WC76")

# WMO code table 4680 (present weather from an automatic station).
WEATHER_CODES = {
    0: "No precipitation",
    1: "Clouds dissolving or becoming less developed (past hour)",
    2: "State of sky unchanged (past hour)",
    3: "Clouds forming or developing (past hour)",
    4: "Haze, smoke or dust, visibility >= 1 km",
    5: "Haze, smoke or dust, visibility < 1 km",
    10: "Mist",
    11: "Diamond dust",
    12: "Distant lightning",
    18: "Squalls",
    20: "Fog (past hour)",
    21: "Precipitation (past hour)",
    22: "Drizzle (not freezing) or snow grains (past hour)",
    23: "Rain (not freezing) (past hour)",
    24: "Snow (past hour)",
    25: "Freezing drizzle or freezing rain (past hour)",
    26: "Thunderstorm (past hour)",
    27: "Blowing or drifting snow or sand",
    28: "Blowing or drifting snow or sand, visibility >= 1 km",
    29: "Blowing or drifting snow or sand, visibility < 1 km",
    30: "Fog",
    31: "Fog or ice fog in patches",
    32: "Fog or ice fog, thinner",
    33: "Fog or ice fog, no change",
    34: "Fog or ice fog, thicker",
    35: "Fog, depositing rime",
    40: "Precipitation",
    41: "Precipitation, slight or moderate",
    42: "Precipitation, heavy",
    43: "Liquid precipitation, slight or moderate",
    44: "Liquid precipitation, heavy",
    45: "Solid precipitation, slight or moderate",
    46: "Solid precipitation, heavy",
    47: "Freezing precipitation, slight or moderate",
    48: "Freezing precipitation, heavy",
    50: "Drizzle",
    51: "Drizzle, not freezing, slight",
    52: "Drizzle, not freezing, moderate",
    53: "Drizzle, not freezing, heavy",
    54: "Drizzle, freezing, slight",
    55: "Drizzle, freezing, moderate",
    56: "Drizzle, freezing, heavy",
    57: "Drizzle and rain, slight",
    58: "Drizzle and rain, moderate or heavy",
    60: "Rain",
    61: "Rain, not freezing, slight",
    62: "Rain, not freezing, moderate",
    63: "Rain, not freezing, heavy",
    64: "Rain, freezing, slight",
    65: "Rain, freezing, moderate",
    66: "Rain, freezing, heavy",
    67: "Rain (or drizzle) and snow, slight",
    68: "Rain (or drizzle) and snow, moderate or heavy",
    69: "Rain, drizzle, Snow",
    70: "Snow",
    71: "Snow, slight",
    72: "Snow, moderate",
    73: "Snow, heavy",
    74: "Ice pellets, slight",
    75: "Ice pellets, moderate",
    76: "Ice pellets, heavy",
    77: "Snow grains",
    78: "Ice crystals",
    80: "Showers or intermittent precipitation",
    81: "Rain showers, slight",
    82: "Rain showers, moderate",
    83: "Rain showers, heavy",
    84: "Rain showers, violent",
    85: "Snow showers, slight",
    86: "Snow showers, moderate",
    87: "Snow showers, heavy",
    89: "Hail",
    90: "Thunderstorm",
    91: "Thunderstorm, slight or moderate, no precipitation",
    92: "Thunderstorm, slight or moderate, rain and/or snow showers",
    93: "Thunderstorm, slight or moderate, hail",
    94: "Thunderstorm, heavy, no precipitation",
    95: "Thunderstorm, heavy, rain and/or snow showers",
    96: "Thunderstorm, heavy, hail",
    99: "Tornado",
}
