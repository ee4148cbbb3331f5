"""Codes, patterns, lists and lookups that results depend on.

Everything here is plain data. Mappings that are longer or private to an installation (the product
key table, the own company's name, the exempt manager) are parameters of the jobs instead.
"""

from datetime import date

# --- Fixed values: validity and calendars
OPEN_END_DATE = date(9999, 12, 31)
#: Folders of stored histories: a timestamp column's name in them, followed by the unit that they cover.
FOLDERS = {"effective_end_ts": "effective", "appointment_start_datetime": "appointment", "early_start_time": "early"}
FOLDER_UNITS = ("month", "year")
CALENDAR_START = date(2022, 1, 1)
FIRST_TRAIN_END = date(2024, 3, 31)
DAILY_CUTOFF = date(2025, 3, 31)
SETTLE_DAYS = 11
MONTHLY_HORIZON = 18
MONTHLY_CONTEXT = 18
DAILY_HORIZON = 91
MOVING_AVERAGE_WINDOW = 183
SEASON_DAYS = 7
FOLD_COUNT = 4

# --- Fixed values: series dimensions
SERIES_DIMS = ("District", "Product", "Technology", "Work_Order_Action", "Work_Force")
DAILY_ATTRIBUTES = (
    "District", "Region_Type", "Product", "Product_Grp", "Technology", "Work_Order_Action",
    "Work_Order_Action_Grp", "Work_Force",
)

# --- Fixed values: codes in the upstream history tables
NAVIGATION_USAGE = "NAVIGATION_HIERARCHY"
DISPATCH_USAGE = "DISPATCH"
WORK_ORDER_ATTRIBUTES = ("PRODUCT_CATEGORY", "TECHNOLOGY", "SPECIAL_PROJECT", "SITE_ACCESS")
PROCESSING_STATES = (
    "IS_ASSIST", "IS_CONTINUATION", "IS_PULLAHEAD", "HAS_PULLAHEAD", "READY_FOR_DISPATCH", "PARENT",
    "PINNED", "PINNED_TO_CONTRACTOR", "IS_MULTIDAY",
)
JOB_ATTRIBUTES = ("DEMANDTYPE", "REBOOKREQ_IND", "MEGATASK_CALLID")
ASSIGNMENT_STATUSES = (
    "TENTATIVE", "DISPATCHED", "ACCEPTED", "REJECTED", "EN_ROUTE", "ON_SITE", "COMPLETE", "INCOMPLETE",
)
CLOSING_STATUSES = ("COMPLETE", "INCOMPLETE", "REJECTED")
SERVICE_TYPES = ("ACCOUNT", "CIRCUIT", "PHONE")
WORK_ORDER_CATEGORIES = ("DATA", "MM")
CANCELLED = "CANCELLED"
REJECTED = "REJECTED"
ASSIST_SOURCE_SYSTEM = "14184"

# --- Fixed values: address parts, without and with a municipality
SERVICE_ADDRESS = (
    "serv_addr_apt_no", "serv_addr_house", "serv_addr_street_name", "sa_city_province_code", "sa_postal_code",
)
CIVIC_ADDRESS = (
    "civic_number", "street_name_pre_type_cd", "street_nm", "street_name_post_type_cd", "municipality_nm",
    "province_state_cd", "postal_code_txt",
)

# --- Fixed values: regions and districts, as stored upstream and as corrected
REGION_REPAIRS = {"RÃ©seau - Affaire QuÃ©bec": "Réseau - Affaire Québec"}
SOURCE_DISTRICT_PATTERNS = ("%FFB%",)
SOURCE_DISTRICTS = ("CÃ´te-Nord - Nord du QuÃ©bec", "MontrÃ©al - QuÃ©bec", "BSL-GaspÃ©sie")
DISTRICT_PATTERNS = ("%FFB%", "%BUS%")
DISTRICTS = ("BSL-Gaspésie", "Côte-Nord - Nord du Québec", "Montréal - Québec")
HOME_PROVINCE = "QC"
WESTERN_PROVINCES = ("AB", "BC")

# --- Fixed values: work class by text in the service name, first match wins
WORK_CLASS_PATTERNS = (
    ("%ONCALL%", "On Call"), ("%ON-CALL%", "On Call"), ("%ANALYZER%", "Analyzer"),
    ("%FIELD_ANALYTICS%", "Analyzer"), ("%CO_WORK%", "CO Work"), ("%CO_TASK%", "CO Work"),
    ("%PRESTAGE%", "Prestage"), ("%FILLER%%", "Filler"), ("%SPAN%", "SPAN"), ("%WLNGM%", "NGM"),
    ("%NGM-%", "NGM"), ("%NGM_%", "NGM"), ("%NGM%", "NGM"), ("%NBD_INTERNAL_WORK%", "NBD_Internal_Work"),
)
DEFAULT_WORK_CLASS = "BAU"
PRESTAGE_CLASS = "Prestage"
DROPPED_WORK_CLASSES = ("Analyzer", "SPAN", "NBD_Internal_Work", "On Call")

# --- Fixed values: contractors
EASTERN_SPLIT_COMPANY = "Activo"
EASTERN_SPLIT_LABEL = "Activo (East)"
EASTERN_SPLIT_EXEMPT = "%SMB T%"
HOME_DROPPED_COMPANIES = ("ADT", "Activo", "CNI", "ATI")
AWAY_KEPT_CONTRACTORS = ("Activo", "LTS", "CNI", "Activo (East)")
HOME_EXCLUDED_COMPANIES = ("ADT", "CNI", "Activo")
WESTERN_DROPPED_TECHNICIANS = "%Z% Activo%"
DROPPED_WORK_FORCES = ("QX", "Go Sales")

# --- Fixed values: special projects, compared in upper case
PROJECT_NAMES = ("BCONN MULTIPORT ATA", "SMP MIGRATION")
PROJECT_PATTERNS = ("CUISSS%", "CIUSSS%", "WIFI RITM%", "C2F%")
MANAGED_PROJECT_PATTERN = "NBD SPECIAL PROJECT 1%"
COMPANY_PROJECT = "GOC WCS"
EXCLUDED_PROJECT_PATTERN = "AHS ETTS SCHC%"

# --- Fixed values: actions by job type prefix and by action code
ACTION_JOB_TYPES = (("PRE_STAGE%", "PRESTAGE"), ("PREFIELD%", "PREFIELD"))
ACTION_CODES = (
    ("PREFIELD", ("PREV",)),
    ("CHANGE", ("C", "CH", "MAC", "RG")),
    ("INSTALL", ("I", "PR", "INST", "DEPL", "KOFF", "HCUT", "POST", "SSURV", "PREP")),
    ("MOVE", ("F", "T", "PV")),
    ("REPAIR", ("R",)),
    ("RISER", ("RSR",)),
    ("OUT", ("O", "PICKUP", "DEPROG", "D", "CE")),
)
TROUBLE = "TROUBLE"
ACTION_GROUPS = {
    "INSTALL": "Install", "PRESTAGE": "Install", "PREFIELD": "Install", "RISER": "Install",
    "CHANGE": "MAC & Out", "MOVE": "MAC & Out", "OUT": "MAC & Out", "REPAIR": "Repair",
    "PROJECT": "PROJECT", "EXCLUDE": "EXCLUDE", "PROJECT (EXCLUDE)": "PROJECT (EXCLUDE)",
}
SERIES_EXCLUDED_ACTION_GROUPS = ("EXCLUDE", "PROJECT (EXCLUDE)", "PROJECT", "OTHER")
CUBE_EXCLUDED_ACTION_GROUPS = ("EXCLUDE", "PROJECT (EXCLUDE)", "OTHER")
OTHER = "OTHER"

# --- Fixed values: product groups outside and inside the home province
PRODUCT_GROUPS_AWAY = {
    "BUSINESS INTERNET": "Managed BI", "CARRIER ETHERNET": "Managed CES", "MANAGED LAN": "Managed Legacy",
    "PRIVATE LINE": "Managed Legacy", "SD WAN": "Managed WAN", "WAN L2_L3": "Managed WAN",
    "WAVELENGTH": "Managed WAN", "BUSINESS CONNECT": "Unmanaged 3rd Wave", "CENTREX": "Unmanaged Legacy",
    "HHM": "Unmanaged 3rd Wave", "HSIA": "Unmanaged", "IPTV": "Unmanaged", "MPAAS": "Unmanaged MPAAS",
    "NAAS": "Unmanaged 3rd Wave", "POTS": "Unmanaged", "SDS WIFI": "Unmanaged 3rd Wave",
    "SECURITY": "Unmanaged 3rd Wave", "TRUE STATIC IP": "Unmanaged 3rd Wave", "WHSIA": "Unmanaged",
    "WIFI": "Unmanaged Legacy",
}
PRODUCT_GROUPS_HOME = {
    "IOT MODEM": "Unmanaged", "CPS": "Managed CPS", "BUSINESS CONNECT": "Managed 3rd Wave",
    "BUSINESS INTERNET": "Managed BI", "CARRIER ETHERNET": "Managed CES", "MANAGED LAN": "Managed Legacy",
    "MPAAS": "Managed MPAAS", "NAAS": "Managed 3rd Wave", "PRIVATE LINE": "Managed Legacy",
    "SD WAN": "Managed WAN", "WAN L2_L3": "Managed WAN", "HSIA": "Unmanaged", "POTS": "Unmanaged",
    "SECURITY": "Unmanaged 3rd Wave", "WIFI": "Unmanaged Legacy",
}
# Holds everywhere when the fact is built, outside the home province only in the stand-alone lookup.
PRODUCT_GROUPS_ANYWHERE_IN_FACT = ("SDS WIFI",)

# --- Fixed values: product families of the efficiency rules
MANAGED_AWAY = (
    "BUSINESS INTERNET", "CARRIER ETHERNET", "MANAGED LAN", "PRIVATE LINE", "SD WAN", "WAN L2_L3", "WAVELENGTH",
)
MANAGED_HOME = (
    "CPS", "BUSINESS CONNECT", "CARRIER ETHERNET", "MANAGED LAN", "MPAAS", "NAAS", "PRIVATE LINE", "SD WAN",
    "WAN L2_L3",
)
UNMANAGED_AWAY = (
    "BUSINESS CONNECT", "CENTREX", "HHM", "HSIA", "IPTV", "MPAAS", "NAAS", "POTS", "SDS WIFI", "SECURITY",
    "TRUE STATIC IP", "WHSIA", "WIFI",
)
UNMANAGED_HOME = ("IOT MODEM", "HSIA", "POTS", "SECURITY", "WIFI")
ALL_PRODUCTS = (
    "BUSINESS CONNECT", "HSIA", "IPTV", "POTS", "SDS WIFI", "SECURITY", "WIFI", "CENTREX", "MPAAS", "NAAS",
    "HHM", "WHSIA", "TRUE STATIC IP", "BUSINESS INTERNET", "CARRIER ETHERNET", "WAN L2_L3", "PRIVATE LINE",
    "MANAGED LAN", "WAVELENGTH", "SD WAN", "IOT MODEM", "CPS",
)
ALL_JOB_TYPES_RULE = "All (Excluding Projects)"
ALL_JOB_TYPES = ("INSTALL", "PREFIELD", "RISER", "PRESTAGE", "REPAIR", "CHANGE", "MOVE", "OUT")

# --- Fixed values: scopes of the efficiency rules
SCOPE_ALL = "All"
SCOPE_TIER_PATTERN = "Tier%"
SCOPE_PROVINCES = ("AB", "BC", "MB", "NB", "NL", "NS", "ON", "QC", "PE", "SK", "YT")
SCOPE_TERRITORIES = "NU & NT"
TERRITORIES = ("NT", "NU")

# --- Fixed values: classes of the special projects
PROJECT_MANAGED_PRODUCTS = (
    "BUSINESS INTERNET", "CARRIER ETHERNET", "MANAGED LAN", "PRIVATE LINE", "SD WAN", "WAN L2_L3", "WAVELENGTH",
    "CPS", "MPAAS",
)
PROJECT_UNMANAGED_PRODUCTS = (
    "BUSINESS CONNECT", "CENTREX", "HHM", "HSIA", "IPTV", "NAAS", "POTS", "SDS WIFI", "SECURITY",
    "TRUE STATIC IP", "WHSIA", "WIFI", "IOT MODEM",
)
PROJECT_EXCLUDING_NOTES = "%EXCLUDE%"

# --- Fixed values: names of the same product in work orders and in unit volumes
PRODUCT_NAMES = {
    "SECURITY": "Secure Business",
    "HSIA": "-HSIA Non-Hospitality",
    "PRIVATE LINE": "PRI",
    "WAN L2_L3": "Internetworking",
    "BUSINESS INTERNET": "Business Internet",
    "SDS WIFI": "Wi-Fi (Meraki)",
    "POTS": "Local Access",
    "BUSINESS CONNECT": "Business Connect",
    "MPAAS": "SD-WAN (MPasS)",
    "IPTV": "-BTV Non-Hospitality",
    "WIFI": "-Wi-Fi Non-Hospitality",
    "CENTREX": "Centrex",
    "NAAS": "SD-WAN (NaaS)",
    "SD WAN": "SD-WAN (Viptella/Velocloud)",
}

# --- Fixed values: unit volumes and their correction
VOLUME_TYPE = "Gross Adds"
CORRECTED_ACTION = "INSTALL"
CORRECTION_LAGS = (1,)
CORRECTION_ALPHAS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
TUNING_VERSIONS_BACK = 5

# --- Fixed values: scoring
SCORED_TIERS = ("Tier 1", "Tier 2", "Tier 3")
WAPE_EPSILON = 1e-8

# --- Fixed values: tier of each district
DISTRICT_TIERS = {
    "FFB - Calgary": "Tier 1",
    "FFB - Edmonton": "Tier 1",
    "FFB - LML Metro": "Tier 1",
    "FFB - LML Valley": "Tier 1",
    "FFB - Fort McMurray": "Tier 2",
    "FFB - Fort St John Dawson Creek": "Tier 2",
    "FFB - Grande Prairie": "Tier 2",
    "FFB - Kamloops": "Tier 2",
    "FFB - Lethbridge": "Tier 2",
    "FFB - Manitoba": "Tier 2",
    "FFB - Medicine Hat": "Tier 2",
    "FFB - Nova Scotia": "Tier 2",
    "FFB - Okanagan": "Tier 2",
    "FFB - Ontario": "Tier 2",
    "FFB - Prince George": "Tier 2",
    "FFB - Red Deer": "Tier 2",
    "FFB - Saskatchewan": "Tier 2",
    "FFB - Vancouver Island North": "Tier 2",
    "FFB - Vancouver Island South": "Tier 2",
    "Montréal - Québec": "Tier 2",
    "FFB - Athabasca Lac La Biche": "Tier 3",
    "FFB - Bonnyville Cold Lake": "Tier 3",
    "FFB - Edson Hinton": "Tier 3",
    "FFB - High Level": "Tier 3",
    "FFB - Kootenay Cranbrook": "Tier 3",
    "FFB - Kootenay Golden": "Tier 3",
    "FFB - Kootenay Nelson": "Tier 3",
    "FFB - Lloydminster Wainright": "Tier 3",
    "FFB - New Brunswick": "Tier 3",
    "FFB - Newfoundland": "Tier 3",
    "FFB - Northwest Territories and Nunavut": "Tier 3",
    "FFB - Peace River High Prairie": "Tier 3",
    "FFB - Prince Edward Island": "Tier 3",
    "FFB - Sea to Sky": "Tier 3",
    "FFB - Slave Lake": "Tier 3",
    "FFB - Sunshine Coast": "Tier 3",
    "FFB - Terrace Smithers": "Tier 3",
    "FFB - Whitecourt": "Tier 3",
    "FFB - Williams Lake 100 Mile House": "Tier 3",
    "FFB - Yukon": "Tier 3",
    "BSL-Gaspésie": "Tier 3",
    "Côte-Nord - Nord du Québec": "Tier 3",
}
