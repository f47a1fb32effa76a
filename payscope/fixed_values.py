"""Word lists, literals and patterns the features are defined by.

Everything here has to equal the published feature definitions exactly, byte for byte
(including en dashes and the ``CARSAND`` spelling), so it is kept in one place as plain text.
Patterns use the common subset of Java and RE2 syntax.
"""

# --- payer name -----------------------------------------------------------------------------
NAME_COMPANY_PATTERN = (
    r"\b(LLC|L\.L\.C|LLP|L\.L\.P|INC\.?|CORP\.?|LTD\.?|LIMITED|COMPANY|CO\.?|GMBH|PLC|S\.A\.?"
    r"|A\.G\.?|N\.V\.?|PVT\. LTD\.?|PTY\. LTD\.?)\b"
)
# plain texts of which every match of the pattern contains one
NAME_COMPANY_NEEDS = (
    "LLC", "L.L.C", "LLP", "L.L.P", "INC", "LTD", "LIMITED", "CO", "GMBH", "PLC", "S.A", "A.G",
    "N.V",
)
NAME_TEST_LITERALS = (
    "test", "testing", "test test", "john doe", "jane doe", "john smith", "test user", "user test",
    "demo", "sample", "user", "customer", "anonymous", "admin", "administrator",
)
NAME_TEST_WORDS = ("test", "dummy", "fake", "sample", "demo")
NAME_SPECIAL_PATTERN = r"[^A-Za-z0-9\s\.,\-\']"
KEYBOARD_RUNS = ("asdf", "qwer", "zxcv", "1234", "wasd")

# --- address --------------------------------------------------------------------------------
ADDRESS_PO_BOX_PATTERN = r"\b(PO BOX|P\.O\. BOX|POST OFFICE BOX|POBOX)\b|\bBOX\s+\d"
ADDRESS_TEST_WORDS = ("test", "dummy", "fake", "sample", "demo", "123 main", "example")
ADDRESS_GENERIC_PATTERN = r"^\d{1,4}\s+MAIN ST\b"
ADDRESS_INVALID_PATTERN = r"[^A-Za-z0-9\s\.,#/&-]"
ADDRESS_RISK_STATES = ("DELAWARE", "DE", "NEVADA", "NV", "WYOMING", "WY", "SOUTH DAKOTA", "SD")
ADDRESS_VIRTUAL_OFFICE_PATTERN = (
    r"\b(regus|virtual|spaces|wework|office suite|intelligent office|suite \d{1,4}[A-Z]?)\b"
)
ADDRESS_VIRTUAL_OFFICE_NEEDS = (
    "regus", "virtual", "spaces", "wework", "suite", "intelligent office",
)
ADDRESS_ZIP_PATTERN = r"\b\d{5}(-\d{4})?\b"
ADDRESS_COMPANY_PATTERN = r"\b(LLC|LLP|INC|INC\.|CORP|CORP\.|LTD|LTD\.|LIMITED|COMPANY)\b"
ADDRESS_COMPANY_NEEDS = ("LLC", "LLP", "INC", "CORP", "LTD", "LIMITED", "COMPANY")

# --- email ----------------------------------------------------------------------------------
EMAIL_FORMAT_PATTERN = r"^[^@]+@[^@]+\.[^@]+\z"
EMAIL_COMPANY_WORDS = (
    "COMPANY", "CORP", "INC", "LLC", "LLP", "LTD", "GMBH", "PLC", "ENTERPRISE", "BUSINESS",
    "CORPORATE", "INDUSTRY", "TECHNOLOGIES",
)
EMAIL_FREE_DOMAINS = (
    "gmail.com", "yahoo.com", "hotmail.com", "outlook.com", "aol.com", "protonmail.com", "mail.com",
    "icloud.com", "zoho.com", "yandex.com", "gmx.com",
)
EMAIL_DISPOSABLE_DOMAINS = (
    "mailinator.com", "guerrillamail.com", "temp-mail.org", "10minutemail.com",
    "throwawaymail.com", "yopmail.com", "getnada.com", "dispostable.com", "sharklasers.com",
    "tempmail.net",
)
EMAIL_TEST_WORDS = ("test", "fake", "dummy", "sample", "example", "demo")
EMAIL_RUNS = ("123", "abc", "xyz", "qwerty", "asdf")
EMAIL_USER_SPECIAL_PATTERN = r"[^a-z0-9._-]"
EMAIL_ROLES = (
    "admin", "info", "sales", "support", "contact", "billing", "finance", "help", "service",
    "noreply",
)

# --- IP address -----------------------------------------------------------------------------
IP_V4_PATTERN = r"^([0-9]{1,3}\.){3}[0-9]{1,3}\z"
IP_PRIVATE_PATTERN = r"^10\.|^172\.(1[6-9]|2[0-9]|3[0-1])\.|^192\.168\."
IP_BUSINESS_PATTERN = (
    r"^(8\.8\.|13[0-9]\.|14[4-9]\.|15[0-9]\.|16[0-9]\.|17[0-2]\.|19[2-9]\.|20[0-9]\.|21[0-4]\.)"
)
IP_LOCALHOST_PATTERN = r"^127\."
IP_TEST_ADDRESSES = ("0.0.0.0", "1.1.1.1", "8.8.8.8", "8.8.4.4", "9.9.9.9")
IP_DIGIT_RUNS = (
    "1234", "2345", "3456", "4567", "5678", "6789", "9876", "8765", "7654", "6543", "5432", "4321",
    "0000",
)
# first octet, inclusive bounds
IP_CLASSES = (
    (1, 126, "Type 1"),
    (128, 191, "Type 2"),
    (192, 223, "Type 3"),
    (224, 239, "Type 4"),
    (240, 255, "Type 5"),
    (127, 127, "Loopback"),
)
IP_CLASS_UNKNOWN = "Unknown/Invalid"

# --- card number ----------------------------------------------------------------------------
CARD_BUSINESS_BINS = (
    "485913", "485924", "485916", "485923", "486229", "486494", "486496", "490806",
    "552356", "552455", "552456", "552503", "552571", "552721", "557169", "557200",
    "370728", "370729", "370710", "370711", "370712", "370713", "370714", "370715",
)
CARD_BUSINESS_PREFIXES = ("3770", "3771", "3772", "3773", "3774", "3775", "3776", "3777")
CARD_TEST_NUMBERS = (
    "4111111111111111", "4242424242424242", "5555555555554444", "378282246310005",
    "371449635398431", "6011111111111117", "5105105105105100", "30569309025904", "38520000023237",
)
CARD_REPEATED_RUNS = (
    "0000", "1111", "2222", "3333", "4444", "5555", "6666", "7777", "8888", "9999",
)
CARD_SEQUENTIAL_RUNS = (
    "1234", "2345", "3456", "4567", "5678", "6789", "9876", "8765", "7654", "6543", "5432", "4321",
)
CARD_KEYBOARD_RUNS = ("qwer", "asdf", "zxcv", "wasd")
CARD_ONE_DIGIT_PATTERN = r"^(0+|1+|2+|3+|4+|5+|6+|7+|8+|9+)\z"
# allowed digit counts per network
CARD_LENGTHS = {
    "Visa": (13, 16, 19),
    "Mastercard": (16,),
    "American Express": (15,),
    "Discover": (16,),
    "JCB": (15, 16),
    "Diners Club": (14, 16),
}
# one-hot column -> network
CARD_ONE_HOT = {
    "Is_Visa": "Visa",
    "Is_Mastercard": "Mastercard",
    "IS_AMEX": "American Express",
    "IS_DISCOVER": "Discover",
    "IS_JCB": "JCB",
    "IS_DinersClub": "Diners Club",
    "IS_Unknown": "Unknown",
}

# --- payment channel ------------------------------------------------------------------------
CHANNEL_GROUPS = {
    "Recurring Programs": ("AUTO PAY", "SCHEDULED PAYMENT", "RECURRING SCHEDULED PAYMENT"),
    "Web Self Service": (
        "SHOPPING CART", "CUSTOMER PORTAL", "EXPRESS PAYMENTS", "BILLER PORTAL",
        "BILLER PORTAL - EASY PAY",
    ),
    "Mobile & SMS": (
        "MOBILE EXPRESS PAYMENTS", "PAY BY TEXT", "CLOUD STORE - CONSUMER INITIATED",
    ),
    "API & Cloud Integrations": (
        "WEBSERVICES", "CLOUD PAYMENTS", "CLOUD STORE - BILLER INITIATED",
    ),
    "Telephony": ("IVR", "LIVE AGENT PAYMENT"),
    "Agent Assisted": ("CSR - ONE TIME PAY", "AGENT CONNECT"),
    "In Person": ("POS", "KIOSK"),
}
CHANNEL_GROUP_OTHER = "Other"
CHANNEL_BUSINESS = (
    "AGENT CONNECT", "LIVE AGENT PAYMENT", "CSR - ONE TIME PAY", "BILLER PORTAL",
    "BILLER PORTAL - EASY PAY", "WEBSERVICES", "CLOUD STORE - BILLER INITIATED", "POS", "KIOSK",
)
CHANNEL_CONSUMER = (
    "PAY BY TEXT", "SHOPPING CART", "MOBILE EXPRESS PAYMENTS", "CLOUD PAYMENTS", "CUSTOMER PORTAL",
    "AUTO PAY", "RECURRING SCHEDULED PAYMENT", "EXPRESS PAYMENTS", "IVR", "SCHEDULED PAYMENT",
    "CLOUD STORE - CONSUMER INITIATED",
)
CHANNEL_TEST_WORDS = ("TEST", "DUMMY", "SAMPLE", "DEMO", "DEV")
# letters and digits, white space, hyphen and underscore are fine; Java spelling of the POSIX class
CHANNEL_SPECIAL_PATTERN = r"[^\p{Alnum}\s\-_]"

# --- merchant category ----------------------------------------------------------------------
MCC_HIGH_RISK = (
    "INSURANCE SALES, UNDERWRITING, AND PREMIUMS",
    "POLITICAL ORGANIZATIONS",
    "COURT COSTS, INCLUDING ALIMONY AND CHILD SUPPORT",
    "PROTECTIVE AND SECURITY SERVICES – INCLUDING ARMORED CARSAND GUARD DOGS",
    "CHARITABLE AND SOCIAL SERVICE ORGANIZATIONS",
    "LEGAL SERVICES AND ATTORNEYS",
    "FINANCIAL INSTITUTIONS – MERCHANDISE AND SERVICES",
    "FINES",
    "GOVERNMENT SERVICES ( NOT ELSEWHERE CLASSIFIED)",
    "TAX PAYMENTS",
)
MCC_STANDARD = (
    "SCHOOLS AND EDUCATIONAL SERVICES ( NOT ELSEWHERE CLASSIFIED)",
    "TESTING LABORATORIES ( NON-MEDICAL)",
    "FAX SERVICES, TELECOMMUNICATION SERVICES",
    "CABLE AND OTHER PAY TELEVISION (PREVIOUSLY CABLE SERVICES)",
    "COMPUTER MAINTENANCE AND REPAIR SERVICES, NOT ELSEWHERE CLASSIFIED",
    "BUSINESS SERVICES, NOT ELSEWHERE CLASSIFIED",
    "MEMBERSHIP ORGANIZATIONS ( NOT ELSEWHERE CLASSIFIED)",
    "AUTOMOBILE PARKING LOTS AND GARAGES",
    "ELECTRIC, GAS, SANITARY AND WATER UTILITIES",
    "ARCHITECTURAL – ENGINEERING AND SURVEYING SERVICES",
    "CARD SHOPS, GIFT, NOVELTY, AND SOUVENIR SHOPS",
    "MEMBERSHIP CLUBS (SPORTS, RECREATION, ATHLETIC), COUNTRY CLUBS, AND PRIVATE GOLF COURSES",
    "RECREATION SERVICES (NOT ELSEWHERE CLASSIFIED)",
)
MCC_BUSINESS = (
    "FINANCIAL INSTITUTIONS – MERCHANDISE AND SERVICES",
    "LEGAL SERVICES AND ATTORNEYS",
    "INSURANCE SALES, UNDERWRITING, AND PREMIUMS",
    "BUSINESS SERVICES, NOT ELSEWHERE CLASSIFIED",
)
MCC_GOVERNMENT = (
    "GOVERNMENT SERVICES ( NOT ELSEWHERE CLASSIFIED)",
    "TAX PAYMENTS",
    "FINES",
    "COURT COSTS, INCLUDING ALIMONY AND CHILD SUPPORT",
    "POLITICAL ORGANIZATIONS",
)
MCC_NEC_TEXTS = ("NOT ELSEWHERE CLASSIFIED", "NEC")
MCC_SPECIAL_PATTERN = r"[^a-zA-Z0-9\s\-\_\(\)\.,]"
MCC_TEST_TEXTS = ("TEST", "DUMMY", "SAMPLE", "DEMO", "DEV")

# --- software partner (substrings, case-sensitive) ------------------------------------------
PARTNER_ENTERPRISE = (
    "Oracle", "SAP", "Guidewire", "Tyler", "Harris", "Duck Creek", "Sapiens", "SunGard", "Hansen",
)
PARTNER_MID_TIER = (
    "Central Square", "NaviLine", "CityWorks", "Civic Systems", "Caselle", "Software Solutions",
    "IMT", "Cogsdale", "Systems and Software", "Muni-Link", "OpenGov",
)
PARTNER_CUSTOM = ("In-House", "Home Grown", "Custom")
PARTNER_MUNICIPAL = ("Munis", "Municipal", "Govern")
PARTNER_INSURANCE = ("Insurance", "Duck Creek", "Sapiens", "Insurity")
PARTNER_UTILITY = ("Util", "Water", "Waste")
PARTNER_TEST = ("Test", "Demo", "Sample", "Dummy")
PARTNER_TEST_SCORED = ("Test", "Demo")
PARTNER_LEGACY = ("AS400", "Iseries", "Mainframe", "LOCiS")
PARTNER_MODERN = ("Cloud", "Native", "Real-Time", "Real Time")
PARTNER_BATCH = ("Batch",)
PARTNER_REAL_TIME = ("Real-Time", "Real Time")

# --- billing location -----------------------------------------------------------------------
ZIP_DEFAULTS = ("00000", "99999", "12345", "54321", "90210")
# rurality code, inclusive bounds, label, score
RURALITY_BANDS = (
    (1, 1, "Metropolitan Core (Urban)", -2),
    (2, 3, "Metropolitan Commuting (Suburban)", -1),
    (4, 6, "Micropolitan", 0),
    (7, 9, "Small Town", 2),
    (10, 10, "Rural", 3),
)
RURALITY_UNKNOWN = ("Unknown", 4)

# --- replaced bill-pay provider -------------------------------------------------------------
EBPP_KNOWN = (
    "KUBRA", "NO EBPP TODAY", "COLORADO PAYPORT", "HARRIS MYGOVHUB", "WELLS FARGO",
    "AUTHORITY PAY", "REVTRAK", "ACI WORLDWIDE", "ALACRITI", "EPAY", "TYLER EAGLEWEB",
    "FIS-PAYDIRECT", "HARRIS ERP-CITIZEN ACCESS", "DIVDAT", "STURGIS", "PAYMENTUS", "JETPAY",
    "INFOSEND", "WESTERN UNION", "D&T VENTURES", "REVSPRING", "NEXBILLPAY", "STARNIK", "GOV PAY",
    "WEBSTER", "OSG", "SPRINGBROOK", "CERTIFIED PAYMENTS", "BDS", "XPRESSBILLPAY",
    "COMMERCIAL PAYMENTS", "SPEEDPAY", "EDMUNDS WIPP", "MUNI-LINK", "US BANK", "PAYBILL",
    "PAYSTAR", "AMS", "DATAMATX/DOCSIGHT", "QS1", "SELECTRON", "IN-HOUSE GATEWAY", "E-Z PAY",
    "FISERV", "MYGOVHUB", "SMARTPAY", "HARRIS-NORTHSTAR ECARE", "TYLER ESUITE", "BRITECORE",
    "XPRESS-PAY", "NCOURT", "MCC", "PAYROC", "HARRIS ICONNECT", "CSG", "IL EPAY", "UNI PAY",
    "TRANSACTION WAREHOUSE", "MERCHANT TRANSACT", "STW", "HEARTLAND PAYMENTS", "CITYBASE",
    "MUNICIPAY", "LEVEL ONE/VITALCHEK", "PSN", "G2G OAKLAND COUNTY", "ENETPAY", "BOFA VELOCITY",
    "TYLER MUNICIPAL ONLINE PAYMENTS", "GOVERNMENT WINDOW", "ELAVON", "OFFICIAL PAYMENTS",
    "TRUE POINT SOLUTIONS", "BLUEFIN PAYMENT SYSTEMS", "COLLECTOR SOLUTIONS/JETPAY", "SEW", "NCR",
    "CENTRAL SQUARE", "QBILLPAY", "NIC SERVICES", "BILLTRUST", "SEDC", "INSTANT PAYMENTS",
    "ALL PAID", "WORLDPAY", "ICONNECT", "TYLER", "TYLER WEBPAY", "PAYCLIX", "POINT & PAY",
    "GREENPAY", "CONTINENTAL", "AUTHORIZE.NET", "INFINITY.LINK", "DATA WEST", "UNITED SYSTEMS",
    "MERCHANT SERVICES", "FORTE PAYMENT SYSTEMS", "UNKNOWN", "EB2GOV",
    "CHASE PAYCONNEXION/CONNECT", "CUSI", "POWERPAY", "PAYPAL GATEWAY", "BILLMATRIX", "SMART BILL",
    "CITIZEN SELF SERVICE", "TYLER MUNIS/CITIZEN SELF-SERVICE", "VALUE PAYMENTS", "CLICK2GOV",
    "GTS - GOVTECH SERVICES, INC", "PAY GOV", "VDS",
)
EBPP_TIER1 = (
    "WELLS FARGO", "US BANK", "CHASE PAYCONNEXION/CONNECT", "BOFA VELOCITY", "PAYPAL GATEWAY",
    "FISERV", "ACI WORLDWIDE", "FIS-PAYDIRECT", "WESTERN UNION", "WORLDPAY", "ELAVON",
    "HEARTLAND PAYMENTS", "AUTHORIZE.NET",
)
EBPP_TIER2 = (
    "OFFICIAL PAYMENTS", "PAY GOV", "PAYMENTUS", "TYLER", "TYLER EAGLEWEB", "TYLER ESUITE",
    "TYLER WEBPAY", "TYLER MUNICIPAL ONLINE PAYMENTS", "TYLER MUNIS/CITIZEN SELF-SERVICE",
    "BILLMATRIX", "BILLTRUST", "REVTRAK", "SPEEDPAY", "POINT & PAY", "FORTE PAYMENT SYSTEMS",
    "CSG", "KUBRA", "CENTRAL SQUARE", "NIC SERVICES", "NCR",
)
EBPP_TIER3 = (
    "SMARTPAY", "GREENPAY", "ENETPAY", "JETPAY", "NEXBILLPAY", "PAYBILL", "PAYSTAR", "STARNIK",
    "MUNI-LINK", "QS1", "SEW", "VDS", "STURGIS", "DIVDAT", "INFOSEND", "D&T VENTURES",
    "XPRESSBILLPAY", "PAYCLIX", "INFINITY.LINK", "DATA WEST", "UNITED SYSTEMS", "QBILLPAY",
    "INSTANT PAYMENTS", "ALL PAID", "POWERPAY",
)
EBPP_INHOUSE_TEXTS = ("IN-HOUSE", "INHOUSE", "INTERNAL")
EBPP_GOVERNMENT_TEXTS = ("GOV", "MUNICIPAL", "CITY", "COUNTY")
EBPP_TEMPORARY_TEXTS = ("TEMP", "TRANSITION", "TEST", "PILOT")
EBPP_TEMPORARY_NAMES = ("UNKNOWN", "NO EBPP TODAY")

# --- pricing model --------------------------------------------------------------------------
PRICING_MODELS = {
    "pricing_model_absorb": "ABSORB",
    "pricing_model_hybrid": "HYBRID",
    "pricing_model_submit": "SUBMIT",
    "pricing_model_no_pricing": "NO PRICING",
}

# --- score bands ----------------------------------------------------------------------------
RISK_BANDS = ((3, "Very Low"), (7, "Low"), (15, "Medium"))
RISK_TOP = "High"
