"""Code lists of the payment network and of the retail tables."""

from __future__ import annotations

# ---- Fixed values: card-payment directories -------------------------------------------

COUNTRIES = [
    ("US", "United States", "NA", "low"),
    ("CA", "Canada", "NA", "low"),
    ("GB", "United Kingdom", "EU", "low"),
    ("DE", "Germany", "EU", "low"),
    ("FR", "France", "EU", "low"),
    ("IE", "Ireland", "EU", "low"),
    ("NL", "Netherlands", "EU", "low"),
    ("ES", "Spain", "EU", "medium"),
    ("IT", "Italy", "EU", "medium"),
    ("PL", "Poland", "EU", "medium"),
    ("SE", "Sweden", "EU", "low"),
    ("CH", "Switzerland", "EU", "low"),
    ("AU", "Australia", "APAC", "low"),
    ("NZ", "New Zealand", "APAC", "low"),
    ("JP", "Japan", "APAC", "low"),
    ("SG", "Singapore", "APAC", "low"),
    ("HK", "Hong Kong", "APAC", "medium"),
    ("IN", "India", "APAC", "medium"),
    ("BR", "Brazil", "LATAM", "medium"),
    ("MX", "Mexico", "LATAM", "medium"),
    ("AR", "Argentina", "LATAM", "high"),
    ("ZA", "South Africa", "MEA", "medium"),
    ("AE", "United Arab Emirates", "MEA", "medium"),
    ("NG", "Nigeria", "MEA", "high"),
    ("TR", "Türkiye", "MEA", "medium"),
]

MCCS = [
    ("5411", "Grocery Stores", "retail"),
    ("5812", "Eating Places", "restaurant"),
    ("5814", "Fast Food", "restaurant"),
    ("5541", "Service Stations", "fuel"),
    ("5542", "Automated Fuel", "fuel"),
    ("4111", "Local Transit", "travel"),
    ("4511", "Airlines", "travel"),
    ("7011", "Hotels", "travel"),
    ("5311", "Department Stores", "retail"),
    ("5691", "Clothing Stores", "retail"),
    ("5732", "Electronics", "retail"),
    ("5999", "Miscellaneous Retail", "retail"),
    ("6011", "ATM Cash Advance", "cash"),
    ("6010", "Manual Cash", "cash"),
    ("4900", "Utilities", "services"),
    ("6300", "Insurance", "services"),
    ("7995", "Betting", "high_risk"),
    ("5921", "Package Stores — Beer Wine Liquor", "high_risk"),
    ("6051", "Quasi Cash", "high_risk"),
    ("4829", "Wire Transfer Money Orders", "high_risk"),
    ("7399", "Business Services NEC", "services"),
    ("8999", "Professional Services", "services"),
    ("8011", "Doctors", "healthcare"),
    ("8021", "Dentists", "healthcare"),
    ("5912", "Drug Stores", "healthcare"),
    ("7832", "Motion Picture Theaters", "entertainment"),
    ("7922", "Ticket Agencies", "entertainment"),
    ("4121", "Taxicabs Limousines", "travel"),
    ("4784", "Tolls", "travel"),
    ("9402", "Postal Services", "government"),
]

ENTRY_MODES = [
    ("chip", "EMV chip read"),
    ("contactless", "NFC / contactless"),
    ("magstripe", "Magnetic stripe"),
    ("ecom", "Card-not-present e-commerce"),
    ("moto", "Mail / telephone order"),
    ("manual", "Key-entered"),
    ("token", "Network token"),
]

RESPONSE_CODES = [
    ("00", "Approved", True),
    ("01", "Refer to issuer", False),
    ("05", "Do not honor", False),
    ("14", "Invalid card number", False),
    ("51", "Insufficient funds", False),
    ("54", "Expired card", False),
    ("57", "Transaction not permitted", False),
    ("61", "Exceeds withdrawal limit", False),
    ("62", "Restricted card", False),
    ("65", "Exceeds frequency limit", False),
    ("91", "Issuer unavailable", False),
    ("96", "System malfunction", False),
]

CURRENCIES = [
    ("USD", "US Dollar", 2),
    ("CAD", "Canadian Dollar", 2),
    ("GBP", "Pound Sterling", 2),
    ("EUR", "Euro", 2),
    ("AUD", "Australian Dollar", 2),
    ("NZD", "New Zealand Dollar", 2),
    ("JPY", "Yen", 0),
    ("SGD", "Singapore Dollar", 2),
    ("HKD", "Hong Kong Dollar", 2),
    ("INR", "Indian Rupee", 2),
    ("BRL", "Brazilian Real", 2),
    ("MXN", "Mexican Peso", 2),
    ("CHF", "Swiss Franc", 2),
    ("SEK", "Swedish Krona", 2),
    ("PLN", "Polish Zloty", 2),
    ("AED", "UAE Dirham", 2),
    ("ZAR", "South African Rand", 2),
    ("TRY", "Turkish Lira", 2),
    ("NGN", "Nigerian Naira", 2),
    ("ARS", "Argentine Peso", 2),
]

COUNTRY_CURRENCY = {
    "US": "USD", "CA": "CAD", "GB": "GBP", "DE": "EUR", "FR": "EUR", "IE": "EUR",
    "NL": "EUR", "ES": "EUR", "IT": "EUR", "PL": "PLN", "SE": "SEK", "CH": "CHF",
    "AU": "AUD", "NZ": "NZD", "JP": "JPY", "SG": "SGD", "HK": "HKD",
    "IN": "INR", "BR": "BRL", "MX": "MXN", "AR": "ARS", "ZA": "ZAR", "AE": "AED",
    "NG": "NGN", "TR": "TRY",
}

ACQUIRERS = [
    ("400001", "Northstar Acquiring", "US"),
    ("400002", "Maple Pay", "CA"),
    ("400003", "Thames Merchant Services", "GB"),
    ("400004", "Rhein Acquirer", "DE"),
    ("400005", "Seine Card Services", "FR"),
    ("400006", "Iberia Merchant Bank", "ES"),
    ("400007", "Pacific Gate Acquiring", "AU"),
    ("400008", "Sakura Merchant", "JP"),
    ("400009", "Lion City Acquirer", "SG"),
    ("400010", "Ganges Acceptance", "IN"),
    ("400011", "Andes Pay", "BR"),
    ("400012", "Aztec Merchant Services", "MX"),
    ("400013", "Alpine Acquiring", "CH"),
    ("400014", "Gulf Route Payments", "AE"),
    ("400015", "Cape Clearing", "ZA"),
]

# Rate in basis points = category base + entry mode + country risk + (week mod 5) - 2.
BASE_BPS = {
    "retail": 130, "restaurant": 155, "fuel": 95, "travel": 180, "cash": 60,
    "services": 145, "high_risk": 235, "healthcare": 120, "entertainment": 165,
    "government": 55,
}
ENTRY_BPS = {
    "chip": 0, "contactless": -5, "magstripe": 15, "ecom": 45, "moto": 60,
    "manual": 55, "token": -10,
}
RISK_BPS = {"low": 0, "medium": 12, "high": 30}

# Programme names: country, category and entry mode, then the week between these texts.
PROGRAM_WEEK = " rates of week "
PROGRAM_PURPOSE = " (generated card)"

# Sampling weights. Countries: five named shares, the other twenty split 41 % evenly.
COUNTRY_WEIGHTS = [
    (code, {"US": 2800, "CA": 600, "GB": 1000, "DE": 800, "FR": 700}.get(code, 205))
    for code, *_ in COUNTRIES
]
ENTRY_WEIGHTS = [
    ("chip", 35), ("contactless", 30), ("magstripe", 5), ("ecom", 22), ("moto", 3),
    ("manual", 2), ("token", 3),
]
PAYMENT_CHANNELS = [("pos", 45), ("atm", 8), ("ecom", 35), ("moto", 5), ("mobile", 7)]
# 88 % approved, the eleven refusals share 12 %.
RESPONSE_WEIGHTS = [
    (code, 968 if approved else 12) for code, _, approved in RESPONSE_CODES
]
HOT_KEY = ("5411", "US", "chip")

# ---- Fixed values: retail tables ------------------------------------------------------

SALES_CHANNELS = ("pos", "web", "app")
SALES_PAYMENTS = ("card", "cash", "wallet")
SALES_COUNTRIES = ("US", "GB", "DE", "FR", "CA")
SALES_CURRENCIES = ("USD", "EUR", "GBP")
NOT_COMPLETED = ("CANCELLED", "PENDING")

# ---- Fixed values: clickstream and catalog --------------------------------------------

CATEGORIES = ("Kitchen", "Office", "Home", "Sports", "Beauty", "Toys")
BRANDS = ("Acme", "Northstar", "Helix", "Maple", "Thames")
CLICK_TYPES = ("view", "click", "purchase", "refund")
CLICK_CHANNELS = ("web", "ios", "android")
CLICK_COUNTRIES = ("US", "GB", "CA", "DE", "FR", "IN", "AU")
REGIONS = ("NA", "EU", "APAC", "LATAM")
