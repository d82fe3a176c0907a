"""Fixed code tables shared by the standardizers and the validators."""

# Spellings that stand for another code. Every other value is
# already canonical and passes through upper-cased.
CURRENCY_ALIASES = {"RMB": "CNY", "YEN": "JPY"}
COUNTRY_ALIASES = {
    "CHINA": "CN",
    "DENMARK": "DK",
    "FRANCE": "FR",
    "SINGAPORE": "SG",
    "TAIWAN": "TW",
    "UK": "GB",
    "USA": "US",
}

# Codes a validator accepts.
CURRENCIES = ("CNY", "JPY", "RMB", "SGD", "USD", "YEN")
COUNTRIES = ("CN", "DK", "FR", "GB", "SG", "TW", "UK", "US", "USA")
GENDERS = ("F", "M", "X")

# Identity-number checksum weights, the prefixes that add an
# offset, the offset, and the check letters per prefix.
NRIC_WEIGHTS = (2, 7, 6, 5, 4, 3, 2)
NRIC_OFFSET_PREFIXES = ("G", "M", "T")
NRIC_OFFSET = 4
NRIC_LETTERS = {
    "S": "JZIHGFEDCBA",
    "T": "JZIHGFEDCBA",
    "F": "XWUTRQPNMLK",
    "G": "XWUTRQPNMLK",
    "M": "KLJNPQRTUWX",
}

# Access levels, weakest first.
ACCESS_LEVELS = ("masked_only", "partial_access", "full_access")
DEFAULT_LEVEL, PARTIAL_LEVEL, FULL_LEVEL = ACCESS_LEVELS
