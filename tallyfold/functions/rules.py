"""The labelling rules, as data.

A rule row is (value, pattern, pattern, ...). Patterns are case-insensitive LIKE
patterns over the raw description; a row fires when any of its patterns matches, and
inside an axis the first row that fires wins. Add a merchant by adding a row per axis
above any broader row that would swallow it.
"""

from dataclasses import dataclass

# Marketplace prefixes, taken off to leave the merchant behind them.
PREFIXES = ("DOORDASH*", "DD *", "INSTACART*", "GRUBHUB*")

# Card payments, shared by three axes.
CARD_PAYMENT = ("%PAYMENT%THANK%YOU%", "%INTERNET%PAYMENT%", "%ONLINE%PAYMENT%", "PAYMENT")

# Merchant labels.
MERCHANT_NAME = (
    ("Uber Eats", "%UBER%EATS%"),
    ("Uber", "%UBER%TRIP%"),
    ("Lyft", "%LYFT%"),
    ("CVS Pharmacy", "%CVS%"),
    ("Credit Card Payment", *CARD_PAYMENT),
    ("ATM Cash Extraction", "%ATM WITHDRAWAL%"),
    ("Bank Fees", "%MAINTENANCE FEE%"),
    ("Interest Charge", "%FINANCE CHARGE%"),
    ("Netflix", "%NETFLIX%"),
    ("Spotify", "%SPOTIFY%"),
    ("Apple", "%APPLE.COM/BILL%"),
    ("Hulu", "%HULU%"),
    ("Shell", "%SHELL%"),
    ("Chevron", "%CHEVRON%"),
    ("ExxonMobil", "%EXXON%"),
    ("Marriott", "%MARRIOTT%"),
    ("MTA MetroCard", "%METROCARD%"),
    ("Safeway", "%SFW_%", "%SAFEWAY%"),
    ("Costco", "%COSTCO%"),
    ("Target", "%TARGET%"),
    ("Amazon", "%AMAZON%", "%AMZN%"),
    ("McDonalds", "%MCDONALDS%"),
    ("Chipotle", "%CHIPOTLE%"),
    ("Starbucks", "%STARBUCKS%"),
    ("Sweetgreen", "%SWEETGREEN%"),
    ("Internal Transfer", "%AUTOMATIC PAYMENT%", "%ONLINE CC PAYMENT%"),
)

# Category labels.
CATEGORY = (
    ("Transfer", *CARD_PAYMENT, "%AUTOMATIC PAYMENT%", "%ONLINE CC PAYMENT%"),
    ("Cash", "%ATM WITHDRAWAL%"),
    ("Fees", "%MAINTENANCE FEE%", "%FINANCE CHARGE%"),
    ("Travel", "%MARRIOTT%"),
    ("Medical", "%CVS%"),
    ("Subscriptions", "%NETFLIX%", "%SPOTIFY%", "%HULU%", "%APPLE.COM/BILL%"),
    ("Groceries", "%INSTACART%"),
    ("Meals", "%DOORDASH%", "DD *%", "%UBER%EATS%", "%GRUBHUB%"),
    ("Transport", "%METROCARD%", "%UBER%TRIP%", "%LYFT%", "%SHELL%", "%CHEVRON%", "%EXXON%"),
    ("Groceries", "%SFW_%", "%SAFEWAY%", "%COSTCO%"),
    ("Shopping", "%TARGET%", "%AMAZON%", "%AMZN%"),
    ("Meals", "%MCDONALDS%", "%CHIPOTLE%", "%STARBUCKS%", "%SWEETGREEN%"),
)

# Sub-category labels.
SUB_CATEGORY = (
    ("Food Delivery", "%UBER%EATS%"),
    ("Uber Rides", "%UBER%TRIP%"),
    ("Rideshare", "%LYFT%"),
    ("Pharmacy", "%CVS%"),
    ("Public Transit", "%METROCARD%"),
    ("Lodging", "%MARRIOTT%"),
    ("Grocery Delivery", "%INSTACART%"),
    ("Food Delivery", "%DOORDASH%", "DD *%", "%GRUBHUB%"),
    ("Video Streaming", "%NETFLIX%", "%HULU%"),
    ("Audio Streaming", "%SPOTIFY%"),
    ("Gas", "%SHELL%", "%CHEVRON%", "%EXXON%"),
    ("Coffee Shop", "%STARBUCKS%"),
    ("Fast Food", "%CHIPOTLE%"),
    ("Wholesale Club", "%COSTCO%"),
    ("Grocery Store", "%SAFEWAY%", "%SFW_%"),
    ("Online Retail", "%AMAZON%", "%AMZN%"),
    ("Department Store", "%TARGET%"),
    ("Digital Subscription", "%APPLE.COM/BILL%"),
    ("ATM Withdrawal", "%ATM WITHDRAWAL%"),
    ("Interest Charge", "%FINANCE CHARGE%"),
    ("Bank Fee", "%MAINTENANCE FEE%"),
    ("Credit Card Payment", *CARD_PAYMENT),
)

# Channel labels.
CHANNEL = (
    ("doordash", "%DOORDASH%", "DD *%"),
    ("instacart", "%INSTACART%"),
    ("uber_eats", "%UBER%EATS%"),
    ("grubhub", "%GRUBHUB%"),
    ("online", "%UBER%TRIP%", "%LYFT%", "%NETFLIX%", "%SPOTIFY%", "%HULU%", "%APPLE.COM/BILL%"),
    ("atm", "%ATM WITHDRAWAL%"),
    ("online", "%PRIME*MEMBERSHIP%"),
    ("ach", "%ACH%"),
    ("p2p", "%VENMO%", "%PAYPAL%"),
    ("online", "%ONLINE%", "%AMZN%"),
)


@dataclass(frozen=True)
class RuleSet:
    """One ordered rule table per axis, plus the prefixes the merchant axis takes off first."""

    prefixes: tuple[str, ...] = PREFIXES
    merchant_name: tuple[tuple[str, ...], ...] = MERCHANT_NAME
    category: tuple[tuple[str, ...], ...] = CATEGORY
    sub_category: tuple[tuple[str, ...], ...] = SUB_CATEGORY
    channel: tuple[tuple[str, ...], ...] = CHANNEL


DEFAULT_RULES = RuleSet()
