"""Spellings accepted for each controlled vocabulary."""

from __future__ import annotations

CATEGORY_SPELLINGS = {
    "groceries": "Groceries",
    "grocery": "Groceries",
    "dining": "Dining",
    "dinning": "Dining",
    "restaurants": "Dining",
    "transportation": "Transportation",
    "transport": "Transportation",
    "travel": "Travel",
    "entertainment": "Entertainment",
    "utilities": "Utilities",
    "utility": "Utilities",
    "housing": "Housing",
    "rent": "Housing",
    "mortgage": "Housing",
    "healthcare": "Healthcare",
    "health care": "Healthcare",
    "retail": "Retail",
    "shopping": "Retail",
    "education": "Education",
    "cash withdrawal": "Cash Withdrawal",
    "atm withdrawal": "Cash Withdrawal",
    "atm": "Cash Withdrawal",
    "transfers": "Transfers",
    "transfer": "Transfers",
    "subscription services": "Subscription Services",
    "subscriptions": "Subscription Services",
    "fees and charges": "Fees and Charges",
    "fees": "Fees and Charges",
}

STATUS_SPELLINGS = {
    "approved": "Approved",
    "apprved": "Approved",
    "declined": "Declined",
    "pending": "Pending",
    "reversed": "Reversed",
}

# A hyphen is read as a space before the lookup, so "point-of-sale" needs no entry of its own.
CHANNEL_SPELLINGS = {
    "mobile": "Mobile",
    "online": "Online",
    "atm": "ATM",
    "branch": "Branch",
    "point of sale": "Point of Sale",
    "pos": "Point of Sale",
    "automatic payment": "Automatic Payment",
    "auto payment": "Automatic Payment",
}

ACCOUNT_TYPE_SPELLINGS = {
    "checking": "Checking",
    "savings": "Savings",
    "credit card": "Credit Card",
    "money market": "Money Market",
}

TRANSACTION_TYPE_SPELLINGS = {
    "card purchase": "Card Purchase",
    "ach payment": "ACH Payment",
    "bank transfer": "Bank Transfer",
    "atm withdrawal": "ATM Withdrawal",
    "cash withdrawal": "ATM Withdrawal",
    "direct deposit": "Direct Deposit",
    "bill payment": "Bill Payment",
    "automatic payment": "Bill Payment",
    "refund": "Refund",
    "bank fee": "Bank Fee",
    "cash deposit": "Cash Deposit",
}

CUSTOMER_SEGMENTS = (
    "Students",
    "Young Professionals",
    "Families",
    "Affluent",
    "Retirees",
    "Small Business",
)

DIGITAL_CHANNELS = ("Mobile", "Online", "Point of Sale")

BRANCH_CHANNELS = ("Branch", "ATM")

REGION_OF_STATE = {
    "NY": "Northeast",
    "MA": "Northeast",
    "PA": "Northeast",
    "GA": "South",
    "FL": "South",
    "TX": "South",
    "IL": "Midwest",
    "OH": "Midwest",
    "MN": "Midwest",
    "CO": "West",
    "AZ": "West",
    "CA": "West",
    "WA": "West",
    "INT": "International",
}

TRUE_SPELLINGS = ("true", "t", "yes", "y", "1")


def names_of(spellings: dict[str, str]) -> list[str]:
    """The canonical names of a vocabulary, each once."""
    return sorted(set(spellings.values()))
