"""Fixed values of the domain: transaction codes, thresholds, seat counts, period order, name suffixes."""

from __future__ import annotations

# Transaction codes that bring a donor's money in, and those that give it back
CONTRIBUTION_CODES = ["10", "11", "15", "15C", "15E", "30", "30E", "30T", "31", "31E", "31T", "32", "32E", "32T", "41Y", "42Y"]
REFUND_CODES = ["21Y", "22Y"]
# Codes whose memo rows count the same money twice
MEMO_EXCLUDED_CODES = ["15E"]
# Committee spending for or against candidates
SPENDING_CODES = ["24A", "24C", "24E", "24K", "24Z"]

# Filed party to short label
PARTY_LABELS = {"DEM": "D", "REP": "R"}
LEAN_THRESHOLD = 0.70

MAJOR_DONOR_USD = 100_000
FEATURED_RECEIPTS_USD = 100_000
FEATURED_PCT = 10.0
DOMINATED_PCT = 50.0
TOP_PER_COMPANY = 50

# Committee type to kind of recipient
RECIPIENT_BUCKETS = {
    "candidate": ["H", "P", "S"],
    "party": ["X", "Y"],
    "outside_spending": ["O", "U", "W"],
    "pac": ["N", "Q", "V"],
    "communication_cost": ["C"],
}

# House seats after the 2020 census, with the delegates of the territories
HOUSE_SEATS = {
    "AK": 1, "AL": 7, "AR": 4, "AS": 1, "AZ": 9, "CA": 52, "CO": 8, "CT": 5, "DC": 1, "DE": 1,
    "FL": 28, "GA": 14, "GU": 1, "HI": 2, "IA": 4, "ID": 2, "IL": 17, "IN": 9, "KS": 4, "KY": 6,
    "LA": 6, "MA": 9, "MD": 8, "ME": 2, "MI": 13, "MN": 8, "MO": 8, "MP": 1, "MS": 4, "MT": 2,
    "NC": 14, "ND": 1, "NE": 3, "NH": 2, "NJ": 12, "NM": 3, "NV": 4, "NY": 26, "OH": 15, "OK": 5,
    "OR": 6, "PA": 17, "PR": 1, "RI": 2, "SC": 7, "SD": 1, "TN": 9, "TX": 38, "UT": 4, "VA": 11,
    "VI": 1, "VT": 1, "WA": 10, "WI": 8, "WV": 2, "WY": 1,
}

# Order of filing periods; others come last
PERIOD_ORDER = {"first_quarter": 1, "second_quarter": 2, "mid_year": 2, "third_quarter": 3, "fourth_quarter": 4, "year_end": 4}
PERIOD_LAST = 99

# Legal forms at the end of a company's name
NAME_SUFFIXES = [
    "CO", "COMPANY", "CORP", "CORPORATION", "GROUP", "GROUPS", "HOLDING", "HOLDINGS", "INC", "INCORPORATED", "LIMITED", "LLC", "LLP", "LP", "LTD", "PLC",
]

# Names of states and territories
STATE_NAMES = {
    "AL": "Alabama", "AK": "Alaska", "AZ": "Arizona", "AR": "Arkansas", "CA": "California", "CO": "Colorado", "CT": "Connecticut", "DE": "Delaware",
    "DC": "District of Columbia", "FL": "Florida", "GA": "Georgia", "HI": "Hawaii", "ID": "Idaho", "IL": "Illinois", "IN": "Indiana", "IA": "Iowa",
    "KS": "Kansas", "KY": "Kentucky", "LA": "Louisiana", "ME": "Maine", "MD": "Maryland", "MA": "Massachusetts", "MI": "Michigan", "MN": "Minnesota",
    "MS": "Mississippi", "MO": "Missouri", "MT": "Montana", "NE": "Nebraska", "NV": "Nevada", "NH": "New Hampshire", "NJ": "New Jersey", "NM": "New Mexico",
    "NY": "New York", "NC": "North Carolina", "ND": "North Dakota", "OH": "Ohio", "OK": "Oklahoma", "OR": "Oregon", "PA": "Pennsylvania", "RI": "Rhode Island",
    "SC": "South Carolina", "SD": "South Dakota", "TN": "Tennessee", "TX": "Texas", "UT": "Utah", "VT": "Vermont", "VA": "Virginia", "WA": "Washington",
    "WV": "West Virginia", "WI": "Wisconsin", "WY": "Wyoming",
    "AS": "American Samoa", "GU": "Guam", "MP": "Northern Mariana Islands", "PR": "Puerto Rico", "VI": "U.S. Virgin Islands",
}

# Column and row of each state on the tile map
STATE_TILES = {
    "AK": (0, 0), "ME": (11, 0), "VT": (10, 1), "NH": (11, 1), "WA": (1, 2), "ID": (2, 2), "MT": (3, 2), "ND": (4, 2), "MN": (5, 2), "WI": (6, 3), "MI": (7, 3),
    "OH": (8, 2), "NY": (9, 2), "MA": (11, 2), "OR": (1, 3), "UT": (2, 3), "WY": (3, 3), "SD": (4, 3), "IA": (5, 3), "IL": (6, 4), "IN": (7, 4), "WV": (8, 3),
    "PA": (9, 3), "CT": (10, 3), "RI": (11, 3), "CA": (1, 4), "NV": (2, 4), "CO": (3, 4), "NE": (4, 4), "MO": (5, 4), "TN": (6, 5), "KY": (7, 5), "NC": (8, 4),
    "MD": (9, 4), "NJ": (10, 4), "AZ": (2, 5), "NM": (3, 5), "KS": (4, 5), "AR": (5, 5), "MS": (6, 6), "AL": (7, 6), "SC": (8, 5), "VA": (9, 5), "DE": (10, 5),
    "DC": (11, 5), "HI": (1, 7), "OK": (4, 6), "LA": (5, 6), "TX": (4, 7), "FL": (8, 7), "GA": (8, 6),
}
