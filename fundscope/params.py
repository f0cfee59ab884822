"""Business rules as data.

Every operator in the library takes its rules from a :class:`Params`
instance instead of hard-coding them, so one code path serves the default
rule book, the test stand-ins and any other organisation's settings.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass, field, replace

# --------------------------------------------------------------------------
# These texts and numbers must equal the dashboard rule book
# for results to match.  They are listed plainly, in their natural order.
# --------------------------------------------------------------------------

# capacity tier code -> label (code 0 = nothing assigned)
TIER_LABELS = {
    1: "1 Transformative Prospect ($10M+)",
    2: "2 Principal Prospect ($5M-$10M)",
    3: "3 Leadership Prospect ($1M-$5M)",
    4: "4 Major Gift Prospect ($100K-$1M)",
    5: "5 Special Gift Prospect ($25K-$100K)",
    6: "6 Annual Gift Prospect (<$25K)",
}
NO_TIER_LABEL = "No Capacity Assigned"

# rating segment text -> tier code (anything else = 0)
SEGMENT_CODES = {
    "$10 million or more": 1,
    "$5,000,000 to $9,999,999": 2,
    "$1,000,000 to $4,999,999": 3,
    "$100,000 to $249,999": 4,
    "$250,000 to $499,999": 4,
    "$500,000 to $999,999": 4,
    "$25,000 to $49,999": 5,
    "$50,000 to $99,999": 5,
    "$1,000 - $2,499": 6,
    "$100 - $499": 6,
    "$2,500 - $4,999": 6,
    "$2,500 to $9,999": 6,
    "$5,000+": 6,
    "$500 - $999": 6,
    "Institution Min Under $100": 6,
}

# capacity amount lower bounds -> tier code 1..6 (below the last or NULL = 0)
CAPACITY_CUTOFFS = (10_000_000, 5_000_000, 1_000_000, 100_000, 25_000, 1_000)

# account status whose capacity is reported
ACTIVE_STATUS = "Active"

# rating record types that count, and the label of each capacity source
RATING_RECORD_TYPES = ("GGA", "Gu Capacity")
SOURCE_VENDOR = "GG+A"
SOURCE_RESEARCH = "GU Research"

# teams whose officers are credited with all (lead + co) dollars
COUNT_ALL_TEAMS = (
    "GUMC Education & Research",
    "Lombardi",
    "GULC",
    "Planned Giving",
    "Corporate & Foundation Relations",
)

# solicitor roles on an opportunity team
LEAD_ROLE = "Lead Solicitor"
CO_ROLE = "Secondary Solicitor"

# opportunity stages that count as raised dollars; the wider list of one check
ACCEPTED_STAGES = ("Accepted", "Accepted - Stewardship")
WIDE_STAGES = ("Accepted", "Accepted - Stewardship", "Closed without Visit", "Disqualified")

# activity types
VISIT_TYPES = ("Visit", "Visit Assist")
PLAIN_VISIT_TYPES = ("Visit",)
PROSPECT_ACTIVITY_TYPE = "Prospect Activity"
SUBSTANTIVE_SUBJECT = "Substantive Action"
SUBSTANTIVE_FLAG = "true"
VISIT_TEAM = "GULC"

# qualified-ask ladder: first match wins; None amount = no minimum
ASK_LEVELS_ALWAYS = ("DA",)
ASK_TEAMS_ALWAYS = ("GUMC Education & Research", "Lombardi")
ASK_TEAM_MINIMUMS = (("GULC", 50_000),)
ASK_LEVEL_MINIMUMS = (
    ("Leadership", 500_000),
    ("AVP", 500_000),
    ("SDOD", 250_000),
    ("DOD", 100_000),
    ("ADOD", 50_000),
)

# labels written by the operators
MULTIPLE_LEADS = "Multiple Lead Solicitors"
NO_LEAD = "No Lead Solicitor Entered"
GOAL_ACHIEVED = "Goal Achieved"
LEVEL_ACHIEVED = {5: "Level 5 Achieved", 4: "Level 4 Achieved", 3: "Level 3 Achieved"}
SOURCE_VISITS = "visits"
SOURCE_ASKS = "qual_asks"
SOURCE_DOLLARS = "all_asks"
HOUSEHOLD_SEPARATOR = " & "

FY_START_MONTH = 7       # fiscal year runs July-June, named for the year it ends in
TOP_GIFTS_N = 32         # size of the top-gifts list (30 in its older form)
REPORT_YEARS = 4         # current FY and the three before it


@dataclass(frozen=True)
class Params:
    """Everything an operator needs to know about the organisation.

    People, ids and names are empty by default: they are data, supplied by
    the caller (the catalog fills them from the stand-in tables).
    """

    current_fy: int = 2018
    report_years: int = REPORT_YEARS
    fy_start_month: int = FY_START_MONTH

    accepted_stages: tuple = ACCEPTED_STAGES
    wide_stages: tuple = WIDE_STAGES
    lead_role: str = LEAD_ROLE
    co_role: str = CO_ROLE

    count_all_teams: tuple = COUNT_ALL_TEAMS
    visit_types: tuple = VISIT_TYPES
    plain_visit_types: tuple = PLAIN_VISIT_TYPES
    visit_team: str = VISIT_TEAM
    prospect_activity_type: str = PROSPECT_ACTIVITY_TYPE
    substantive_subject: str = SUBSTANTIVE_SUBJECT
    substantive_flag: str = SUBSTANTIVE_FLAG

    ask_levels_always: tuple = ASK_LEVELS_ALWAYS
    ask_teams_always: tuple = ASK_TEAMS_ALWAYS
    ask_team_minimums: tuple = ASK_TEAM_MINIMUMS
    ask_level_minimums: tuple = ASK_LEVEL_MINIMUMS

    segment_codes: dict = field(default_factory=lambda: dict(SEGMENT_CODES))
    capacity_cutoffs: tuple = CAPACITY_CUTOFFS
    rating_record_types: tuple = RATING_RECORD_TYPES
    active_status: str = ACTIVE_STATUS
    top_n: int = TOP_GIFTS_N
    # string comparisons of the rules: None = byte-wise (as DuckDB and Spark
    # default); "UTF8_LCASE_RTRIM" ignores case and trailing blanks, the
    # usual behaviour of the database the rules were written for
    collation: str | None = None

    # people and records named by the organisation (data, not code)
    excluded_owners: tuple = ()           # owners whose activities are ignored
    visit_people: tuple = ()              # contactors with the wider visit rule
    always_count_people: tuple = ()       # solicitors whose asks always qualify
    excluded_opportunity_ids: tuple = ()  # known duplicate opportunities
    multiple_lead_overrides: tuple = ()   # (account id, gift amount) pairs
    override_officers: tuple = ()         # manual name-key rows (dicts)

    def with_(self, **kw) -> "Params":
        return replace(self, **kw)

    # ---- fiscal-year windows -------------------------------------------
    def fy_bounds(self, fy: int) -> tuple[_dt.date, _dt.date]:
        """First and last day of fiscal year ``fy`` (both inclusive)."""
        if self.fy_start_month == 1:
            return _dt.date(fy, 1, 1), _dt.date(fy, 12, 31)
        start = _dt.date(fy - 1, self.fy_start_month, 1)
        end = _dt.date(fy, self.fy_start_month, 1) - _dt.timedelta(days=1)
        return start, end

    @property
    def report_fys(self) -> list[int]:
        """Reporting years, newest first (FY18, FY17, FY16, FY15 by default)."""
        return [self.current_fy - i for i in range(self.report_years)]

    @property
    def report_bounds(self) -> tuple[_dt.date, _dt.date]:
        return self.fy_bounds(self.report_fys[-1])[0], self.fy_bounds(self.current_fy)[1]
