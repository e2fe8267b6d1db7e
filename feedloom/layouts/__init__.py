"""Feed layouts: which record types a feed has and what every field means."""

from .beneficiary import BENEFICIARY
from .corrections import CORRECTIONS, mended, with_row_length
from .codes import CODE_MAPS, DEFAULTS, LOOKUPS
from .dividend_plan import DIVIDEND_ACCOUNTS, DIVIDEND_SECURITIES
from .memo_position import MEMO_POSITION, SPLIT_RANGES
from .model import UNRECOGNIZED, Feed, Field, RecordType, Structure, Test
from .plan_valuation import PLAN_VALUATION
from .position_balance import POSITION_BALANCE
from .registered_plan import REGISTERED_PLAN

# As published, overlapping characters included; and with the corrections.
STRICT_FEEDS = {f.name: f for f in (
    POSITION_BALANCE, MEMO_POSITION, PLAN_VALUATION, DIVIDEND_ACCOUNTS, DIVIDEND_SECURITIES,
    BENEFICIARY, REGISTERED_PLAN)}
FEEDS = {name: mended(feed) for name, feed in STRICT_FEEDS.items()}

__all__ = ["BENEFICIARY", "CODE_MAPS", "CORRECTIONS", "DEFAULTS", "DIVIDEND_ACCOUNTS", "DIVIDEND_SECURITIES",
           "FEEDS", "Feed", "Field", "LOOKUPS", "MEMO_POSITION", "PLAN_VALUATION",
           "POSITION_BALANCE", "REGISTERED_PLAN", "RecordType", "SPLIT_RANGES",
           "STRICT_FEEDS", "Structure",
           "Test", "UNRECOGNIZED", "mended", "with_row_length"]
