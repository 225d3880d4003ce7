"""Label presets and report constants.

A preset is an ordered list of ``(label, codes)`` pairs plus a default. The first
matching pair wins, like a SQL ``CASE WHEN``.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LabelPreset:
    pairs: tuple[tuple[str, tuple[str, ...]], ...]
    default: str | None = None
    case_sensitive: bool = False

    def with_codes(self, label: str, *codes: str) -> "LabelPreset":
        """A copy where ``label`` also matches ``codes``."""
        pairs = tuple((lab, tuple(cs) + codes if lab == label else cs) for lab, cs in self.pairs)
        return LabelPreset(pairs, self.default, self.case_sensitive)


# ---------------------------------------------------------------------------
# The labels, codes and limits below must equal the values the
# original membership and launcher reports use, or the reports disagree.
# ---------------------------------------------------------------------------
ANNUAL = "年卡"
HALF_YEAR = "半年卡"
QUARTER = "季卡"
MONTHLY = "月卡"
AUTO_RENEW = "连续包月"
SINGLE_TITLE = "单点"
GIFT = "赠送"
OTHERS = "others"

# order provider -> channel, compared in lower case, default "others"
PROVIDER_CHANNELS = LabelPreset(
    (("iqiyi", ("iqiyi",)), ("youku", ("youku",)), ("bestv", ("bestv", "bestv:pptv"))),
    default=OTHERS,
)
# launcher site code -> channel, exact case, default "others"
SITE_CHANNELS = LabelPreset(
    (("youku", ("ALI",)), ("iqiyi", ("IQIYI",)), ("bestv", ("BESTV",))),
    default=OTHERS,
    case_sensitive=True,
)
# package id -> package label, compared in lower case, no default (NULL)
PACKAGES = LabelPreset(
    (
        (ANNUAL, ("xqla4e", "tpsp2k", "s2brac", "8dyu7v")),
        (HALF_YEAR, ("e8t3wp", "3dr88z", "tpl3rd", "5jef9n")),
        (QUARTER, ("42kehp", "ge3c2p", "8pywh2", "r299ex")),
        (MONTHLY, ("flk7ea", "bptv01", "zxx6c6", "b8zenj")),
        (AUTO_RENEW, ("y48685", "cmjhkb", "d3pzre")),
    )
)
# the daily order fact also files this id under the annual label
PACKAGES_DAILY_FACT = PACKAGES.with_codes(ANNUAL, "2cet3y")

ORDER_TYPE_GIFT = 1          # order_type 1 = gift, 2 = purchase, 3 = single title
ORDER_TYPE_SINGLE = 3
PAID_STATUS = 4              # order_status of a paid order
ACTIVE_STATE = 1             # order_state of a valid order
MAX_STAY_SECONDS = 1800      # longest launcher page stay counted
MIN_GROUP_COUNT = 20         # HAVING count(custom_uuid) >= 20 in the heat map
TOP_TITLES = 3               # titles kept per screen position
MISSING_CATEGORY = "null"    # category label when the click field is absent
# ---------------------------------------------------------------------------


def fixture_packages() -> LabelPreset:
    """Package preset for the test views: ids PK0..PK18 by blocks, PK19+ unmapped."""
    blocks = ((ANNUAL, 0, 4), (HALF_YEAR, 4, 8), (QUARTER, 8, 12), (MONTHLY, 12, 16), (AUTO_RENEW, 16, 19))
    return LabelPreset(tuple((label, tuple(f"pk{i}" for i in range(lo, hi))) for label, lo, hi in blocks))


def fixture_fact_packages() -> LabelPreset:
    """The test views' daily-fact preset: it alone also files PK19 under the annual label."""
    return fixture_packages().with_codes(ANNUAL, "pk19")
