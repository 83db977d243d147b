"""Parameters of a generated platform.

One frozen object is passed to every builder. Nothing reads the clock: the window is fixed by
`start_date`, so a rerun (or a retried task) gives the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

# ---------------------------------------------------------------------------------------------
# Fixed values that must equal the source's stated targets.
#   roles (plan):    regular_user 80 %, content_creator 15 %, influencer 5 %
#   statuses (plan): published 70 %, draft 20 %, archived 10 %
#   timeline (E):    30 pre-viral days, 7 peak days, 60 post-viral days, viral start 2026-01-15,
#                    1,000 registrations per day at base, 50x at the peak, decay e^(-0.05 d)
#   posts per user per day (E): 1.5 pre, 15.0 peak, 3.0 e^(-0.02 d) after the peak
#   follow probability (E):     0.02 pre, 0.20 peak, 0.05 e^(-0.01 d) after the peak
#   followee joined at most 10 days after the follower; follow date 0..19 days after joining;
#   post date 0..29 days after joining
#   role weights by period (E, intended): pre .85/.10/.05, peak .70/.20/.10, post .90/.08/.02
#   status weights by period (E, intended): pre published .9 / draft .1;
#                    peak published .95 / flagged .03 / archived .02;
#                    post published .85 / draft .10 / archived .05
#   churn of spike users 15 % within 30 days; 30 % mutual follows; top 20 % hold 80 % of follows
#   sizes: 500,000 users, 1,000,000 posts, 20,000 follows
# ---------------------------------------------------------------------------------------------
ROLES = (("regular_user", 0.80), ("content_creator", 0.15), ("influencer", 0.05))
STATUSES = (("published", 0.70), ("draft", 0.20), ("archived", 0.10))
ROLES_BY_PERIOD_E = {
    "pre": (("member", 0.85), ("moderator", 0.10), ("admin", 0.05)),
    "peak": (("member", 0.70), ("moderator", 0.20), ("admin", 0.10)),
    "post": (("member", 0.90), ("moderator", 0.08), ("admin", 0.02)),
}
STATUSES_BY_PERIOD_E = {
    "pre": (("published", 0.90), ("draft", 0.10)),
    "peak": (("published", 0.95), ("flagged", 0.03), ("archived", 0.02)),
    "post": (("published", 0.85), ("draft", 0.10), ("archived", 0.05)),
}
PERIODS = ("pre", "peak", "post")

# exponent that puts 80 % of draws on the top 20 % of ids: k = ln 0.2 / ln 0.8
POWER_LAW_80_20 = 7.21


@dataclass(frozen=True)
class Timeline:
    """Variant E's day axis with one period table for curve and reports."""

    viral_start: date = date(2026, 1, 15)
    pre_days: int = 30
    peak_days: int = 7
    post_days: int = 60
    base_per_day: float = 1000.0
    viral_multiplier: float = 50.0
    decay: float = 0.05

    @property
    def start(self) -> date:
        return self.viral_start - timedelta(days=self.pre_days)

    @property
    def n_days(self) -> int:
        return self.pre_days + self.peak_days + self.post_days

    @property
    def peak_end(self) -> date:
        return self.viral_start + timedelta(days=self.peak_days)


@dataclass(frozen=True)
class GrowthParams:
    seed: int = 42
    timeline: Timeline = field(default_factory=Timeline)
    id_base: int = 1
    roles_by_period: dict = field(default_factory=lambda: {p: ROLES for p in PERIODS})
    statuses_by_period: dict = field(default_factory=lambda: dict(STATUSES_BY_PERIOD_E))
    posts_rate_pre: float = 1.5
    posts_rate_peak: float = 15.0
    posts_rate_post: float = 3.0
    posts_decay: float = 0.02
    post_shift_days: int = 30
    follow_p_pre: float = 0.02
    follow_p_peak: float = 0.20
    follow_p_post: float = 0.05
    follow_decay: float = 0.01
    follow_lead_days: int = 10
    follow_shift_days: int = 20
    follower_k: float = 2.0
    followed_k: float = POWER_LAW_80_20
    mutual_share: float = 0.30
    churn_share: float = 0.15
    churn_days: int = 30
    # rows one task expands or numbers; hot days are split into chunks of this size
    rows_per_chunk: int = 250_000

    def reverse_fraction(self) -> float:
        """q such that reversing q of the one-way edges makes `mutual_share` of rows mutual."""
        s = self.mutual_share
        return s / (2.0 - s)
