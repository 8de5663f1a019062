"""Parameters of the operators. Nothing here reads the clock or the environment."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

# Fixed values of the business domain (codes and labels stored in the data).
PREFIXES = ("65", "67", "68", "69")
EXCLUDED_COMPANIES = (3, 204, 226, 229, 301, 302)
FEE_TYPE = "1"
INSTALMENT_TYPES = ("P", "S", "SA", "SN", "E", "ER", "AM", "FC", "B", "R", "I", "OP")
ADMIN_GROUPS = (
    "ADMINISTRATIVO",
    "INVESTIMENTOS",
    "GERENCIAIS/INTERNAS",
    "CONTROLADAS",
    "NOVOS NEGOCIOS",
    "NOVOS NEGÓCIOS",
)
ADMIN_PREFIX = "HOLDING"
CITY_ALIAS = (("TAQUARALTO", "PALMAS"),)
STATUS_LIVE, STATUS_CANCELLED, STATUS_SETTLED = 0, 1, 3
HISTORY_CANCELLATION, HISTORY_RENEGOTIATION, HISTORY_CESSION = 0, 1, 2
OCCURRENCE_ACTIVE, OCCURRENCE_PASSIVE = 4, 32
UNIT_UNAVAILABLE = 10
APTO, NAO_APTO = "APTO", "NÃO APTO"


@dataclass(frozen=True)
class Portfolio:
    """Which rows belong to the portfolio, and how its cities are named."""

    prefixes: tuple[str, ...] = PREFIXES
    excluded_companies: tuple[int, ...] = EXCLUDED_COMPANIES
    fee_type: str = FEE_TYPE
    admin_groups: tuple[str, ...] = ADMIN_GROUPS
    admin_prefix: str = ADMIN_PREFIX
    city_alias: tuple[tuple[str, str], ...] = CITY_ALIAS


@dataclass(frozen=True)
class LiveWindow:
    """Campaign [start, end) seen from the day ``as_of``."""

    start: date = date(2026, 7, 1)
    end: date = date(2027, 1, 1)
    as_of: date = date(2026, 8, 11)

    @property
    def month_start(self) -> date:
        return self.as_of.replace(day=1)

    @property
    def previous_month_start(self) -> date:
        return (self.month_start - timedelta(days=1)).replace(day=1)


@dataclass(frozen=True)
class CloseWindow:
    """Campaign start, first day of the closed month, first day after it."""

    start: date = date(2026, 7, 1)
    month_start: date = date(2026, 7, 1)
    cutoff: date = date(2026, 8, 1)

    @property
    def last_day(self) -> date:
        return self.cutoff - timedelta(days=1)

    @property
    def previous_month_start(self) -> date:
        return (self.month_start - timedelta(days=1)).replace(day=1)


@dataclass(frozen=True)
class CouponRule:
    """One coupon per ``amount_per_coupon`` of the enabled components."""

    version: str = "v1-2026-06"
    amount_per_coupon: int = 100
    principal: bool = True
    fine: bool = True
    interest: bool = True
    fees: bool = True
    whole_blocks_only: bool = True

    @property
    def components(self) -> tuple[str, ...]:
        switches = {
            "valor_principal": self.principal,
            "valor_multa": self.fine,
            "valor_juros": self.interest,
            "valor_custas": self.fees,
        }
        return tuple(name for name, enabled in switches.items() if enabled)


@dataclass(frozen=True)
class Campaign:
    """First and last day (inclusive) and the day of the month of each draw."""

    start: date = date(2026, 7, 1)
    end: date = date(2026, 12, 31)
    draw_day: int = 15


@dataclass(frozen=True)
class RefreshSchedule:
    """Local hours at which a snapshot is published, plus the writing margin."""

    timezone: str = "America/Sao_Paulo"
    hours: tuple[int, ...] = (8, 15)
    margin_minutes: int = 20
