"""Settings shared by all feature families."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Options:
    """How features are computed.

    match
        ``"search"`` finds a pattern anywhere in the text; ``"full"`` asks for the whole text to
        match, as warehouses do whose ``REGEXP_LIKE`` is anchored at both ends.
    as_of
        Day the payment vintage is measured against; the current day when left out.
    hot_rows
        A key value that fills at least this many rows is "hot": it meets its statistics through a
        broadcast, which at most 100,000 values can enter. One million when left out, one thousand
        in the combined table of one pass; ``0`` turns the split off in single families.
    expose_card_number
        Keep the full card number in the output. Off by default.
    dedupe_lookup
        Keep one lookup row per five-character ZIP. Off, a repeated ZIP repeats the payment.
    """

    match: str = "search"
    as_of: date | None = None
    hot_rows: int | None = None
    expose_card_number: bool = False
    dedupe_lookup: bool = False

    def __post_init__(self):
        if self.match not in ("search", "full"):
            raise ValueError(f"match must be 'search' or 'full', not {self.match!r}")
        if self.hot_rows is not None and self.hot_rows < 0:
            raise ValueError("hot_rows must not be negative")
