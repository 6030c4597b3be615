"""Money rounding: HALF_UP to cents, overflow becomes NULL instead of an error.

A division of wide decimals computes 39 digits, which costs more than all other measures together. Quotients of amounts up
to the bounds below are instead rounded from whole cents in 64-bit integers. Their results are those of the decimal division:
a quotient that is no tie lies further from one than the decimal's last digit. Larger amounts are divided as decimals.
"""

from __future__ import annotations

from ledgerline.contracts import MONEY

#: Amounts whose doubled cents fit into 64 bits.
WHOLE = "10000000000000000.00"
#: Amounts whose cents times 20,000 fit, and whose quotient no decimal digit that Spark drops can round the other way.
SHARE = "100000000.00"


def round_money_sql(expression: str) -> str:
    """The rounding as SQL text, for projections written with lateral aliases."""
    return f"try_cast(round({expression}, 2) as {MONEY})"


def _cents(amount: str) -> str:
    return f"cast({amount} * 100 as bigint)"


def _within(amount: str, bound: str) -> str:
    return f"{amount} between -{bound} and {bound}"


def _half_up(num: str, den: str) -> str:
    """``num / den`` of two bigints, rounded HALF_UP to a whole number of cents, as an amount."""
    sign = f"case when ({num} < 0) = ({den} < 0) then 1L else -1L end"
    return f"cast((2L * abs({num}) + abs({den})) div (2L * abs({den})) * {sign} as decimal(20,0)) * 0.01"


def per_unit_sql(amount: str) -> str:
    """An amount for one of ``quantity`` pieces."""
    exact = _half_up(_cents(amount), "cast(quantity as bigint)")
    return f"case when {_within(amount, WHOLE)} then {exact} else round({amount} / quantity, 2) end"


def percent_sql(part: str, whole: str) -> str:
    """``part`` in percent of ``whole``; 0 where there is no whole."""
    exact = _half_up(f"(10000L * {_cents(part)})", _cents(whole))
    small = f"{_within(part, SHARE)} and {_within(whole, SHARE)}"
    return f"case when {whole} = 0 then 0 when {small} then {exact} else round({part} / {whole} * 100, 2) end"


def whole_per_unit_sql(amount: str) -> str:
    """``per_unit_sql`` of whole cents and a whole positive ``quantity``, in cents."""
    return f"(2L * abs({amount}) + quantity) div (2L * quantity) * case when {amount} < 0 then -1L else 1L end"


def whole_percent_sql(part: str, whole: str) -> str:
    """``percent_sql`` of whole cents, where ``whole`` is not negative, in hundredths of a percent."""
    rounded = f"(20000L * abs({part}) + {whole}) div (2L * {whole}) * case when {part} < 0 then -1L else 1L end"
    return f"case when {whole} = 0 then 0L else {rounded} end"


def amount_sql(cents: str) -> str:
    """Whole cents of up to 17 digits as an amount of the money type."""
    return f"cast({cents} as decimal(17,0)) * 0.01"
