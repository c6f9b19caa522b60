"""Code tables, identity rules and money arithmetic as column functions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartloom.functions import text as tx

MONEY = "decimal(19,4)"


def map_code(c: Column, table: dict[str, str], default: str | None = None, how: str = "eq") -> Column:
    """Look a value up in a small code table.

    ``eq`` compares the whole value, ``contains`` takes the first entry found inside it.
    """
    fallback = F.lit(default).cast("string")
    if how == "eq":
        pairs = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
        return F.coalesce(F.try_element_at(pairs, c), fallback)
    out = fallback
    for key, code in reversed(list(table.items())):
        out = F.when(c.contains(key), F.lit(code)).otherwise(out)
    return out


def first_filled(*sources: Column) -> Column:
    """First source that is neither NULL nor blank."""
    return F.coalesce(*[tx.blank_to_null(s) for s in sources])


def by_origin(origin: int, customer: Column, billing: Column) -> Column:
    """Field from: 1 customer, 2 billing, 3 customer then billing, 4 billing then customer."""
    order = {1: [customer], 2: [billing], 3: [customer, billing], 4: [billing, customer]}[origin]
    return first_filled(*order)


def id_kind(c: Column, default: str = "C", company: str = "N", rule: str = "prefix") -> Column:
    """Identity document kind.

    ``prefix``: ten digits or more starting with 7, 8 or 9 is a company;
    ``hyphen``: a check-digit hyphen is a company.
    """
    if rule == "prefix":
        is_company = c.rlike("^[789]") & (F.length(F.rtrim(c)) >= 10)
    else:
        is_company = tx.digits_hyphen(c).contains("-")
    return F.when(is_company, F.lit(company)).otherwise(F.lit(default))


# Document kinds a shop profile may declare and the party codes they map to.
PROFILE_KINDS = {
    "cedulaCOL": "C",
    "CC": "C",
    "": "C",
    "cedula-de-extranjeria": "E",
    "CE": "E",
    "pasaporte": "P",
}


def profile_id_kind(kind: Column, company_id: Column) -> Column:
    mapped = map_code(F.coalesce(kind, F.lit("")), PROFILE_KINDS, "O")
    return F.when(F.coalesce(company_id, F.lit("")) != "", F.lit("N")).otherwise(mapped)


def company_id_9(c: Column, is_company: Column) -> Column:
    return F.when(is_company, tx.clip(c, 9)).otherwise(c)


def money(c: Column) -> Column:
    """Text or number to four decimals; unreadable text gives NULL."""
    return c.try_cast(MONEY)


def unit_share(amount: Column, quantity: Column) -> Column:
    """An amount per unit; NULL when the quantity is zero."""
    return F.try_divide(money(amount), money(quantity)).cast(MONEY)


def net_unit_price(gross: Column, discount: Column, count: Column, rate: Column) -> Column:
    """Unit price less its unit discount, without tax, in cents."""
    unit = F.coalesce(
        F.try_divide(discount.try_cast("decimal(18,2)"), count.cast("decimal(10,0)")).cast("decimal(18,2)"),
        F.lit(0).cast("decimal(18,2)"),
    )
    factor = F.coalesce(rate, F.lit(0)).cast("decimal(9,2)") / F.lit(100) + F.lit(1)
    return ((gross.cast("decimal(18,2)") - unit) / factor.cast("decimal(9,4)")).cast("decimal(18,2)")


def whole_from_minor(price: Column, taxed: Column, rate: float = 1.19) -> Column:
    """Minor currency units to whole units, tax taken out for taxed goods."""
    p = price.cast("double")
    return F.when(taxed, F.round(p / F.lit(rate) / F.lit(100.0), 0)).otherwise(
        F.round(p / F.lit(100.0), 0)
    ).cast("int")


def exempt_discount(price: Column, selling: Column, taxed: Column, exempt: Column, rate: float = 1.19) -> Column:
    """Whole-unit discount between list and selling price, in minor units.

    In an exempt region the shop already took the tax off as a discount, so that part is
    removed; elsewhere taxed goods carry the discount without tax.
    """
    p, s = price.cast("double"), selling.cast("double")
    share = F.lit(round(rate - 1, 4))
    gap = p - s
    same_net = F.round(p / F.lit(rate) / F.lit(100.0), 0) == F.round(s / F.lit(100.0), 0)
    base = F.when(taxed, p / F.lit(rate) / F.lit(100.0)).otherwise(p / F.lit(100.0))
    inside = F.when(same_net, F.lit(0.0)).otherwise(F.round(gap / F.lit(100.0) - base * share, 0))
    outside = (
        F.when(F.abs(gap) < 1, F.round(p / F.lit(100.0), 0))
        .when(taxed, F.round(gap / F.lit(rate) / F.lit(100.0), 0))
        .otherwise(F.round(gap / F.lit(100.0), 0))
    )
    return F.when(exempt, inside).otherwise(outside).cast("int")


def resource_id(c: Column, kind: str, prefix: str = "gid://") -> Column:
    """Identifier in the shop's global form, left alone when it already has it."""
    text = c.cast("string")
    return F.when(text.startswith(prefix), text).otherwise(F.concat(F.lit(kind), text))
