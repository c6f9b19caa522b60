"""Shop place names to ERP location codes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartloom.config import LocationDefaults
from cartloom.functions.text import fold
from cartloom.operators.relational import contains_join
from cartloom.session import settle
from cartloom.sources.tables import store_rows

# Folded names the special place rules look for.
CAPITAL = "bogota"
CAPITAL_PROVINCE = "cundinamarca"
COAST_PROVINCE, COAST_CITY = "bolivar", "cartagena"
FEDERAL_COUNTRY, FEDERAL_CITY = "mexico", "ciudad de mexico"
FEDERAL_NAMES = ["cdmx", "ciudad de mexico"]

CODES = ["country_id", "state_id", "city_id"]
ASKED = ["__country", "__state", "__city"]


def _best(places: DataFrame, keys: dict[str, str], name: str) -> DataFrame:
    """Smallest codes per key, so every rule meets at most one row per key."""
    return places.groupBy(*[F.col(c).alias(k) for k, c in keys.items()]).agg(F.min(F.struct(*CODES)).alias(name))


def resolve_location(
    df: DataFrame, places: DataFrame, country: str, state: str, city: str, defaults: LocationDefaults
) -> DataFrame:
    """Adds ``country_id``, ``state_id``, ``city_id``; the defaults where no rule matches.

    Rules by priority: 1 capital district, 2 its province, 3 coast city, 4 federal
    district, 5 same state with equal city, else with a city named inside the text.
    The distinct shop places are resolved once and joined back, so a place that names
    a third of all orders costs one row here. Every rule is an equi join on names.
    """
    known = places.select(
        *CODES, fold(F.col("country_name")).alias("p_country"), fold(F.col("state_name")).alias("p_state"),
        fold(F.col("city_name")).alias("p_city"),
    )
    tagged = (
        df.withColumn("__country", fold(F.col(country)))
        .withColumn("__state", fold(F.col(state)))
        .withColumn("__city", fold(F.col(city)))
    )
    # Kept, as the rules below read it several times and whatever makes the orders should run for it once.
    asked = settle(tagged.select(*ASKED).where("__country is not null").distinct())
    codes = F.struct(*CODES)
    in_capital = F.col("p_state").contains(CAPITAL) & F.col("p_city").contains(CAPITAL)
    federal = (F.col("p_country") == FEDERAL_COUNTRY) & (F.col("p_state") == FEDERAL_CITY) & (F.col("p_city") == FEDERAL_CITY)
    per_country = known.groupBy(F.col("p_country").alias("__country")).agg(
        F.min(F.when(in_capital, codes)).alias("capital"),
        F.min(F.when(F.col("p_city").contains(COAST_CITY), codes)).alias("coast"),
        F.min(F.when(federal, codes)).alias("federal"),
    )
    province = _best(known.where(F.col("p_state").contains(CAPITAL_PROVINCE)), {"__country": "p_country", "__city": "p_city"}, "province")
    exact = _best(known, {"__country": "p_country", "__state": "p_state", "__city": "p_city"}, "exact")

    near_capital = F.col("__state").contains(CAPITAL_PROVINCE) | F.col("__state").contains(CAPITAL)
    rules = [
        (1, near_capital & F.col("__city").contains(CAPITAL), "capital"),
        (2, near_capital & (F.col("__city") != CAPITAL), "province"),
        (3, F.col("__state").contains(COAST_PROVINCE) & F.col("__city").contains(COAST_CITY), "coast"),
        (4, (F.col("__state") == FEDERAL_CITY) & F.col("__city").isin(FEDERAL_NAMES), "federal"),
        (5, F.lit(True), "exact"),
    ]
    found = F.coalesce(
        *[F.when(test & F.col(hit).isNotNull(), F.struct(F.lit(n).alias("rule"), F.col(hit).alias("hit"))) for n, test, hit in rules]
    )
    first = (
        asked.join(per_country, "__country", "left").join(province, ["__country", "__city"], "left").join(exact, ASKED, "left")
        .select(*ASKED, found.alias("__found"))
    )
    # Only names no rule knows are searched for a city inside their text.
    still_open = first.where("__found is null and __city is not null and __state is not null").withColumn(
        "__ask", F.concat_ws("\u0001", *ASKED)
    )
    cities = _best(known, {"__country": "p_country", "__state": "p_state", "__name": "p_city"}, "part")
    inside = contains_join(
        still_open.drop("__found").withColumn("__text", F.col("__city")), cities, "__text", "__ask", "__name", on=("__country", "__state")
    ).groupBy(*ASKED).agg(F.min("part").alias("part"))
    # Stored, so that Spark knows how little it is and orders need not move to meet it.
    chosen = store_rows(first.join(inside, ASKED, "left").select(
        *[F.col(a).alias(f"_{a}") for a in ASKED],
        F.coalesce("__found", F.when(F.col("part").isNotNull(), F.struct(F.lit(6).alias("rule"), F.col("part").alias("hit")))).alias("__best"),
    ))
    match = reduce(lambda a, b: a & b, [F.col(a).eqNullSafe(F.col(f"_{a}")) for a in ASKED])
    out = tagged.join(chosen, match, "left")
    wanted = dict(zip(CODES, (defaults.country, defaults.state, defaults.city)))
    return out.select(
        *df.columns,
        *[F.coalesce(F.col(f"__best.hit.{c}"), F.lit(d)).alias(c) for c, d in wanted.items()],
        F.col("__best.rule").alias("location_rule"),
    )
