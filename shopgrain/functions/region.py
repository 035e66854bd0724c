"""Column functions for currency, fulfilment region and Quebec compliance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Country, state and text literals the results must carry.
US = "US"
CANADA = "CA"
QUEBEC = "QC"
ALASKA = "AK"
HAWAII = "HI"
PUERTO_RICO_ZIP_PREFIX = "009"
UNKNOWN_CURRENCY = "UNKNOWN"
ALASKA_REASON = "Alaska - Excluded due to supply chain complexity"
HAWAII_REASON = "Hawaii - Excluded due to supply chain complexity"
PUERTO_RICO_REASON = "Puerto Rico - Excluded due to supply chain complexity"
QUEBEC_NOTES = (
    "Quebec (QC) - Requires adherence to Bill 101 (Language Charter) and PIPEDA privacy "
    "regulations. All communications must support French. Ensure GDPR-like privacy controls."
)


def _certain(condition: Column) -> Column:
    """NULL counts as not met."""
    return F.coalesce(condition, F.lit(False))


def _puerto_rico(zip_code: Column) -> Column:
    return zip_code.cast("string").startswith(PUERTO_RICO_ZIP_PREFIX)


def currency_code(country: Column) -> Column:
    return F.when(country == US, "USD").when(country == CANADA, "CAD").otherwise(UNKNOWN_CURRENCY)


def rate_or_one(rate: Column) -> Column:
    """Rate of a looked-up currency; 1.0 where the lookup found none."""
    return F.coalesce(rate.cast("double"), F.lit(1.0))


def is_quebec(country: Column, state: Column) -> Column:
    return _certain((country == CANADA) & (state == QUEBEC))


def is_excluded_supply_chain(country: Column, state: Column, zip_code: Column) -> Column:
    return _certain((country == US) & (state.isin(ALASKA, HAWAII) | _puerto_rico(zip_code)))


def supply_chain_exclusion_reason(country: Column, state: Column, zip_code: Column) -> Column:
    why = (
        F.when(state == ALASKA, ALASKA_REASON)
        .when(state == HAWAII, HAWAII_REASON)
        .when(_puerto_rico(zip_code), PUERTO_RICO_REASON)
    )
    return F.when(country == US, why)


def quebec_compliance_notes(country: Column, state: Column) -> Column:
    return F.when(is_quebec(country, state), QUEBEC_NOTES)


def marketing_language_requirement(country: Column, state: Column) -> Column:
    return F.when(is_quebec(country, state), "EN,FR").otherwise("EN")


def region_type(country: Column, state: Column, zip_code: Column) -> Column:
    """Fulfilment region: QC, EXCLUDED or STANDARD."""
    return (
        F.when(is_quebec(country, state), "QC")
        .when(is_excluded_supply_chain(country, state, zip_code), "EXCLUDED")
        .otherwise("STANDARD")
    )


def requires_french_support(country: Column, state: Column) -> Column:
    """French is a must in Quebec only; it is optional in the rest of Canada."""
    return is_quebec(country, state)


def requires_compliance_flag(country: Column, state: Column) -> Column:
    return is_quebec(country, state)


def is_fulfillable(country: Column, state: Column, zip_code: Column) -> Column:
    """Three-valued: an unknown country, state or zip can leave the answer NULL."""
    return (country != US) | (~state.isin(ALASKA, HAWAII) & ~_puerto_rico(zip_code))


def excluded_state(state: Column) -> Column:
    """The report's looser flag: looks at the state alone."""
    return _certain(state.isin(ALASKA, HAWAII))
