"""Comparison codes between the asset register and what agents or directories report."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv
from fleetgauge.functions.text import contains_column, is_blank, norm_key


def _rated(missing: Column, equal: Column) -> Column:
    """Missing before equal before different; an unknown comparison counts as different."""
    return (
        F.when(missing, F.lit(fv.CODE_MISSING))
        .when(equal, F.lit(fv.CODE_EQUAL))
        .otherwise(F.lit(fv.CODE_DIFFERENT))
    )


def text_code(reported: Column, registered: Column) -> Column:
    """Manufacturer and model: equal up to case and surrounding spaces."""
    return _rated(is_blank(reported) | is_blank(registered), norm_key(reported) == norm_key(registered))


def list_code(reported_list: Column, registered: Column) -> Column:
    """MAC address: the registered one occurs in the reported list."""
    return _rated(is_blank(reported_list) | is_blank(registered), contains_column(reported_list, registered))


def virtual_code(reported: Column, registered: Column) -> Column:
    """Virtual flag; null on either side reads as false, so code 3 does not occur."""
    same = F.coalesce(reported, F.lit(False)) == F.coalesce(registered, F.lit(False))
    return F.when(same, F.lit(fv.CODE_EQUAL)).otherwise(F.lit(fv.CODE_DIFFERENT))


def os_code(reported: Column, registered: Column) -> Column:
    """Operating system: equal, or equal once the vendor is added and the spelling aligned."""
    name, target = norm_key(reported), norm_key(registered)
    french, english = (F.lit(s) for s in fv.OS_SPELLINGS)
    spellings = [
        name,
        F.concat(F.lit(fv.OS_VENDOR_PREFIX), F.replace(name, french, english)),
        F.concat(F.lit(fv.OS_VENDOR_PREFIX), F.replace(name, english, french)),
    ]
    equal = reduce(lambda a, b: a | b, [s == target for s in spellings])
    return _rated(is_blank(reported) | is_blank(registered), equal)


def user_code(reported: Column, registered: Column) -> Column:
    """Main user: not applicable as soon as one side is a generic account."""
    excluded = F.coalesce(reported == fv.GENERIC_ACCOUNT, F.lit(False)) | F.coalesce(
        registered == fv.GENERIC_ACCOUNT, F.lit(False)
    )
    rated = _rated(is_blank(reported) | is_blank(registered), reported == registered)
    return F.when(excluded, F.lit(fv.CODE_NOT_APPLICABLE)).otherwise(rated)


def entity_code(reported: Column, registered: Column) -> Column:
    """User entity: only null is missing, a blank code compares like any other."""
    return _rated(reported.isNull() | registered.isNull(), reported == registered)


def responsible_code(personal: Column, owner_dum: Column, responsible_dum: Column) -> Column:
    """Responsible's sub-unit: not applicable to personal accounts."""
    rated = _rated(is_blank(owner_dum) | is_blank(responsible_dum), owner_dum == responsible_dum)
    return F.when(personal, F.lit(fv.CODE_NOT_APPLICABLE)).otherwise(rated)


def location_code(verdict: Column) -> Column:
    """Building and site: the verdict is computed upstream."""
    return F.when(verdict == fv.LOCATION_RIGHT, F.lit(fv.CODE_EQUAL)).otherwise(F.lit(fv.CODE_DIFFERENT))


def seen_status(last_scan: Column, age: Column, days: int = fv.FRESH_DAYS) -> Column:
    """Never seen, seen within ``days``, or not seen."""
    return (
        F.when(last_scan.isNull(), F.lit(fv.NEVER_SEEN))
        .when(age < days, F.lit(fv.SEEN))
        .otherwise(F.lit(fv.NOT_SEEN))
    )
