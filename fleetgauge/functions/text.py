"""Text expressions. All are built-in Spark functions and stay inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetgauge import fixed_values as fv


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _code(c: Column | str, pattern: str) -> Column:
    return F.coalesce(F.regexp_extract(_col(c), pattern, 1), F.lit(""))


def last_paren_code(c: Column | str) -> Column:
    """Code in the last parentheses; ``''`` without any."""
    return _code(c, fv.CODE_LAST_PAREN)


def greedy_paren_code(c: Column | str) -> Column:
    """Text from the first opening to the last closing parenthesis; ``''`` without any."""
    return _code(c, fv.CODE_GREEDY_PAREN)


def first_paren_code(c: Column | str) -> Column:
    """Code in the first parentheses; ``''`` without any."""
    return _code(c, fv.CODE_FIRST_PAREN)


def concat_skip_nulls(*cols: Column | str) -> Column:
    """Concatenate, reading null as ``''`` (Spark's ``concat`` returns null instead)."""
    return F.concat(*[F.coalesce(_col(c).cast("string"), F.lit("")) for c in cols])


def org_path(levels: tuple[str, ...], prefix: str = "") -> Column:
    """Levels joined by ``/``; a missing level stays an empty segment."""
    parts: list[Column] = []
    for i, level in enumerate(levels):
        if i:
            parts.append(F.lit(fv.PATH_SEPARATOR))
        parts.append(F.col(prefix + level))
    return concat_skip_nulls(*parts)


def empty_path(levels: tuple[str, ...]) -> str:
    """Path of an asset whose owner is in no directory."""
    return fv.PATH_SEPARATOR * (len(levels) - 1)


def norm_key(c: Column | str) -> Column:
    """Upper case without surrounding spaces."""
    return F.trim(F.upper(_col(c)))


def is_blank(c: Column | str) -> Column:
    """Null, empty or only spaces. Never null itself."""
    return F.coalesce(F.trim(_col(c)) == "", F.lit(True))


def key_part(c: Column | str, delimiter: str, n: int) -> Column:
    """``n``-th part of a delimited text, ``''`` out of range."""
    return F.split_part(_col(c), F.lit(delimiter), F.lit(n))


def is_generic_account(c: Column | str) -> Column:
    """Account shared by several people; null for a null id."""
    return reduce(lambda a, b: a | b, [_col(c).contains(m) for m in fv.GENERIC_ACCOUNT_MARKS])


def account_or_excluded(c: Column | str) -> Column:
    """Upper-cased account, or the exclusion marker for a generic one."""
    return F.when(is_generic_account(c), F.lit(fv.GENERIC_ACCOUNT)).otherwise(F.upper(_col(c)))


def is_connected(network: Column | str) -> Column:
    """Null-safe: an unknown network counts as connected."""
    return F.coalesce(_col(network), F.lit("")) != fv.NETWORK_DISCONNECTED


def is_personal_account(c: Column | str) -> Column:
    """Accounts with the length of a personal id are not service accounts."""
    return F.coalesce(F.length(_col(c)).isin(*fv.PERSONAL_ACCOUNT_LENGTHS), F.lit(False))


def joined_list(c: Column | str) -> Column:
    """Array joined by ``/``; null when the array or one of its elements is null."""
    arr = _col(c)
    return F.when(~F.exists(arr, lambda x: x.isNull()), F.array_join(arr, "/"))


def contains_column(c: Column | str, part: Column | str) -> Column:
    """Does one column contain the other, as plain text."""
    return _col(c).contains(_col(part))


def default_label(c: Column | str, default: str = fv.UNKNOWN_LABEL) -> Column:
    """Null or empty becomes the default label."""
    return F.coalesce(F.nullif(_col(c), F.lit("")), F.lit(default))


def replace_first(c: Column | str, pattern: str, replacement: str = "") -> Column:
    """Replace the first match only (Spark's ``regexp_replace`` replaces all)."""
    return F.regexp_replace(_col(c), rf"(?s)^(.*?)(?:{pattern})", "$1" + replacement)


def clean_os_name(c: Column | str) -> Column:
    """Full OS name without vendor, symbols and spelling variants."""
    return reduce(lambda acc, rule: F.regexp_replace(acc, *rule), fv.OS_NAME_CLEANING, _col(c))


def os_part(c: Column | str, i: int) -> Column:
    """``i``-th of the four words a cleaned OS name ends with; null if it has fewer than three."""
    matched = F.regexp_like(_col(c), F.lit(fv.OS_NAME_PARTS))
    return F.when(matched, F.trim(F.regexp_extract(_col(c), fv.OS_NAME_PARTS, i)))


def extended_support_suffix(group_id: Column | str) -> Column:
    """Suffix of an extended-support product group, null for any other group."""
    entries = [F.lit(x) for pair in fv.EXTENDED_SUPPORT.items() for x in pair]
    return F.element_at(F.create_map(*entries), _col(group_id))


def compliance_element(item: Column | str) -> Column:
    """Element a configuration item belongs to; the item itself when none matches."""
    result = None
    for mark, label in fv.COMPLIANCE_ELEMENTS:
        hit = _col(item).contains(mark)
        result = F.when(hit, label) if result is None else result.when(hit, label)
    return result.otherwise(_col(item))
