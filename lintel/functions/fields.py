"""Money, areas, dates and availability out of text, as native column expressions.

The sources disagree on how to read a number, so that there is one expression for each of them.
"today" is never read inside an expression: whoever needs it passes `as_of`.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import or_empty, strip

# What amounts, areas, days and availability look like in the sources.
MAN_AND_YEN, LARGE_YEN = r"(?U)(\d+(?:\.\d+)?)\s*万\s*(\d+)?", r"(?U)(\d{4,})\s*円?"
PAGE_MAN, LIST_MAN, LIST_YEN = r"([0-9]+(?:\.[0-9]+)?)\s*万", r"(\d+(?:\.\d+)?)\s*万円", r"(\d+)\s*円"
AREA_WITH_UNIT = r"(?Ui)(\d+(?:\.\d+)?)\s*(?:㎡|m2|m\^2)"
DAY, MONTH_AND_DAY = r"(\d{4})[/-](\d{1,2})[/-](\d{1,2})", r"(?U)(\d{1,2})\s*月\s*(\d{1,2})\s*日"
BUILT_MONTH, BUILT_AGE = r"(?U)(\d{4})\s*年\s*(\d{1,2})\s*月", r"(?U)\(\s*(\d+)\s*年\s*\)"
IMMEDIATE = r"(?U)即(?:\s*入(?:居|可)?)?"


def _number(col: Column, pattern: str, group: int = 1) -> Column:
    return F.nullif(F.regexp_extract(or_empty(col), pattern, group), F.lit(""))


# money ----------------------------------------------------------------------------------------


def yen_from_text(col: Column) -> Column:
    """`N万M` or `N円` (four digits at least), commas aside; else null."""
    text = F.replace(or_empty(col), F.lit(","), F.lit(""))
    base = _number(text, MAN_AND_YEN).cast("double") * 10000 + F.coalesce(_number(text, MAN_AND_YEN, 2).cast("double"), F.lit(0.0))
    return F.coalesce(base.cast("long"), _number(text, LARGE_YEN).cast("long"))


def yen_from_man(col: Column) -> Column:
    """A count of 万, strictly: empty is null, other text is an error."""
    return (F.nullif(strip(or_empty(col)), F.lit("")).cast("double") * 10000).cast("long")


def yen_from_sheet(col: Column) -> Column:
    """A count of 万 that may carry its unit; no number is null."""
    text = F.replace(F.replace(strip(or_empty(col)), F.lit(","), F.lit("")), F.lit("万円"), F.lit(""))
    return (text.try_cast("double") * 10000).cast("long")


def man_from_page(col: Column) -> Column:
    """万 as a double, from normalised text: a number before 万, else yen; a dash, 無 and なし are null."""
    text = F.regexp_replace(strip(or_empty(col)), "税込|税別", "")
    man = _number(text, PAGE_MAN).cast("double")
    yen = F.nullif(F.regexp_replace(text, r"[^0-9.]", ""), F.lit("")).try_cast("double") / 10000
    return F.when(~text.isin("", "-", "—", "–", "無", "なし"), F.coalesce(man, yen))


def yen_from_list(col: Column) -> Column:
    """`N万円` or `N円` of list pages."""
    text = F.replace(or_empty(col), F.lit(","), F.lit(""))
    return F.coalesce((_number(text, LIST_MAN).cast("double") * 10000).cast("long"), _number(text, LIST_YEN).cast("long"))


def fee_yen(col: Column) -> Column:
    """A fee in yen; none is 0."""
    text = F.replace(or_empty(col), F.lit(","), F.lit(""))
    return F.when(text.rlike("なし|無"), F.lit(0).cast("long")).otherwise(yen_from_list(col))


def format_yen(col: Column) -> Column:
    """With thousands separators, or a dash."""
    return F.coalesce(F.format_number(F.replace(strip(col.cast("string")), F.lit(","), F.lit("")).try_cast("double").cast("long"), 0), F.lit("—"))


# areas ----------------------------------------------------------------------------------------


def area_sqm(col: Column) -> Column:
    """A number with a unit of square metres."""
    return _number(col, AREA_WITH_UNIT).cast("double")


def area_any_unit(col: Column) -> Column:
    """The first number, with or without a unit."""
    return _number(col, r"(?U)(\d+(?:\.\d+)?)").cast("double")


def area_of_cell(col: Column) -> Column:
    """What digits and points of a cell make up; its unit does not matter."""
    return F.nullif(F.regexp_replace(F.regexp_replace(or_empty(col), "㎡|m2", ""), r"[^0-9.]", ""), F.lit("")).try_cast("double")


def area_strict(col: Column) -> Column:
    """A plain number; other text is an error."""
    return F.nullif(strip(or_empty(col)), F.lit("")).cast("double")


# whole numbers --------------------------------------------------------------------------------


def age_years(col: Column) -> Column:
    """A number of years truncated to whole ones; negative or no number: null."""
    value = strip(or_empty(col)).try_cast("double")
    return F.when(value >= 0, value.cast("int"))


def built_year(col: Column) -> Column:
    return F.nullif(F.regexp_extract(strip(or_empty(col)), r"^(\d{4})", 1), F.lit("")).cast("int")


def positive_or_null(col: Column) -> Column:
    return F.when(col > 0, col)


# dates ----------------------------------------------------------------------------------------


def year_month(col: Column) -> Column:
    """Index year * 12 + month of `YYYY-M` or `YYYY/M`; null for other text or months."""
    form = r"^(\d{4})[-/](\d{1,2})$"
    text = strip(or_empty(col))
    year, month = F.regexp_extract(text, form, 1).try_cast("int"), F.regexp_extract(text, form, 2).try_cast("int")
    return F.when(month.between(1, 12), year * 12 + month)


def built_age(col: Column, as_of: Column) -> Column:
    """Whole years from a year-month to `as_of` (date), at least 0."""
    gap = F.year(as_of) * 12 + F.month(as_of) - year_month(col)
    return F.when(gap.isNotNull(), F.greatest(F.floor(gap / 12).cast("int"), F.lit(0)))


def reference_date(col: Column) -> Column:
    """The first date in a text that has one of the usual forms."""
    parts = [F.regexp_extract(or_empty(col), DAY, k).try_cast("int") for k in (1, 2, 3)]
    return F.try_make_date(*parts) if hasattr(F, "try_make_date") else F.try_to_date(F.format_string("%04d-%02d-%02d", *parts), "yyyy-MM-dd")


def built(col: Column) -> Column:
    """struct(year_month, age) from text such as `2023年1月 (3年)`."""
    year, month = _number(col, BUILT_MONTH, 1).try_cast("int"), _number(col, BUILT_MONTH, 2).try_cast("int")
    return F.struct(
        F.when(month.between(1, 12), F.format_string("%04d-%02d", year, month)).alias("year_month"),
        _number(col, BUILT_AGE).try_cast("int").alias("age"),
    )


def availability(raw: Column, reference: Column, category: Column) -> Column:
    """struct(immediate, label, date): what a free-text availability says.

    A month before that of the reference date means the year after it."""
    text = strip(or_empty(raw))
    month, day = (F.regexp_extract(text, MONTH_AND_DAY, k).try_cast("int") for k in (1, 2))
    ref = reference_date(strip(or_empty(reference)))
    day_of = F.try_to_date(F.format_string("%04d-%02d-%02d", F.year(ref) + F.when(month < F.month(ref), 1).otherwise(0), month, day), "yyyy-MM-dd")
    empty, now = text == "", text.rlike(IMMEDIATE)
    blank_now = empty & (F.lower(strip(or_empty(category))) == "ulucks")
    dated = ~empty & ~now & month.isNotNull() & ref.isNotNull() & day_of.isNotNull()
    return F.struct(
        (blank_now | (~empty & now)).alias("immediate"),
        F.when(blank_now, "入居").when(empty, None).when(now, "即入居").when(dated, F.concat(month.cast("string"), F.lit("/"), day.cast("string"))).otherwise(text)
            .alias("label"),
        F.when(dated, F.date_format(day_of, "yyyy-MM-dd")).alias("date"),
    )


def updated_day(col: Column) -> Column:
    """The day of `2026年01月02日` or `2026/01/02` in a text as ISO text, else ''."""
    forms = (r"(?U)(\d{4})年\s*(\d{2})月\s*(\d{2})日", r"(\d{4})/(\d{2})/(\d{2})")
    days = [F.when(or_empty(col).rlike(p), F.concat_ws("-", *[F.regexp_extract(or_empty(col), p, k) for k in (1, 2, 3)])) for p in forms]
    return F.coalesce(*days, F.lit(""))


def summary_date(col: Column) -> Column:
    """A timestamp (without zone) from the eight usual spellings, or the first date in the text."""
    text = F.trim(F.regexp_replace(F.replace(F.translate(or_empty(col), "年月", "//"), F.lit("日"), F.lit("")), r"(?U)\s+", " "))
    form = r"^(\d{4})[-/](\d{1,2})(?:[-/](\d{1,2}))?(?: (\d{1,2}):(\d{1,2})(?::(\d{1,2}))?)?$"
    parts = [F.coalesce(F.regexp_extract(text, form, k).try_cast("int"), F.lit(1 if k == 3 else 0)) for k in range(1, 7)]
    whole = F.try_to_timestamp(F.format_string("%04d-%02d-%02d %02d:%02d:%02d", *parts), F.lit("yyyy-MM-dd HH:mm:ss"))
    return F.coalesce(F.when(text.rlike(form), whole), reference_date(text).cast("timestamp"))


def evidence_file(col: Column) -> Column:
    """The file in evidence such as `pdf:NAME#p=1`."""
    return F.nullif(F.regexp_extract(or_empty(col), "^pdf:([^#]+)", 1), F.lit(""))


def maps_url(col: Column) -> Column:
    text = strip(or_empty(col))
    return F.when(text != "", F.concat(F.lit("https://maps.google.com/?q="), F.url_encode(text)))
