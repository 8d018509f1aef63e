"""Column expressions that read dirty labels, months, areas and numbers; all stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month-name stems, English and French, in calendar order.
MONTH_STEMS = (
    ("jan",), ("feb", "fév", "fev"), ("mar",), ("apr", "avr"), ("may", "mai"), ("jun", "juin"),
    ("jul", "juil"), ("aug", "aoû", "aou"), ("sep",), ("oct",), ("nov",), ("dec", "déc"),
)
FOOTNOTE = r"[(\[](?:[0-9]{1,2}|[a-z])[)\]]|[¹²³⁴-⁹†‡*]+"


def squeeze(c: Column) -> Column:
    """Blanks of any kind to one space, dashes of any kind to a hyphen, ends trimmed."""
    c = F.regexp_replace(c, r"[\p{Z}\s\u200b\ufeff]+", " ")
    return F.trim(F.regexp_replace(c, r"[\u2010-\u2015\u2212]", "-"))


def label(c: Column) -> Column:
    """Lower-case words of a label without footnote marks; null if nothing is left."""
    plain = F.regexp_replace(F.lower(squeeze(c)), FOOTNOTE, " ")
    words = F.regexp_replace(F.regexp_replace(plain, "&", " and "), r"[^\p{L}\p{N}]+", " ")
    return F.nullif(F.trim(words), F.lit(""))


def slug(c: Column) -> Column:
    return F.replace(label(c), F.lit(" "), F.lit("_"))


def lookup(key: Column, names: dict[str, str]) -> Column:
    """``names[key]``, null where absent; the key expression is evaluated once."""
    pairs = [F.lit(x) for item in names.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), key)


# How the publisher's labels begin, and the names used for them.
DWELLINGS = {"total": "total", "semi": "semi_detached", "single": "single_detached", "row": "row", "apartment": "apartment_and_other"}
MEASURES = {"start": "housing_starts", "completion": "housing_completions", "under construction": "housing_under_construction"}
MEMBERS = {
    "homeowner": "starts_homeowner", "rental": "starts_rental", "condo": "starts_condominium", "condominium": "starts_condominium",
    "coop": "starts_cooperative", "cooperative": "starts_cooperative", "othermarket": "starts_other_market",
}
# The publisher's own spellings, looked up before any reading of the label.
USUAL = {
    "Total units": "total", "Single-detached units": "single_detached", "Semi-detached units": "semi_detached", "Row units": "row", "Apartment and other unit types": "apartment_and_other",
    "Housing starts": "housing_starts", "Housing completions": "housing_completions", "Housing under construction": "housing_under_construction",
    "Homeowner": "starts_homeowner", "Rental": "starts_rental", "Condo": "starts_condominium", "Co-op": "starts_cooperative", "Other market": "starts_other_market",
}


def dwelling_type(c: Column) -> Column:
    """total, single_detached, semi_detached, row, apartment_and_other; others become unmapped_<slug>."""
    key = F.regexp_extract(label(c), rf"^({'|'.join(DWELLINGS)})", 1)
    return F.coalesce(lookup(c, USUAL), lookup(key, DWELLINGS), F.concat(F.lit("unmapped_"), slug(c)))


def measure_column(c: Column) -> Column:
    return F.coalesce(lookup(c, USUAL), lookup(F.regexp_extract(label(c), rf"\b({'|'.join(MEASURES)})s?\b", 1), MEASURES), slug(c))


def member_column(c: Column) -> Column:
    key = F.regexp_extract(label(c), r"^(home ?owner|rental|condo(?:minium)?|co ?op(?:erative)?|other market)s?$", 1)
    return F.coalesce(lookup(c, USUAL), lookup(F.replace(key, F.lit(" "), F.lit("")), MEMBERS), F.concat(F.lit("starts_"), slug(c)))


def ref_month(c: Column) -> Column:
    """'yyyy-MM' of any clear spelling of one month (2024-03, 2024/3, 2024M03, 202403, 03/2024, Mar 2024, 2024-03-01)."""
    t = F.lower(squeeze(c))
    year_first = F.regexp_replace(t, r"^([0-9]{4}) ?[-/.m ]? ?([0-9]{1,2})(?:[-/.][0-9]{1,2}(?:[t ].*)?)?$", "$1-0$2")
    plain = F.regexp_replace(year_first, r"^(?:[0-9]{1,2}[-/.])?([0-9]{1,2})[-/.]([0-9]{4})$", "$2-0$1")
    clear = F.nullif(F.regexp_extract(plain, r"^([0-9]{4}-)0*(?:[1-9]|1[0-2])$", 1), F.lit(""))
    by_number = F.concat(clear, F.lpad(F.regexp_extract(plain, r"-0*([1-9]|1[0-2])$", 1), 2, "0"))
    stems = {stem: f"{i:02d}" for i, some in enumerate(MONTH_STEMS, 1) for stem in some}
    by_name = F.concat(F.regexp_extract(t, r"\b([0-9]{4})\b", 1), F.lit("-"), lookup(F.regexp_extract(t, rf"\b({'|'.join(stems)})\p{{L}}*", 1), stems))
    usual = F.when(c.rlike(r"^[0-9]{4}-(?:0[1-9]|1[0-2])\z"), c)  # spares most rows the rest
    return F.coalesce(usual, by_number, F.when(by_name.rlike(r"^[0-9]{4}-"), by_name))


def area_code(dguid: Column) -> Column:
    """The three digits of a metropolitan-area DGUID of any vintage, else null."""
    return F.nullif(F.regexp_extract(F.trim(dguid), r"S0503([0-9]{3})$", 1), F.lit(""))


def area_name(c: Column) -> Column:
    """A place name without case, footnotes and '(CMA)', to look areas up by where the DGUID is missing."""
    return label(F.regexp_replace(F.lower(squeeze(c)), r"\((?:cma|rmr|ca)\)", " "))
