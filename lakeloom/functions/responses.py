"""Landed service responses: one response per row.

XML is searched with one XPath expression a response, gated by Spark's own XML reader, which
tells malformed text without failing.  Nothing leaves the JVM and no response is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeloom.constants import (
    BAD_STATUS_CODE_TEXT,
    BAD_XML_TEXT,
    ERROR_TEXT,
    EXPIRED_SESSION,
    EXPIRED_TEXT,
    FAILED_TEXT,
    NO_STATUS_TEXT,
)

LISTING = "struct<next:string,results:array<struct<url:string>>>"
#: States of a response's contents.
OK, EMPTY, UNREADABLE = "ok", "empty", "unreadable"


def response_items(df: DataFrame, body: str) -> DataFrame:
    """The item addresses of listing responses; ``is_last_page`` when no page follows.

    Every response has a row: one without items has the address NULL.  ``body_status`` tells
    ``ok``, ``empty`` and ``unreadable`` apart; whether a page follows an unreadable one is
    not known, so ``is_last_page`` is NULL."""
    page, items = F.col("__page"), F.col("__page.results")
    status = (
        F.when(page.isNull() | F.col("__bad"), UNREADABLE)
        .when(F.coalesce(F.size(items), F.lit(0)) == 0, EMPTY)
        .otherwise(OK)
    )
    parsed = F.from_json(F.col(body), f"{LISTING[:-1]},_corrupt:string>", {"columnNameOfCorruptRecord": "_corrupt"})
    return (
        df.withColumn("__page", parsed)
        .withColumn("__bad", F.coalesce(F.col("__page._corrupt").isNotNull(), F.lit(False)))
        .withColumn("body_status", status)
        .withColumn("is_last_page", F.when(F.col("body_status") != UNREADABLE, F.col("__page.next").isNull()))
        .withColumn("__item", F.explode_outer(items))
        .select(*df.columns, "is_last_page", "body_status", F.col("__item.url").alias("item_url"))
    )


_ROOT = "lakeloom-root"


def _inner(body: Column) -> Column:
    """The text without what may only stand at its very start: XML declaration, document type."""
    text = F.regexp_replace(body, r"^<\?xml\s[^>]*\?>", "")
    before = r"^((?:\s++|<!--(?s:.*?)-->|<\?(?s:.*?)\?>)*+)"
    return F.regexp_replace(text, before + r"<!DOCTYPE[^>\[]*>", "$1")


_ASIDE = r"(?s)<!--.*?-->|<!\[CDATA\[.*?\]\]>|<\?.*?\?>"


def _searchable(text: Column) -> Column:
    """The same contents without what splits a text in two: comments and instructions go, and
    character sections become escaped text."""

    def plain(aside: Column) -> Column:
        inner = F.substr(aside, F.lit(10), F.length(aside) - 12)
        inner = F.replace(F.replace(inner, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))
        return F.when(F.startswith(aside, F.lit("<![CDATA[")), inner).otherwise("")

    between = F.split(text, _ASIDE)
    asides = F.concat(F.regexp_extract_all(text, F.lit(_ASIDE), F.lit(0)), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(between, asides, lambda b, a: F.concat(b, plain(a))), "")
    return F.when(text.rlike(r"<[!?]"), whole).otherwise(text)


def _wrapped(text: Column) -> Column:
    return F.concat(F.lit(f"<{_ROOT}>"), text, F.lit(f"</{_ROOT}>"))


def _readable(body: Column) -> Column:
    """Whether the text is whole elements.  The reader stops after an element, so the text is
    put into one, which must then be whole; only such text is searched, by ``_is_one``
    for what lies at its top."""
    inner = _inner(body)
    read = F.from_xml(_wrapped(inner), "_corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    return body.isNotNull() & ~F.contains(inner, F.lit(_ROOT)) & read["_corrupt"].isNull()


#: One element at the top and nothing else but white space.
_IS_ONE = f"count(/{_ROOT}/*) = 1 and not(/{_ROOT}/text()[normalize-space()])"


def _elements(name: str) -> str:
    """XPath of the elements of a name that are in no namespace, at any depth."""
    return f"//{name}[not(namespace::*[name() = '' and string() != ''])]"


def _first_is(name: str, value: str) -> str:
    """XPath: whether the text of the first such element, up to a child, is ``value``."""
    return f"({_elements(name)})[1]/text()[not(preceding-sibling::*)] = '{value}'"


def _answers(body: Column, questions: list[str]) -> Column:
    """A number whose bits, from the lowest on, answer XPath questions in one evaluation."""
    asked = " + ".join(f"{1 << i} * boolean({q})" for i, q in enumerate(questions))
    return F.xpath_int(_wrapped(_searchable(_inner(body))), F.lit(asked))


def well_formed(body: Column) -> Column:
    """Whether a text is one XML element and nothing else but white space and comments."""
    one = F.when(_readable(body), _answers(body, [_IS_ONE]) == 1)
    return F.coalesce(one, F.lit(False))


def response_status(df: DataFrame, status_code: str, content_type: str, body: str) -> DataFrame:
    """Add ``response_error``: why a response is unusable, or NULL when it is fine.

    The first ``errorno`` and ``status`` count, at any depth, in no namespace.  Texts with an
    internal document type are unreadable; a prefix that isn't declared is no error."""
    is_xml = F.coalesce(F.lower(F.col(content_type)).contains("xml"), F.lit(False))
    is_ok = F.coalesce(F.col(status_code) == 200, F.lit(False))
    questions = [
        _IS_ONE,
        _elements("errorno"),
        _first_is("errorno", EXPIRED_SESSION),
        _elements("status"),
        _first_is("status", "failure"),
    ]
    text = F.col(body)
    found = F.when(is_ok & is_xml & _readable(text), _answers(text, questions))
    one, error, expired, status, failed = (
        F.col("__found").bitwiseAND(1 << i) != 0 for i in range(len(questions))
    )
    reason = (
        F.when(~is_ok, BAD_STATUS_CODE_TEXT)
        .when(~is_xml, F.lit(None).cast("string"))
        .when(~F.coalesce(one, F.lit(False)), BAD_XML_TEXT)
        .when(expired, EXPIRED_TEXT)
        .when(error, ERROR_TEXT)
        .when(~status, NO_STATUS_TEXT)
        .when(failed, FAILED_TEXT)
    )
    return df.withColumn("__found", found).withColumn("response_error", reason).drop("__found")


def response_fields(df: DataFrame, body: str) -> DataFrame:
    """One row per field identifier listed in an object description: the text of a field's
    first ``ID``, up to a child, where it has any.

    Every response has a row: one without identifiers has NULL.  ``body_status`` tells ``ok``,
    ``empty`` and ``unreadable`` apart."""
    text, in_none = F.col(body), "[not(namespace::*[name() = '' and string() != ''])]"
    ids = f"{_elements('Field')}/ID{in_none}[1]/text()[not(preceding-sibling::*)]"
    # A mark comes first in a text that is one element, so that one evaluation tells both.
    marked = F.concat(F.lit(f"<{_ROOT} one='1'>"), _searchable(_inner(text)), F.lit(f"</{_ROOT}>"))
    found = F.when(_readable(text), F.xpath(marked, F.lit(f"/{_ROOT}[{_IS_ONE}]/@one | {ids}")))
    status = (
        F.when(F.col("__ids").isNull(), UNREADABLE).when(F.size("__ids") == 0, EMPTY).otherwise(OK)
    )
    listed = F.when(F.element_at("__found", 1) == "1", F.slice("__found", 2, F.size("__found")))
    return (
        df.withColumn("__found", found)
        .withColumn("__ids", F.when(F.size("__found") > 0, listed))
        .withColumn("body_status", status)
        .withColumn("field_id", F.explode_outer("__ids"))
        .select(*df.columns, "body_status", "field_id")
    )
