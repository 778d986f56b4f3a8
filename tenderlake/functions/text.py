"""Text column builders."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The label, limits, default word and ordered keyword lists below
# decide which value a record gets, so they must stay exactly as they are.
UNKNOWN = "Не указана"
ANNOUNCED = "Объявлена"
CUSTOMER_LABEL = "Заказчик"
REGION_LABEL = "Регион"
CUSTOMER_MAX = 100
REGION_MAX = 50
TITLE_MAX = 200
PRICE_PATTERN = r"(?U)Начальная[^:]*:\s*([0-9,.\s]+)"
NUMBER_PREFIX = "44-"
NUMBER_PATTERN = "registrationNumber=([^&]+)"
CATEGORY_KEYWORDS = {
    "Медицина": ["медицин", "фармац", "здоровь", "больниц", "клиник"],
    "Транспорт": ["авто", "машин", "транспорт", "дорог"],
    "Строительство": ["строи", "ремонт", "сметн", "проектн"],
    "Энергетика": ["электр", "энерг", "газ"],
    "IT": ["программ", "софт", "компьютер", "сервер", "систем"],
    "Образование": ["образов", "учеб", "школ", "универси"],
    "Жилье": ["жил", "дом", "квартир"],
    "Благоустройство": ["парк", "озелен", "скверы", "дорог"],
}


def search_text(*columns) -> Column:
    """Lower-cased columns joined by spaces; a NULL column is left out."""
    return F.lower(F.concat_ws(" ", *[_c(c) for c in columns]))


def contains_any_case(column, needle: str) -> Column:
    """Literal, Unicode case-insensitive substring test."""
    return F.contains(F.lower(_c(column)), F.lower(F.lit(needle)))


def equals_any_case(column, value: str) -> Column:
    return F.lower(_c(column)) == F.lower(F.lit(value))


def strip_tags(column) -> Column:
    """Visible text of an HTML fragment: no scripts, styles, comments or tags."""
    given = _c(column)
    # The pattern is slow; without one of its ends there is nothing to find.
    ends = F.contains(given, F.lit("</s")) | F.contains(given, F.lit("</S")) | F.contains(given, F.lit("-->"))
    text = F.when(ends, F.regexp_replace(given, r"(?is)<(?:script.*?</script[^>]*|style.*?</style[^>]*|!--.*?--)>", "")).otherwise(given)
    text = F.regexp_replace(text, r"<[^>]*>", "")
    plain = text
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(entity), F.lit(char))
    return F.when(F.contains(text, F.lit("&")), plain).otherwise(text)


def labelled_text(text, label: str) -> Column:
    """Rest of the line after ``label:``, trimmed; empty when absent."""
    return F.trim(F.regexp_extract(_c(text), rf"(?U){label}:\s*([^\n<]+)", 1))


def cut(found, max_length: int | None) -> Column:
    """The text, cut only where a length is given."""
    return _c(found) if max_length is None else F.substring(_c(found), 1, max_length)


def text_or_default(found, max_length: int | None = None, default: str = UNKNOWN) -> Column:
    """The text, or the default for an empty or missing one."""
    return F.when(_c(found) != "", cut(found, max_length)).otherwise(F.lit(default))


def labelled_value(text, label: str, max_length: int | None = None, default: str = UNKNOWN) -> Column:
    return text_or_default(labelled_text(text, label), max_length, default)


def labelled_price(text) -> Column:
    """Price after its label; spaces dropped, decimal comma accepted, 0 when absent."""
    digits = F.regexp_extract(_c(text), PRICE_PATTERN, 1)
    return F.coalesce(F.btrim(F.translate(digits, ", ", "."), F.lit(" \t\r\n")).try_cast("double"), F.lit(0.0))


def classify(lowered, keywords: dict[str, list[str]] = CATEGORY_KEYWORDS, default: str = UNKNOWN) -> Column:
    """First category, in order, one of whose keywords occurs in the lower-cased text."""
    lowered = _c(lowered)
    branches = F
    for category, words in keywords.items():
        hit = reduce(lambda a, b: a | b, [F.contains(lowered, F.lit(w)) for w in words])
        branches = branches.when(hit, F.lit(category))
    return branches.otherwise(F.lit(default))


def purchase_number(link, *others) -> Column:
    """Tender number from the link; a link without one is named by its own hash.

    An item without a link is named by the hash of its ``others``.
    """
    link = F.nullif(_c(link), F.lit(""))
    number = F.nullif(F.regexp_extract(link, NUMBER_PATTERN, 1), F.lit(""))
    content = F.concat_ws("\x1f", *[F.coalesce(_c(c), F.lit("")) for c in others]) if others else F.lit("")
    return F.concat(F.lit(NUMBER_PREFIX), F.coalesce(number, F.md5(link), F.md5(content)))


def padded_number(key) -> Column:
    """``44-`` and the key + 1,000,000 padded to seven digits."""
    return F.format_string(NUMBER_PREFIX + "%07d", _c(key).cast("bigint") + F.lit(1_000_000))


def content_hash(tender_no, description, budget) -> Column:
    """MD5 over number, description and budget; the budget enters as a decimal."""
    money = _c(budget).cast("decimal(20,2)").cast("string")
    return F.md5(F.concat(*[F.coalesce(part, F.lit("")) for part in (_c(tender_no), _c(description), money)]))


def single_spaced(text) -> Column:
    """Lower-cased text in which a run of white space is one space."""
    return F.regexp_replace(F.lower(_c(text)), r"(?U)\s\s+", " ")


def char_grams(text, low: int = 2, high: int = 3) -> Column:
    """All character n-grams of the text, spaces included, as an array.

    Runs of white space count as one space. Grams of one length are the grams
    one shorter zipped with the shifted characters, so the text is walked once
    per length whatever its size.
    """
    chars = F.split(single_spaced(text), "")
    level, grams = chars, []
    for n in range(2, high + 1):
        shifted = F.slice(chars, n, F.greatest(F.size(chars), F.lit(0)))
        level = F.zip_with(level, shifted, lambda head, char: F.concat(head, char))
        if n >= low:
            grams.append(level)
    return F.array_compact(F.concat(*grams))


def _c(column) -> Column:
    return F.col(column) if isinstance(column, str) else column
