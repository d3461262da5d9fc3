"""Text expressions. Everything runs inside the JVM; there is no Python UDF."""

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# Language codes with a stop-word list shipped with Spark.
STOP_LANGUAGES = {
    "da": "danish",
    "de": "german",
    "en": "english",
    "es": "spanish",
    "fi": "finnish",
    "fr": "french",
    "hu": "hungarian",
    "it": "italian",
    "nl": "dutch",
    "no": "norwegian",
    "pt": "portuguese",
    "ru": "russian",
    "sv": "swedish",
    "tr": "turkish",
}

# Store links and key formats.
LANDING_URL = "https://apps.apple.com/{country}/app/{app_name}/id{app_id}"
REQUEST_URL = "https://amp-api.apps.apple.com/v1/catalog/{country}/apps/{app_id}/reviews"
APP_LINK = r"https://apps\.apple\.com/[a-z]{2}/.+?/id([0-9]+)"
OFFSET_LINK = r"^.+offset=([0-9]+).*$"
FEED_DATE = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def stop_words(lang: str = "en") -> list[str]:
    """Default stop words of a language code; an unknown code is an error."""
    if lang not in STOP_LANGUAGES:
        raise ValueError(f"no stop-word list for language {lang!r}")
    return StopWordsRemover.loadDefaultStopWords(STOP_LANGUAGES[lang])


def strip_punct(text: Column) -> Column:
    """Every ASCII punctuation mark becomes one space; other marks stay."""
    return F.regexp_replace(text, r"\p{Punct}", " ")


def tokenize(text: Column) -> Column:
    """Lower-case, then split on every single whitespace character (empties stay)."""
    return F.split(F.lower(text), r"\s")


def remove_stop_words(words: Column, lang: Column | None = None, langs: list[str] | None = None) -> Column:
    """Drop stop words: the English list, or with ``lang`` the list of each row's language.

    Rows in a language outside ``langs`` (default: all lists) use the English list.
    """

    def without(code: str) -> Column:
        listed = stop_words(code)
        return F.filter(words, lambda w: ~w.isin(listed))

    if lang is None:
        return without("en")
    picked = None
    for code in langs or sorted(STOP_LANGUAGES):
        if code != "en":
            branch = lang == code
            picked = F.when(branch, without(code)) if picked is None else picked.when(branch, without(code))
    return without("en") if picked is None else picked.otherwise(without("en"))


def drop_empty(words: Column) -> Column:
    return F.array_remove(words, "")


def content_words(text: Column, lang: Column | None = None, langs: list[str] | None = None) -> Column:
    """Punctuation, case, stop words and empties removed, in that order."""
    return drop_empty(remove_stop_words(tokenize(strip_punct(text)), lang, langs))


def normalize_tokens(text: Column) -> Column:
    """Whitespace tokens reduced to lower-case letters; tokens without letters vanish.

    Non-letters are deleted in one pass over the text, before the split.
    """
    letters = F.regexp_replace(F.lower(text), r"[^\p{L}\s]", "")
    return drop_empty(F.split(letters, r"\s+"))


def slug(name: Column) -> Column:
    """Lower-case with every run of non-word characters or underscores as one dash."""
    return F.regexp_replace(F.lower(name), r"(?U)[\W_]+", "-")


def next_offset(link: Column) -> Column:
    """Offset of the next feed page; null at the end of the feed."""
    return number_after(link, OFFSET_LINK)


def number_after(link: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(link, pattern, 1), F.lit("")).cast("int")


def app_id_in(page: Column, pattern: str = APP_LINK) -> Column:
    """First app id linked from a page, null when there is none."""
    return F.nullif(F.regexp_extract(page, pattern, 1), F.lit(""))


def review_date(text: Column) -> Column:
    """Feed date, strictly in the feed's format, as an instant in the session's UTC zone.

    The shape is checked first so that a wrong one is null, not an error.
    """
    exact = text.rlike(r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z$")
    return F.when(exact, F.try_to_timestamp(text, F.lit(FEED_DATE)))


def fill_url(template: str, **parts: Column) -> Column:
    """Fill ``{name}`` slots of a URL template from columns."""
    pieces: list[Column] = []
    rest = template
    while "{" in rest:
        before, _, tail = rest.partition("{")
        name, _, rest = tail.partition("}")
        pieces += [F.lit(before), parts[name].cast("string")]
    return F.concat(*pieces, F.lit(rest))


def landing_url(country: Column, app_name: Column, app_id: Column) -> Column:
    return fill_url(LANDING_URL, country=F.lower(country), app_name=slug(app_name), app_id=app_id)


def request_url(country: Column, app_id: Column) -> Column:
    return fill_url(REQUEST_URL, country=F.lower(country), app_id=app_id)


def entity_key(store: Column, app_name: Column, app_id: Column, country: Column, lang: Column) -> Column:
    """Lower-cased data set key of an entity; the app name is skipped where a store has none."""
    name = F.concat_ws("_", app_name, app_id, country, lang)
    return F.concat(store, F.lit("/"), F.lower(name), F.lit(".parquet"))


def feed_review_id(user: Column, ts: Column, title: Column, text: Column) -> Column:
    """Stable id for reviews of a feed that carries none."""
    return F.sha2(F.concat_ws("\u0001", user, ts.cast("string"), title, text), 256)
