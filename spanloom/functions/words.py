"""Expressions over names and report texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Stems of words that make a report relevant, by kind.
ATTACK = ["атак", "обстріл", "удар", "ракета", "ракет", "дрон", "бпла", "шахед", "влуч", "вибух"]
LOSS = ["загиб", "загин", "помер", "смерт"]
PLACE = ["київ", "києв", "столиц"]
#: Month names as they stand in dates.
MONTHS = ["січня", "лютого", "березня", "квітня", "травня", "червня", "липня", "серпня", "вересня", "жовтня", "листопада", "грудня"]
#: Patterns whose first group is a number of dead.
DEATHS = [
    r"\b(\d{1,3})\s+(?:люд\w*\s+)?загин\w*",
    r"\b(\d{1,3})\s+загибл\w*",
    r"загибл\w*\s+(?:щонайменше\s+|понад\s+)?(\d{1,3})\b",
    r"відомо\s+про\s+(\d{1,3})\s+загибл\w*",
    r"кільк\w*\s+загибл\w*[^.]{0,60}?\b(\d{1,3})\b",
]


def name_key(name: Column) -> Column:
    """Lower case, one kind of apostrophe, single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.translate(name, "’ʼ`", "'''")), r"\s+", " "))


def relevant(text: Column, place: list[str] = PLACE, attack: list[str] = ATTACK, loss: list[str] = LOSS) -> Column:
    """Whether a text holds a stem of each of the three kinds, in any case."""
    def holds(low: Column) -> Column:
        held = F.lit(True)
        for stems in (place, attack, loss):
            some = F.lit(False)
            for stem in stems:
                some = some | low.contains(stem)
            held = held & some
        return held

    # inside a list of one, so that the text is made and put in lower case once and not for each stem
    return F.coalesce(F.get(F.transform(F.array(F.lower(text)), holds), F.lit(0)), F.lit(False))


#: A text that each of ``DEATHS`` cannot be without.
DEATH_STEMS = ["загин", "загибл", "загибл", "відомо", "кільк"]


def counts_near(text: Column, patterns: list[str] = DEATHS, stems: list[str] | None = None, low: int = 1, high: int = 200) -> Column:
    """Distinct numbers that stand in the patterns' first groups, in range, sorted. Letters are those of any script.

    A pattern is only looked for in texts that hold its stem of ``stems`` (by default those of ``DEATHS``).
    """
    if stems is None:
        stems = DEATH_STEMS if patterns is DEATHS else [""] * len(patterns)
    lower, none = F.lower(text), F.array().cast("array<string>")
    found = F.concat(*[F.when(lower.contains(stem), F.regexp_extract_all(lower, F.lit(f"(?U){p}"), F.lit(1))).otherwise(none) for p, stem in zip(patterns, stems, strict=True)])
    numbers = F.transform(found, lambda x: x.try_cast("int"))
    return F.array_sort(F.array_distinct(F.filter(numbers, lambda x: (x >= low) & (x <= high))))


def dates_in(text: Column, year: Column, months: list[str] = MONTHS) -> Column:
    """Sorted distinct dates written as day and month name; the year counts if a word for it follows, else it is ``year``."""
    found = F.regexp_extract_all(F.lower(text), F.lit(rf"(?U)\b([0-3]?\d\s+(?:{'|'.join(months)})(?:\s+20\d{{2}}\s+року)?)\b"), F.lit(1))

    def made(written: Column) -> Column:
        part = F.split(written, r"\s+")
        number = F.array_position(F.array(*map(F.lit, months)), part[1]).cast("int")
        own = F.when(F.size(part) > 2, F.get(part, F.lit(2)).try_cast("int")).otherwise(year)
        return F.try_to_date(F.concat_ws("-", own, F.lpad(number.cast("string"), 2, "0"), F.lpad(part[0], 2, "0")), "yyyy-MM-dd")

    return F.array_sort(F.array_distinct(F.filter(F.transform(found, made), lambda d: d.isNotNull())))


#: Words before a value that mark it as a secret.
SECRET = r"(?i)\b(api[_-]?key|token|secret|password|authorization)\b"


def masked(text: Column, marks: str = SECRET) -> Column:
    """A text with the values behind words such as token or password replaced by ``***``."""
    return F.regexp_replace(text, rf"{marks}(\s*[:=]\s*(?:bearer\s+)?)[^\s,;\"']+", "$1$2***")


def plain_text(html: Column) -> Column:
    """Text of a page without scripts, styles, comments and tags, white space squeezed."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"(?s)<[^>]*>", " ")
    for name, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        bare = F.replace(bare, F.lit(name), F.lit(sign))
    return F.trim(F.regexp_replace(bare, r"\s+", " "))


def bare_url(url: Column) -> Column:
    """A web address without its fragment; null for other schemes."""
    return F.when(url.rlike(r"(?i)^https?://[^/\s]"), F.regexp_replace(url, "#.*$", ""))


def canonical_hash(*columns: Column) -> Column:
    """SHA-256 of the JSON of a struct of the given columns; a null field is not an absent one."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def episode_id(key: Column, start: Column, end: Column) -> Column:
    """The first 24 hex digits of SHA-256 over key, start and end text."""
    return F.substring(F.sha2(F.concat_ws("|", key, start, end), 256), 1, 24)
