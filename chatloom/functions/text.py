"""The text layer as built-in expressions: patterns, language class, questions, URLs, mentions."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from chatloom.functions.lexicon import DOMAINS, QUESTION_EN, QUESTIONS, Domains, LanguageProfile, RegionProfile

#: White space as Python's str methods see it, for Java and RE2 character classes.
SPACES = r"\t\n\x0b\f\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_WORD = r"[\p{L}\p{N}_]"
URL = r"(?i)(https?://[^\s)>\],'\"]+)"


def strip(text: Column) -> Column:
    """str.strip()."""
    return F.regexp_replace(text, rf"^[{SPACES}]+|[{SPACES}]+$", "")


def java_pattern(pattern: str) -> str:
    """A Python pattern in Java's dialect with the same matches: Unicode words, boundaries and case."""
    out = pattern.replace(r"(?<!\w)", f"(?<!{_WORD})").replace(r"(?!\w)", f"(?!{_WORD})")
    out = out.replace(r"\b", f"(?:(?<!{_WORD})(?={_WORD})|(?<={_WORD})(?!{_WORD}))").replace(r"\w", _WORD)
    return out.replace(r"\s", f"[{SPACES}]")


def keyword_pattern(keyword: str) -> str:
    """The pattern of a keyword: raw if it starts with a boundary or group, verbatim if it isn't
    ASCII, else a whole word."""
    if keyword.startswith((r"\b", "(")):
        return keyword
    quoted = re.sub(r"([.^$*+?{}\[\]\\|()\-])", r"\\\1", keyword)
    return quoted if not keyword.isascii() else rf"(?<!\w){quoted}(?!\w)"


def folded(text: Column) -> Column:
    """Lower case, with the one letter that only matches s when case is ignored as s."""
    return F.translate(F.lower(text), "\u017f", "s")


def needle(keyword: str) -> str:
    """Letters that stand in every text that the keyword matches; empty if its pattern leaves none for sure."""
    if not keyword.startswith((r"\b", "(")):
        return keyword.lower()
    bare = re.sub(r"\\b|\\s\?|\(\w+\)\?|\w\?", "|", keyword.replace(r"\+", "\0"))
    if re.search(r"[\\\[\](){}*+.^$]", bare):
        return ""
    return max(bare.replace("\0", "+").split("|"), key=len).lower()


def any_keyword(text: Column, keywords: Sequence[str], lower: Column | None = None) -> Column:
    """Whether any of the keywords is in the text, whatever its case.

    A plain search for letters that a match must have (in `lower`, the folded text) goes before the
    pattern with its word boundaries, which few texts then reach.
    """
    pattern = text.rlike("(?iu)" + "|".join(f"(?:{java_pattern(keyword_pattern(k))})" for k in keywords))
    needles = {needle(k) for k in keywords}
    if "" in needles:
        return pattern
    return contains_any(folded(text) if lower is None else lower, sorted(needles)) & pattern


def labels(text: Column, keywords: Mapping[str, Sequence[str]], category: str = "", lower: Column | None = None) -> Column:
    """the labels found in the text, in the order of the dictionary. One array of small structs
    (category, label position, label). `lower` is the folded text, best a column of its own."""
    lower = folded(text) if lower is None else lower
    hits = [F.when(any_keyword(text, words, lower), F.struct(F.lit(category).alias("category"), F.lit(k).alias("pos"), F.lit(label).alias("label"))) for k, (label, words) in enumerate(keywords.items())]
    return F.array_compact(F.array(*hits))


def _class(profile: LanguageProfile) -> str:
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in profile.ranges) + "]"


def latin_tokens(text: Column) -> Column:
    """The number of lower-case Latin words, of which stop words are a share."""
    return F.regexp_count(F.lower(text), F.lit("[a-zà-ÿ]+"))


def _stop_words(profile: LanguageProfile) -> str:
    """The pattern of a whole Latin word that is one of the profile's stop words."""
    words = sorted(w for w in profile.stopwords if re.fullmatch("[a-zà-ÿ]+", w))
    return "(?<![a-zà-ÿ])(?:" + "|".join(words) + ")(?![a-zà-ÿ])"


def target_ratio(text: Column, profile: LanguageProfile, tokens: Column | None = None) -> Column:
    """the share of the text that looks like the profile's language; 0 for text without any.
    `tokens` are the text's latin_tokens, best a column of their own where several profiles are asked."""
    if profile.ranges:
        # Most texts have no letter of the script: one look tells, without counting or copying.
        size = F.length(F.regexp_replace(text, f"[{SPACES}]", ""))
        share = F.try_divide(F.regexp_count(text, F.lit(_class(profile))).cast("double"), size)
        return F.when(text.rlike(_class(profile)), F.coalesce(share, F.lit(0.0))).otherwise(0.0)
    tokens = latin_tokens(text) if tokens is None else tokens
    hits = F.regexp_count(F.lower(text), F.lit(_stop_words(profile)))
    return F.coalesce(F.try_divide(hits.cast("double"), tokens), F.lit(0.0))


def _at_least(text: Column, n: int) -> Column:
    """Whether the text without blanks around it has n characters or more (n > 1), without copying it."""
    return text.rlike(f"(?s)[^{SPACES}].{{{n - 2},}}[^{SPACES}]")


def language_class(text: Column, profile: LanguageProfile | None, tokens: Column | None = None) -> Column:
    """F8: target, mixed, other or unknown. Null counts as empty, which is unknown. Without a profile
    all text is target."""
    text = F.coalesce(text, F.lit(""))
    blank = ~text.rlike(f"[^{SPACES}]")
    if profile is None:
        return F.when(blank, "unknown").otherwise("target")
    ratio = target_ratio(text, profile, tokens)
    out = F.when(blank, "unknown").when(ratio >= 0.7, "target").when(ratio >= profile.threshold, "mixed")
    if profile.ranges:
        several = _class(profile) + f"(?:(?s).*?{_class(profile)}){{2}}"  # three letters of the script
        out = out.when(text.rlike(several) & _at_least(text, 20), "mixed")
    return out.when(~_at_least(text, 5), "unknown").otherwise("other")


def is_question(text: Column, code: str | None = None) -> Column:
    """English cues, and those of the language if it has any. Null is no question."""
    pattern = QUESTION_EN if code not in QUESTIONS else f"(?:{QUESTION_EN})|(?:{QUESTIONS[code]})"
    return F.coalesce(text.rlike("(?iu)" + java_pattern(pattern)), F.lit(False))


def urls(text: Column) -> Column:
    """all URLs of the text, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(URL), F.lit(1))


def host(url: Column) -> Column:
    """What stands between the scheme and the next slash, in lower case (port and user included)."""
    return F.split_part(F.regexp_replace(F.lower(url), "^https?://", ""), F.lit("/"), F.lit(1))


def contains_any(text: Column, parts: Sequence[str]) -> Column:
    """Whether any of the parts stands in the text; parts are taken as they are."""
    found = F.lit(False)
    for part in parts:
        found = found | text.contains(part)
    return found


def url_category(url: Column, domains: Domains = DOMAINS) -> Column:
    """impersonator and official by any part of the URL, the other categories by the host."""
    lower, where = F.lower(url), host(url)
    out = F.when(contains_any(lower, domains.impersonator), "impersonator").when(contains_any(lower, domains.official), "official")
    for category, parts in domains.by_host:
        out = out.when(contains_any(where, parts), category)
    return out.otherwise("other")


def hour_bucket(hour: Column, region: RegionProfile) -> Column:
    """the first bucket whose hours (both ends included, over midnight if they run backwards) hold it."""
    out = None
    for name, low, high in region.hours:
        inside = hour.between(low, high) if low <= high else (hour >= low) | (hour <= high)
        out = F.when(inside, name) if out is None else out.when(inside, name)
    return (F.lit("other") if out is None else out.otherwise("other")).alias("bucket")


def language_primary(target: Column, mixed: Column, other: Column) -> Column:
    """where a user's messages lean; a mixed one counts half on either side."""
    total = target + mixed + other
    return (
        F.when(total == 0, "silent")
        .when(F.try_divide(target + 0.5 * mixed, total) >= 0.7, "target_primary")
        .when(F.try_divide(other + 0.5 * mixed, total) >= 0.7, "other_primary")
        .otherwise("bilingual")
    )


def retention_class(last_seen: Column, now: Column) -> Column:
    """by days since last seen, both limits included; unknown without a time."""
    return (
        F.when(last_seen.isNull() | now.isNull(), "unknown")
        .when(last_seen >= now - F.expr("INTERVAL 30 DAYS"), "active_30d")
        .when(last_seen >= now - F.expr("INTERVAL 90 DAYS"), "lapsed_30_90d")
        .otherwise("lapsed_90d_plus")
    )
