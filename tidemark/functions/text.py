"""Text expressions: normalising, splitting, chunking, HTML, ratios. All are JVM expressions over whole texts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Abbreviations whose full stop ends no sentence.
ABBREVIATIONS = ("Mr", "Mrs", "Dr", "St", "No", "vs", "etc", "approx", "U.S")
MARK, DOT = "\x01", "\x02"


def collapse_space(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"[ \t\n\r\f\x0B]+", " "))


def slug(text: Column) -> Column:
    return F.btrim(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), F.lit("-"))


def plain_dashes(text: Column) -> Column:
    """Minus, en and em dashes to a hyphen, no-break spaces to spaces."""
    return F.translate(text, "−–— ", "--- ")


def sentences(text: Column) -> Column:
    """Sentences end in . ! or ? before blanks; full stops of abbreviations and inside numbers end none."""
    masked = F.regexp_replace(text, r"\b(" + "|".join(a.replace(".", r"\.") for a in ABBREVIATIONS) + r")\.", f"$1{DOT}")
    parts = F.split(F.regexp_replace(masked, r"([.!?])[ \n]+", f"$1{MARK}"), MARK)
    return F.filter(F.transform(parts, lambda s: F.trim(F.translate(s, DOT, "."))), lambda s: s != "")


def clauses(sentence: Column) -> Column:
    return F.filter(F.transform(F.split(sentence, ";"), lambda s: F.trim(s)), lambda s: s != "")


def paragraphs(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), lambda s: F.trim(s)), lambda s: s != "")


def between(text: Column, start: str, stops: tuple[str, ...]) -> Column:
    """What follows the first `start`, up to the earliest stop after it, or the end; null without start."""
    at = F.locate(start, text)
    rest = F.substring(text, at + len(start), F.length(text))
    ends = [F.when(F.locate(s, rest) > 0, F.locate(s, rest) - 1) for s in stops]
    return F.when(at > 0, F.substring(rest, F.lit(1), F.coalesce(F.least(*ends) if len(ends) > 1 else ends[0], F.length(rest))))


def first_sentences(parts: Column, cap: int) -> Column:
    """As many leading sentences, joined by blanks, as fit into cap characters; at least one."""
    total = lambda s, x: s["n"] + F.length(x) + F.when(s["n"] > 0, 1).otherwise(0)
    step = lambda s, x: F.struct(F.when(s["open"] & ((s["k"] == 0) | (total(s, x) <= cap)), total(s, x)).otherwise(s["n"]).alias("n"), (s["k"] + F.when(s["open"] & ((s["k"] == 0) | (total(s, x) <= cap)), 1).otherwise(0)).alias("k"), (s["open"] & ((s["k"] == 0) | (total(s, x) <= cap))).alias("open"))
    k = F.aggregate(parts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("k"), F.lit(True).alias("open")), step, lambda s: s["k"])
    return F.array_join(F.slice(parts, F.lit(1), k), " ")


def truncated_words(text: Column, cap: int) -> Column:
    """Blanks collapsed; a text of over cap characters ends with the last whole word that leaves room for three dots, which follow it. A first word that is too long itself is cut."""
    flat = collapse_space(text)
    head = F.substring(flat, 1, cap - 3)
    whole = F.when(F.substring(flat, cap - 2, 1) == " ", head).otherwise(F.regexp_replace(head, r" [^ ]*$", ""))
    return F.when(F.length(flat) <= cap, flat).otherwise(F.concat(whole, F.lit("...")))


def _leading(parts: Column, cost: Callable[[Column], Column], between: int, cap: int) -> Column:
    """How many leading parts fit into cap, each with its cost and `between` before all but the first."""

    def step(s: Column, x: Column) -> Column:
        total = s["n"] + cost(x) + F.when(s["k"] > 0, between).otherwise(0)
        fits = s["open"] & (total <= cap)
        return F.struct(F.when(fits, total).otherwise(s["n"]).cast("int").alias("n"), (s["k"] + fits.cast("int")).alias("k"), fits.alias("open"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("n"), F.lit(0).alias("k"), F.lit(True).alias("open")), step, lambda s: s["k"])


def truncated_lines(text: Column, cap: int) -> Column:
    """As many leading whole lines as fit into cap characters with their newlines; a first line that is too long is cut."""
    parts = F.split(text, "\n")
    k = _leading(parts, F.length, 1, cap)
    return F.when(k > 0, F.array_join(F.slice(parts, F.lit(1), k), "\n")).otherwise(F.substring(text, 1, cap))


def truncated_paragraphs(text: Column, cap: int) -> Column:
    """As many leading paragraphs, joined by a blank line, as fit into cap characters; at least one, whole."""
    parts = paragraphs(text)
    return F.array_join(F.slice(parts, F.lit(1), F.greatest(_leading(parts, F.length, 2, cap), F.lit(1))), "\n\n")


def truncated_tokens(text: Column, cap: int) -> Column:
    """As many leading words (runs without blanks) as have cap tokens, of four characters begun each, joined by blanks."""
    parts = F.split(collapse_space(text), " ")
    return F.array_join(F.slice(parts, F.lit(1), _leading(parts, lambda w: F.ceil(F.length(w) / 4).cast("int"), 0, cap)), " ")


def short_paragraphs(parts: Column, cap: int) -> Column:
    """Paragraphs of over cap characters as pieces of whole sentences, as many to a piece as fit; a sentence that is too long by itself is a piece."""

    def pieces(p: Column) -> Column:
        def step(s: Column, x: Column) -> Column:
            last = F.try_element_at(s, F.lit(-1))
            fits = last.isNotNull() & (F.length(last) + 1 + F.length(x) <= cap)
            return F.when(fits, F.concat(F.slice(s, 1, F.size(s) - 1), F.array(F.concat(last, F.lit(" "), x)))).otherwise(F.concat(s, F.array(x)))

        return F.when(F.length(p) <= cap, F.array(p)).otherwise(F.aggregate(sentences(p), F.array().cast("array<string>"), step))

    return F.flatten(F.transform(parts, pieces))


def html_to_text(html: Column) -> Column:
    """Scripts, styles and comments go with what is in them, tags become blanks, the five basic entities their characters."""
    out = F.regexp_replace(html, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->", " ")
    out = F.regexp_replace(out, r"<[^>]*>", " ")
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(char))
    return collapse_space(out)


def links(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(r'href="([^"]*)"'), 1)


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, no utm_ parameters, no trailing ? & or /."""
    bare = F.regexp_replace(url, r"#.*$", "")
    bare = F.regexp_replace(bare, r"utm_[a-z]+=[^&]*&?", "")
    bare = F.regexp_replace(bare, r"[?&/]+$", "")
    head = F.regexp_extract(bare, r"^([A-Za-z]+://[^/?]*)", 1)
    return F.concat(F.lower(head), F.substring(bare, F.length(head) + 1, F.length(bare)))


def detokenise(text: Column) -> Column:
    out = F.regexp_replace(text, r" ([,.;:!?%)])", "$1")
    out = F.regexp_replace(out, r"([($#@]) ", "$1")
    return F.regexp_replace(out, " '", "'")


def symbol_share(text: Column) -> Column:
    """Share of characters that are neither letters, digits, blanks nor common punctuation."""
    odd = F.length(F.regexp_replace(text, r"[\p{L}0-9 \n.,;:'-]", ""))
    return F.when(F.length(text) > 0, odd / F.length(text)).otherwise(0.0)


def has_any_group(text: Column, groups: list[list[str]]) -> Column:
    """Whether all words of any group occur."""
    low = F.lower(text)
    out = F.lit(False)
    for words in groups:
        hit = F.lit(True)
        for w in words:
            hit = hit & low.contains(w)
        out = out | hit
    return out
