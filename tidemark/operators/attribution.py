"""Which series a clause names, and which of its numbers are that series' own.

Channels are a table of ids and titles, of any size. A title's words are split into measures, restrictions and concepts; a
channel is posted under few of its words, the rarest ones that a clause can't miss, and clauses meet channels by an equality
join on those words alone. What the join finds is checked against all that the title needs.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.numbers import claimed, let, lexed
from tidemark.functions.text import clauses, sentences
from tidemark.operators.windows import dealt
from tidemark.storage import materialize

LEAST_LETTERS = 3
#: Distinct words of titles up to which clauses are cut to them before they are written; of more, whole clauses are.
TITLE_WORDS = 20_000
#: Distinct clauses of which a task reads the numbers and words, about.
TASK_CLAUSES = 20_000
#: Characters up to which what is found in distinct clauses is broadcast to the rows that say them, each with its clause's text; of more, both sides are shuffled.
BROADCAST_CHARS = 16_000_000


@dataclass(frozen=True)
class Vocabulary:
    """measures must be named exactly; restrictions too, and those of them that are guards keep all other channels out of a clause that has them; generic words name nothing; synonyms are read as the word they stand for."""

    # Fixed values, by default those of price and output statistics.
    measures: tuple[str, ...] = ("cpi", "cpih", "gdp", "ppi", "rpi")
    restrictions: tuple[str, ...] = ("adjusted", "contribution", "core", "excluding", "seasonally")
    guards: tuple[str, ...] = ("contribution", "core", "excluding")
    generic: tuple[str, ...] = ("and", "for", "index", "rate", "the", "total")
    synonyms: dict[str, str] = field(default_factory=lambda: {"except": "excluding", "excludes": "excluding", "contributions": "contribution", "clothes": "clothing"})


ENGLISH = Vocabulary()


def word_form(w: Column, vocabulary: Vocabulary = ENGLISH) -> Column:
    """A lower-case word in the form in which words are compared: its synonym, or itself without a plural s."""
    bare = F.when((F.length(w) > LEAST_LETTERS) & w.endswith("s") & ~w.endswith("ss"), F.substring(w, F.lit(1), F.length(w) - 1)).otherwise(w)
    known = F.create_map(*[F.lit(x) for kv in vocabulary.synonyms.items() for x in kv]) if vocabulary.synonyms else F.create_map().cast("map<string,string>")
    return F.coalesce(F.try_element_at(known, w), F.when(w.isin(*vocabulary.measures, *vocabulary.restrictions), w), bare)


def word_forms(text: Column, vocabulary: Vocabulary = ENGLISH) -> Column:
    """The words of a text by place among its tokens; an empty string where a token is no word."""
    return F.transform(lexed(text), lambda t: F.when(t["w"].rlike(r"^\p{L}"), word_form(t["w"], vocabulary)).otherwise(""))


def clauses_of(df: DataFrame, key: list[str], text: str, vocabulary: Vocabulary = ENGLISH) -> DataFrame:
    """key, clause (from 0), text, places (word_forms), words (distinct ones): what lies between ends of sentences or semicolons. A null text has no clauses."""
    parts = df.select(*key, F.posexplode(F.flatten(F.transform(sentences(F.col(text)), clauses))).alias("clause", "text"))
    return _with_words(parts, vocabulary)


def _with_words(parts: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """parts, of one clause each, with places and words."""
    return parts.withColumn("places", word_forms(F.col("text"), vocabulary)).withColumn("words", F.array_remove(F.array_distinct("places"), ""))


def titles_of(channels: DataFrame, id_: str, title: str, vocabulary: Vocabulary = ENGLISH) -> DataFrame:
    """channel, strict (measures and restrictions), concepts: the distinct words of a title."""
    words = F.array_distinct(F.filter(word_forms(F.col(title), vocabulary), lambda w: F.length(w) > 0))
    strict = lambda w: w.isin(*vocabulary.measures, *vocabulary.restrictions)
    rows = channels.select(F.col(id_).alias("channel"), words.alias("words"))
    return rows.select("channel", F.filter("words", strict).alias("strict"), F.filter("words", lambda w: ~strict(w) & ~w.isin(*vocabulary.generic) & (F.length(w) >= LEAST_LETTERS)).alias("concepts"))


def calibrated(titles: DataFrame, told: DataFrame, coverage: float) -> DataFrame:
    """told: word, a row for each clause that has it. channel, strict, concepts (those that any clause has; others are notation), need (how many of them a clause must name), posts (words of which a clause that names the channel has one at least).

    A title of which nothing is left names nothing and goes. A title with measures or restrictions is posted under the rarest of
    those; one without, under so many of its rarest concepts that a clause can't miss all of them.
    """
    mine = titles.select(F.explode(F.array_union("strict", "concepts")).alias("word")).distinct()
    often = materialize(told.groupBy("word").agg(F.count("*").alias("n")).join(mine, "word"), "told-words")
    each = titles.select("channel", F.explode("concepts").alias("word")).join(often, "word").groupBy("channel").agg(F.sort_array(F.collect_list(F.struct("n", "word"))).alias("found"))
    strict = titles.select("channel", F.explode("strict").alias("word")).join(often, "word", "left").groupBy("channel").agg(F.min_by("word", F.struct(F.coalesce("n", F.lit(0)), F.col("word"))).alias("rarest"))
    need = F.when(F.size("concepts") > 0, F.greatest(F.lit(1), F.floor(F.lit(coverage) * F.size("concepts") + 0.5).cast("int"))).otherwise(0)
    rows = titles.select("channel", "strict").join(each, "channel", "left").join(strict, "channel", "left")
    rows = rows.withColumn("concepts", F.coalesce(F.transform("found", lambda x: x["word"]), F.array().cast("array<string>"))).withColumn("need", need)
    posts = F.when(F.col("rarest").isNotNull(), F.array("rarest")).otherwise(F.slice("concepts", F.lit(1), F.size("concepts") - F.col("need") + 1))
    return rows.where("size(strict) + size(concepts) > 0").select("channel", "strict", "concepts", "need", posts.alias("posts"))


def _title_words(rows: DataFrame, titles: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """rows with, of words, those that a title has and the guards: no others say which channels a clause names."""
    mine = [r.word for r in titles.select(F.explode(F.array_union("strict", "concepts")).alias("word")).distinct().limit(TITLE_WORDS + 1).collect()]
    if len(mine) > TITLE_WORDS:
        return rows
    # One literal list, which Spark looks up by hash; a list of Columns takes a call to the JVM for each.
    known = ", ".join("'" + w.replace("\\", "\\\\").replace("'", "\\'") + "'" for w in ["", *mine, *vocabulary.guards])
    return rows.withColumn("words", F.expr(f"filter(words, w -> w in ({known}))"))


def named(clause_rows: DataFrame, key: list[str], channels: DataFrame, id_: str, title: str, vocabulary: Vocabulary = ENGLISH, coverage: float = 0.8) -> DataFrame:
    """key, clause, channel, matched (the title's words that the clause has): the channels that each clause of clauses_of names.

    A clause names a channel if it has all its measures and restrictions, `coverage` of its concepts (of those that any clause
    has), and no guard that isn't one of the channel's restrictions. A channel whose matched words are a proper part of another's
    is not named, nor is one with equal matched words that lacks more of its own. Titles of equal words are all named. Empty tables name nothing.
    """
    titles = titles_of(channels, id_, title, vocabulary)
    rows = materialize(_title_words(clause_rows.select(*key, "clause", "words"), titles, vocabulary), "clauses")
    titles = materialize(calibrated(titles, rows.select(F.explode("words").alias("word")), coverage), "titles")
    # A clause's words come back only for the channels that it meets: rows of single words don't carry all of them.
    posted = titles.select("channel", F.explode("posts").alias("word"))
    met = rows.select(*key, "clause", F.explode("words").alias("word")).join(posted, "word").select(*key, "clause", "channel").distinct()
    # Clauses are never broadcast: on disk they take little, as texts repeat, and in the driver all of their lists.
    met = met.join(titles.drop("posts"), "channel").join(rows.where(F.size("words") > 0).hint("merge"), [*key, "clause"])
    guards = F.array(*map(F.lit, vocabulary.guards)).cast("array<string>")
    said = F.size(F.array_except("strict", "words")) == 0
    kept_out = F.size(F.array_except(F.array_intersect("words", guards), "strict")) > 0
    concepts = F.array_intersect("concepts", "words")
    found = met.where(said & ~kept_out & (F.size(concepts) >= F.col("need"))).select(*key, "clause", "channel", F.sort_array(F.array_union("strict", concepts)).alias("matched"), (F.size("concepts") - F.size(concepts)).alias("_lacks"))
    rivals = F.collect_set(F.struct("matched", "_lacks")).over(Window.partitionBy(*key, "clause"))
    more = lambda r: (F.size(r["matched"]) > F.size("matched")) | ((F.size(r["matched"]) == F.size("matched")) & (r["_lacks"] < F.col("_lacks")))
    beaten = F.exists("_rivals", lambda r: more(r) & (F.size(F.array_except("matched", r["matched"])) == 0))
    return found.withColumn("_rivals", rivals).where(~beaten).drop("_rivals", "_lacks")


def attributed(df: DataFrame, key: list[str], text: str, channels: DataFrame, id_: str, title: str, most: int = 3, within: int | None = None, vocabulary: Vocabulary = ENGLISH, coverage: float = 0.8) -> DataFrame:
    """key, clause, at (place among the clause's tokens), value, kind, channel: the claimed numbers of each clause with the channels that they may be of.

    A number belongs to the channels named between it and the number before it; where none is, to those that the number before
    it belongs to; where none stands before it, to all that the clause names. Numbers that more than `most` channels could own
    are ambiguous and belong to none. within: a channel's nearest word must stand at most so many tokens from the number.

    What a clause says hangs on its text alone, so each distinct clause is cut into tokens and attributed once, however many
    rows say it; they meet by the text. Keys may repeat or be null.
    """
    said = materialize(clauses_of(df, key, text, vocabulary).select(*key, "clause", "text").where(F.col("text").rlike("[0-9]")), "figure-clauses")
    once = dealt(materialize(said.select("text").distinct(), "distinct-clauses"), ["text"], TASK_CLAUSES).select(F.monotonically_increasing_id().alias("of"), F.lit(0).alias("clause"), "text")
    # Filtered as it is read back: a filter before it is written would work the numbers out twice.
    rows = materialize(_with_words(once, vocabulary).withColumn("numbers", claimed(F.col("text"))), "claiming-clauses").where(F.size("numbers") > 0)
    found = _attributed(rows, channels, id_, title, most, within, vocabulary, coverage)
    chars = rows.agg(F.sum(most * F.size("numbers") * F.length("text"))).first()[0] or 0  # of what is found, at most
    return said.join(F.broadcast(found) if chars <= BROADCAST_CHARS else found, "text").select(*key, "clause", "at", "value", "kind", "channel")


def _attributed(rows: DataFrame, channels: DataFrame, id_: str, title: str, most: int, within: int | None, vocabulary: Vocabulary, coverage: float) -> DataFrame:
    """text, at, value, kind, channel of rows: of, clause, text, places, words, numbers, a row for each distinct clause."""
    key = ["of"]
    who = named(rows, key, channels, id_, title, vocabulary, coverage)
    each = who.join(rows.select(*key, "clause", "text", "places", "numbers").hint("merge"), [*key, "clause"])
    at = F.filter(F.sequence(F.lit(0), F.size("places") - 1), lambda i: F.array_contains("matched", F.col("places")[i]))
    each = each.select(*key, "clause", "text", "channel", at.alias("names"), "numbers")

    def placed(x: Column) -> Column:
        """A number with the channel's last name before it: how many numbers stand before that name, and how far the nearest name is. Neither list goes on to rows of numbers."""
        mine = F.array_max(F.filter("names", lambda p: p < x["at"]))
        before = F.when(mine.isNotNull(), F.size(F.filter("numbers", lambda y: y["at"] < mine)))
        return F.struct(x["at"].alias("at"), x["value"].alias("value"), x["kind"].alias("kind"), before.alias("before"), F.array_min(F.transform("names", lambda p: F.abs(p - x["at"]))).alias("gap"))

    each = each.select(*key, "clause", "text", "channel", F.inline(F.transform("numbers", placed)))
    w = Window.partitionBy(*key, "clause", "at")
    # Named after the same number as the nearest name is: those compete.
    owns = F.col("_last").isNull() | (F.col("before") == F.col("_last"))
    owners = each.withColumn("_last", F.max("before").over(w)).where(owns).withColumn("_n", F.count("*").over(w)).where(F.col("_n") <= most)
    if within is not None:
        owners = owners.where(F.col("gap") <= within)
    return owners.select("text", "at", "value", "kind", "channel")


def directions(df: DataFrame, key: list[str], text: str, channels: DataFrame, id_: str, title: str, up: tuple[str, ...], down: tuple[str, ...], vocabulary: Vocabulary = ENGLISH, coverage: float = 0.8) -> DataFrame:
    """key, channel, ups, downs: words of rise and fall in the clauses of a text that name a channel and no other. Channels that none names have no row; null texts name none."""
    rows = materialize(clauses_of(df, key, text, vocabulary).select(*key, "clause", "text", "words"), "direction-clauses")
    who = named(rows, key, channels, id_, title, vocabulary, coverage).withColumn("_n", F.count("*").over(Window.partitionBy(*key, "clause"))).where("_n = 1")
    said = F.transform(lexed(F.col("text")), lambda t: t["w"])
    count = lambda side: F.size(F.filter(said, lambda w: w.isin(*side)))
    each = who.join(rows.select(*key, "clause", count(up).alias("_up"), count(down).alias("_down")).hint("merge"), [*key, "clause"])
    return each.groupBy(*key, "channel").agg(F.sum("_up").alias("ups"), F.sum("_down").alias("downs"))
