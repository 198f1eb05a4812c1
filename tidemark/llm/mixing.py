"""Mixing sources to target weights: rake token weights to marginals, then sample documents by calibrated probabilities.

Only DataFrame functions. Documents are summed into cells (source, language, topic); iterative proportional fitting finds a
factor for each source, language and topic from the cells; the product of its three factors, times the budget, is the number
of copies that a document is expected to have in the sample.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import shared
from tidemark.llm.shared import join_narrow, materialize

#: Topic of a document: the first rule that its text matches, else "general". A stand-in, as documents carry no topics.
TOPICS = (
    ("legal", r"[Ll]icen[sc]e|[Cc]opyright|[Ww]arranty"),
    ("table", r" \| "),
    ("contact", r"[A-Za-z0-9]@[A-Za-z0-9]|\+[0-9]+ \([0-9]+\)"),
)
#: A text without any of a rule's pieces can't match it, and isn't given to its pattern.
PIECES = {"legal": ("icense", "icence", "opyright", "arranty"), "table": (" | ",), "contact": ("@", "+")}
BLANKS = " \t\n\r\f\x0b"
WORD = r"[^ \t\n\r\f\x0B]+"
NONE = "(none)"
DIMS = ("source", "lang", "topic")


@dataclass(frozen=True)
class Target:
    """Target weights of one marginal: stated weights; a category without one gets its share of all tokens to the power temper. All are then scaled to sum to 1."""

    stated: dict[str, float] = field(default_factory=dict)
    temper: float = 1.0


@dataclass(frozen=True)
class Mix:
    source: Target = Target(temper=0.5)
    lang: Target = Target(stated={"en": 0.5, "fr": 0.2, "de": 0.2, "es": 0.1})
    topic: Target = Target(temper=0.7)
    budget: float = 0.5  # tokens of the sample, as a share of all tokens
    sweeps: int = 6
    seed: int = 7


def topic_of(text: Column, rules: tuple = TOPICS) -> Column:
    out = F.lit("general")
    for name, pattern in reversed(rules):
        hint = F.lit(False) if name in PIECES else F.lit(True)
        for piece in PIECES.get(name, ()):
            hint = hint | text.contains(piece)
        out = F.when(hint & text.rlike(pattern), name).otherwise(out)
    return out


def word_count(text: Column) -> Column:
    """Runs of characters that aren't blanks. Each run and the blanks after it become one letter of one string: no object is made for a word."""
    return F.length(F.regexp_replace(F.btrim(text, F.lit(BLANKS)), WORD + WORD.replace("^", "")[:-1] + "*", "w")).cast("long")


def _cells(base: DataFrame) -> DataFrame:
    return base.groupBy(*DIMS).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0")


def _aimed(cells: DataFrame, mix: Mix) -> tuple[DataFrame, dict[str, int]]:
    """Materialized cells with t_source, t_lang and t_topic, the tokens that each cell's categories are to have in a sample of as many tokens as there are; and how many categories each marginal has."""
    category = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("category")) for d in DIMS])).alias("of")
    marginals = materialize(cells.select(category, "tokens").groupBy("of.dim", "of.category").agg(F.sum("tokens").alias("tokens")), "mix-marginals")
    of = {r["dim"]: r for r in marginals.groupBy("dim").agg(F.count("*").alias("n"), F.sum("tokens").alias("total")).collect()}  # three rows
    weight = F.lit(None).cast("double")
    for d in of:
        target: Target = getattr(mix, d)
        mine = F.pow(F.col("tokens") / of[d].total, F.lit(target.temper))
        for name, stated in target.stated.items():
            mine = F.when(F.col("category") == name, F.lit(float(stated))).otherwise(mine)
        weight = F.when(F.col("dim") == d, mine).otherwise(weight)
    weighted = materialize(marginals.select("dim", "category", weight.alias("weight")), "mix-targets")
    whole = {r["dim"]: r.whole for r in weighted.groupBy("dim").agg(F.sum("weight").alias("whole")).collect()}  # three rows
    for d in DIMS:
        target = weighted.where(F.col("dim") == d).select(F.col("category").alias(d), (F.col("weight") * (of[d].total / whole[d] if d in of else 0.0)).alias(f"t_{d}"))
        cells = join_narrow(cells, target, [d], spread=F.xxhash64(*DIMS), rows=of[d].n if d in of else 0)
    return materialize(cells, "mix-aimed"), {d: of[d].n if d in of else 0 for d in DIMS}


@dataclass
class Factors:
    """For each marginal a table of its categories and their factors, and how many there are."""

    tables: dict[str, DataFrame]
    sizes: dict[str, int]

    def onto(self, rows: DataFrame, dims: tuple[str, ...] = DIMS, how: str = "inner", spread: Column | None = None) -> DataFrame:
        """rows with the factors f_ of their categories; 1 before the first fit."""
        for d in dims:
            rows = join_narrow(rows, self.tables[d], [d], how, spread=F.xxhash64(*DIMS) if spread is None else spread, rows=self.sizes[d]) if d in self.tables else rows.withColumn(f"f_{d}", F.lit(1.0))
        return rows


def rake(cells: DataFrame, mix: Mix) -> tuple[Factors, DataFrame]:
    """Iterative proportional fitting of materialized cells (source, lang, topic, tokens): factors, and the cells with their targets.

    The product of a cell's three factors is how often each of its tokens is taken, if as many are taken as there are. Each
    sweep fits the source, then the language, then the topic marginal. Up to BROADCAST_ROWS cells, all sweeps are one plan over
    one partition, and written once; beyond, each fit is an aggregate over the cells that is combined in the tasks before the
    shuffle and written, a row for each category: no task holds the cells of a category.
    """
    aimed, sizes = _aimed(cells, mix)
    if aimed.limit(shared.BROADCAST_ROWS + 1).count() <= shared.BROADCAST_ROWS:
        return _raked_together(aimed, sizes, mix), aimed
    out = Factors({}, sizes)
    for _ in range(mix.sweeps):
        for d in DIMS:
            a, b = [e for e in DIMS if e != d]
            got = F.sum(F.col("tokens") * F.col(f"f_{a}") * F.col(f"f_{b}"))
            fitted = out.onto(aimed, (a, b)).groupBy(d).agg((F.first(f"t_{d}") / got).alias(f"f_{d}"))
            out = Factors(out.tables | {d: materialize(fitted, "mix-factors")}, sizes)
    return out, aimed


def _raked_together(aimed: DataFrame, sizes: dict[str, int], mix: Mix) -> Factors:
    """The factors of few cells: the cells carry them from fit to fit."""
    one = aimed.coalesce(1).select("*", *[F.lit(1.0).alias(f"f_{d}") for d in DIMS])
    for _ in range(mix.sweeps):
        for d in DIMS:
            a, b = [e for e in DIMS if e != d]
            got = F.sum(F.col("tokens") * F.col(f"f_{a}") * F.col(f"f_{b}")).over(Window.partitionBy(d))
            one = one.withColumn(f"f_{d}", F.col(f"t_{d}") / got)
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("category"), F.col(f"f_{d}").alias("f")) for d in DIMS])).alias("of")
    fitted = materialize(one.select(each).groupBy("of.dim", "of.category").agg(F.first("of.f").alias("f")), "mix-factors")
    return Factors({d: fitted.where(F.col("dim") == d).select(F.col("category").alias(d), F.col("f").alias(f"f_{d}")) for d in DIMS}, sizes)


def misses(cells: DataFrame, mix: Mix) -> DataFrame:
    """dim, category, target, reached: the share of the sample's tokens that each category was to have, and has after the last sweep."""
    factors, aimed = rake(cells, mix)
    share = factors.onto(aimed).withColumn("share", F.col("tokens") * F.col("f_source") * F.col("f_lang") * F.col("f_topic"))
    each = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).alias("category"), F.col(f"t_{d}").alias("target")) for d in DIMS])).alias("of")
    total = cells.agg(F.sum("tokens")).first()[0] or 1
    return share.select(each, "share").groupBy("of.dim", "of.category").agg((F.first("of.target") / total).alias("target"), (F.sum("share") / total).alias("reached"))


def measured(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """`row` (all columns of docs), id, source, lang, topic, n_tokens."""
    text = F.coalesce(docs[text_col], F.lit(""))
    return docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[id_col].alias("id"), F.coalesce(docs[source_col], F.lit(NONE)).alias("source"), F.coalesce(docs[lang_col], F.lit(NONE)).alias("lang"), topic_of(text).alias("topic"), word_count(text).alias("n_tokens"))


def mix_sources(docs: DataFrame, mix: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang") -> DataFrame:
    """One row per row of docs: `row` (all its columns), id, source, lang, topic, n_tokens, expected (copies), copies.

    A null source or language is the category "(none)"; a null or blank text has no tokens and no copies. The number of
    copies is the expected number rounded down or up by a uniform number drawn from a hash of the id and the seed, so a
    run repeats exactly, and rows that share an id share the draw. An empty table gives an empty table. If a marginal's
    stated weights are all of categories that don't occur, the categories that do occur share all of the weight. Texts are
    read whole, however long; extra columns stay in `row`, where their names can't clash.
    """
    base = measured(docs, id_col, text_col, source_col, lang_col)
    factors, _ = rake(materialize(_cells(base), "mix-cells"), mix)
    out = factors.onto(base, how="left", spread=F.xxhash64("id", "n_tokens"))
    expected = F.coalesce(F.col("f_source") * F.col("f_lang") * F.col("f_topic") * mix.budget, F.lit(0.0))
    draw = F.conv(F.substring(F.md5(F.concat(F.coalesce(F.col("id").cast("string"), F.lit("null")), F.lit(f":{mix.seed}"))), 1, 8), 16, 10).cast("double") / 4294967296.0
    out = out.withColumn("expected", F.when(F.col("n_tokens") > 0, expected).otherwise(0.0))
    copies = F.floor("expected") + F.when(draw < F.col("expected") - F.floor("expected"), 1).otherwise(0)
    return out.select("row", "id", *DIMS, "n_tokens", "expected", copies.cast("int").alias("copies"))
