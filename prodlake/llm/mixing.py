"""Mixing sources to target weights by hierarchical budgeting.

Sources are leaves of a tree domain - language - source. A token budget is dealt from the root down by
the weights of the children; a child gets no more than it can give (its tokens times `max_epochs`), and
what it falls short of goes to its siblings by weight, before the shortage of a whole branch goes to the
siblings of its ancestor. Each leaf then fills its budget from seeded epochs: whole passes over its
documents and, of the last pass, the longest prefix in the seeded order that fits.

The prefix of a leaf is found without ordering the leaf in one task: token sums of ranges of the order
hash are added up, and only the one range that holds the end of the prefix is ordered by row. So every
leaf comes down to one cut, and documents are taken row by row.

Tokens: runs of characters other than ASCII white space. Domains: a column `domain` if there is one,
else `domain_of(source)`.

Defined cases: null text has no tokens; null lang, source or domain count as ''; null doc_id as -1 in
the order; rows repeating a doc_id stand together in the order and are taken together; a leaf without
tokens is taken once; weights not stated are 1 (before normalising among the children present); an empty
table gives no rows; extra columns are kept by mix_rows(), whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodlake.llm.session import carried, stash, unpacked

#: Ranges of the order hash in every leaf.
RANGES = 4096
#: A table of leaves of at most so many rows is broadcast; a larger one is joined by a shuffle.
BROADCAST_LEAVES = 20_000


@dataclass(frozen=True)
class Mix:
    """Weights by domain, by (domain, lang) or lang, by source; budget as a share of all tokens."""

    domains: dict[str, float] = field(default_factory=lambda: {"web": 4.0, "books": 3.0, "news": 2.0, "forum": 1.0})
    languages: dict[str, float] = field(default_factory=lambda: {"en": 5.0, "de": 2.0, "fr": 2.0, "es": 1.0})
    sources: dict[str, float] = field(default_factory=dict)
    share: float = 1.0
    max_epochs: int = 4
    seed: int = 42


def domain_of(source: Column) -> Column:
    """web, books, news or forum by the number at the end of a source's name."""
    number = F.coalesce(F.try_to_number(F.regexp_extract(source, r"(\d{1,9})$", 1), F.lit("999999999")).cast("int"), F.lit(0))
    return F.element_at(F.array(*[F.lit(d) for d in ("web", "books", "news", "forum")]), number % 4 + 1)


def token_count(text: Column) -> Column:
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def _weight(values: dict[str, float], key: Column) -> Column:
    out = F.lit(1.0)
    for k, v in values.items():
        out = F.when(key == k, F.lit(float(v))).otherwise(out)
    return out


def _leaf_columns(docs: DataFrame) -> list[Column]:
    source = F.coalesce(F.col("source").cast("string"), F.lit(""))
    domain = F.coalesce(F.col("domain").cast("string"), F.lit("")) if "domain" in docs.columns else domain_of(source)
    return [domain.alias("_domain"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("_lang"), source.alias("_source")]


def _order(epoch: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), epoch, F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)))


def _range(h: Column) -> Column:
    """Place of an order hash among RANGES equal ranges in ascending order."""
    return F.shiftright(h, 64 - (RANGES - 1).bit_length()) + RANGES // 2


def _deal(children: DataFrame, parent: list[str], budget: str) -> DataFrame:
    """Divide `budget` of each parent among its rows by `w`, none over `capacity`: adds `given`.

    In the order of capacity / w the children fill up first that fill at the lowest level; the level at
    the first child that does not fill holds for it and all after it. It is the largest of the levels.
    """
    by = Window.partitionBy(*parent).orderBy(F.col("capacity") / F.col("w"), "child")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*parent)
    level = (F.col(budget) - F.coalesce(F.sum("capacity").over(before), F.lit(0.0))) / (
        F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0.0))
    )
    stepped = children.withColumn("level", level).withColumn("open", F.col("capacity") > F.col("level") * F.col("w"))
    first = F.max(F.when(F.col("open"), F.col("level"))).over(whole)
    return stepped.withColumn("given", F.least("capacity", F.coalesce(first * F.col("w"), F.col("capacity")))).drop("level", "open")


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """leaves(_domain, _lang, _source, tokens) with `budget` in tokens."""
    leaves = leaves.withColumn("capacity", F.col("tokens").cast("double") * mix.max_epochs)
    langs = leaves.groupBy("_domain", "_lang").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    domains = langs.groupBy("_domain").agg(F.sum("capacity").alias("capacity"), F.sum("tokens").alias("tokens"))
    total = Window.partitionBy("root")
    domains = (
        domains.withColumn("root", F.lit(0))
        .withColumn("whole", F.least(F.sum("tokens").over(total) * mix.share, F.sum("capacity").over(total)))
        .withColumn("w", _weight(mix.domains, F.col("_domain")))
        .withColumn("child", F.col("_domain"))
    )
    domains = _deal(domains, ["root"], "whole").select("_domain", F.col("given").alias("from_above"))
    langs = langs.join(domains, "_domain").withColumn("w", _weight(mix.languages, F.col("_lang"))).withColumn("child", F.col("_lang"))
    langs = _deal(langs, ["_domain"], "from_above").select("_domain", "_lang", F.col("given").alias("from_above"))
    leaves = leaves.join(langs, ["_domain", "_lang"]).withColumn("w", _weight(mix.sources, F.col("_source"))).withColumn("child", F.col("_source"))
    dealt = _deal(leaves, ["_domain", "_lang"], "from_above")
    return dealt.select("_domain", "_lang", "_source", "tokens", F.floor(F.col("given") + 1e-6).alias("budget"))


def leaf_cuts(docs: DataFrame, mix: Mix) -> DataFrame:
    """A row for each leaf: whole passes, and the last (order hash, doc_id) of the prefix of the next pass."""
    keys = ["_domain", "_lang", "_source"]
    counted = stash(docs.select(*_leaf_columns(docs), F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id"), token_count(F.col("text")).alias("n")))
    budgets = stash(leaf_budgets(counted.groupBy(*keys).agg(F.sum("n").alias("tokens")), mix))
    passes = budgets.withColumn("passes", F.when(F.col("tokens") > 0, F.floor(F.col("budget") / F.col("tokens"))).otherwise(1).cast("int")).withColumn(
        "rest", F.col("budget") - F.col("passes") * F.col("tokens")
    )
    passes = _bounded(passes)
    ordered = counted.join(passes.select(*keys, "passes", "rest"), keys).withColumn("h", _order(F.col("passes"), mix.seed))
    ordered = ordered.withColumn("range", _range(F.col("h")))
    sums = ordered.groupBy(*keys, "range").agg(F.sum("n").alias("n"), F.max("rest").alias("rest"))
    running = Window.partitionBy(*keys).orderBy("range")
    held = (
        sums.withColumn("upto", F.sum("n").over(running))
        .where("upto > rest")
        .groupBy(*keys)
        .agg(F.min(F.struct("range", (F.col("upto") - F.col("n")).alias("before"))).alias("end"))
        .select(*keys, F.col("end.range").alias("end_range"), F.col("end.before").alias("before"))
    )
    held = _bounded(stash(held))
    row = Window.partitionBy(*keys).orderBy("h", "doc_id").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    cut = (
        ordered.join(held, keys)
        .where(F.col("range") == F.col("end_range"))
        .groupBy(*keys, "h", "doc_id")
        .agg(F.sum("n").alias("n"), F.max("before").alias("before"), F.max("rest").alias("rest"))
        .withColumn("upto", F.col("before") + F.sum("n").over(row))
        .where("upto <= rest")
        .groupBy(*keys)
        .agg(F.max(F.struct("h", "doc_id")).alias("cut"))
    )
    return passes.join(held.select(*keys, "end_range"), keys, "left").join(cut, keys, "left")


def _bounded(leaves: DataFrame) -> DataFrame:
    return F.broadcast(leaves) if leaves.count() <= BROADCAST_LEAVES else leaves


def mix_rows(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """All columns of the documents, a row for each time a document is taken."""
    return unpacked(_taken(docs, mix), docs)


def _taken(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """(row, _domain, epoch from 0): a row for each time a document is taken."""
    mix = mix or Mix()
    keys = ["_domain", "_lang", "_source"]
    cuts = _bounded(stash(leaf_cuts(docs, mix)))
    own = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("doc_id")
    placed = carried(docs, *_leaf_columns(docs), own).join(cuts, keys)
    h = _order(F.col("passes"), mix.seed)
    mine = _range(h)
    before_end = (mine < F.col("end_range")) | F.col("end_range").isNull()
    held = (mine == F.col("end_range")) & F.coalesce(F.struct(h.alias("h"), "doc_id") <= F.col("cut"), F.lit(False))
    times = F.col("passes") + ((F.col("rest") > 0) & (before_end | held)).cast("int")
    return placed.withColumn("times", times).where("times > 0").select("row", "_domain", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("epoch"))


def mix_sources(docs: DataFrame, mix: Mix | None = None) -> DataFrame:
    """Rows (doc_id, domain, lang, source, epoch, n_tokens)."""
    columns = [c for c in ("doc_id", "text", "lang", "source", "domain") if c in docs.columns]
    return _taken(docs.select(*columns), mix).select(
        "row.doc_id", F.col("_domain").alias("domain"), "row.lang", "row.source", "epoch", token_count(F.col("row.text")).alias("n_tokens")
    )
