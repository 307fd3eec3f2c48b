"""H-03, V-11, V-14: hashes of ordered rows as a tree, and the markers of batch sets checked key by key.

A leaf is the hash of one row; a node the hash of its FAN children's hashes in order, up to one root. Two trees are compared
from the root down, and only below nodes that differ: a marker that holds a tree names the rows that changed without reading
the others. Every level is one aggregate with groups of FAN rows at most, made of the level below as it was written: a plan
that made each level again from the rows would hold the rows once for every level of every comparison.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from prodlake.session import stash

FAN = 64
# Keys of a marker and of its entries.
MARKER_KEYS = ("schema_version", "complete", "set_id", "generated_at", "baseline_sha256", "baseline_count", "batch_count", "field_union_sha256", "batches")
ENTRY_KEYS = ("batch_id", "file_name", "sha256", "product_count", "source_order_start", "source_order_end")
VERSION = "1.0"


def levels_of(rows: int, fan: int) -> int:
    """Levels above the leaves; one row has its root above it too."""
    n, levels = rows, 0
    while n > 1 or levels == 0:
        n, levels = -(-n // fan), levels + 1
    return levels


def hash_tree(rows: DataFrame, place: str, digest: Column, fan: int = FAN) -> DataFrame:
    """(level, node, sha256, first, last, n) of rows with places from 0, each once. A place that is left out has no leaf.

    The levels are written to the shared folder, one table each.
    """
    at = F.col(place).cast("long")
    level = stash(rows.select(at.alias("node"), digest.alias("sha256"), at.alias("first"), at.alias("last"), F.lit(1).cast("long").alias("n")))
    top = level.agg(F.max("node")).first()[0]
    numbered = lambda k: level.select(F.lit(k).alias("level"), "node", "sha256", "first", "last", "n")
    out = numbered(0)
    for k in range(1, 1 if top is None else levels_of(top + 1, fan) + 1):
        children = F.transform(F.array_sort(F.collect_list(F.struct("node", "sha256"))), lambda c: c["sha256"])
        above = level.groupBy(F.floor(F.col("node") / fan).alias("parent")).agg(children.alias("children"), F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("n"))
        level = stash(above.select(F.col("parent").alias("node"), F.sha2(F.array_join("children", "\n"), 256).alias("sha256"), "first", "last", "n"))
        out = out.union(numbered(k))
    return out


def tree_changes(old: DataFrame, new: DataFrame, fan: int = FAN) -> DataFrame:
    """(place, change) of the rows that differ: changed, added or removed. Below nodes that agree nothing is compared.

    Trees of different heights are compared from the lower one's top.
    """
    tops = [t.agg(F.max("level")).first()[0] for t in (old, new)]
    if None in tops:  # one has no rows: all leaves of the other differ
        tops = [0, 0]
    nodes = old.select("level", "node", F.col("sha256").alias("_old"), F.lit(None).cast("string").alias("_new")).union(new.select("level", "node", F.lit(None).cast("string"), "sha256"))
    differ = None
    for level in range(min(tops), -1, -1):
        here = nodes.where(F.col("level") == level)
        if differ is not None:
            here = here.withColumn("parent", F.floor(F.col("node") / fan)).join(differ.select(F.col("node").alias("parent")), "parent", "left_semi")
        both = here.groupBy("node").agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
        differ = both.where(~F.col("_old").eqNullSafe(F.col("_new")))
        if level:  # written, as a plan it would stand twice in that of the level below, on the side of either tree
            differ = stash(differ)
    change = F.when(F.col("_old").isNull(), "added").when(F.col("_new").isNull(), "removed").otherwise("changed")
    return differ.select(F.col("node").alias("place"), change.alias("change"))


def set_hash(baseline: Column, hashes: Column) -> Column:
    """The hash of a set of batches: of the baseline's and the batches' hashes as compact JSON."""
    listed = F.array_join(F.transform(hashes, lambda h: F.concat(F.lit('"'), h, F.lit('"'))), ",")
    return F.sha2(F.concat(F.lit('{"baseline_sha256":"'), baseline, F.lit('","batch_sha256":['), listed, F.lit("]}")), 256)


def marker_errors(markers: DataFrame, expected: DataFrame, files: DataFrame) -> DataFrame:
    """V-11, V-14: (set, code) of all that is wrong with the markers of batch sets.

    markers: set, marker (JSON). expected: set, baseline_sha256, baseline_count, batch_count, fields_sha256, size (places of a
    batch). files: set, file_name, sha256 of the files that are there, a name once in a set. A set's files are one row beside its marker. Codes: not_an_object, marker_keys, not_complete,
    baseline_sha256, baseline_count, batch_count, field_union_sha256, generated_at, batches, set_id, and of an
    entry, by its number from 1, entry_keys:<n>, entry:<n>:<key>, missing_file:<n>, changed_file:<n>. A marker with other keys has
    the first two codes alone, an entry with other keys only entry_keys.
    """
    get = lambda v, key, kind="string": F.try_variant_get(v, f"$.{key}", kind)
    keys = lambda text: F.array_sort(F.coalesce(F.json_object_keys(text), F.array().cast("array<string>")))
    exactly = lambda text, names: keys(text) == F.array(*[F.lit(n) for n in sorted(names)])
    kind = lambda v: F.coalesce(F.schema_of_variant(v), F.lit(""))
    differs = lambda found, wanted: ~found.eqNullSafe(wanted)
    there = files.groupBy("set", "file_name").agg(F.min("sha256").alias("sha256")).groupBy("set").agg(F.map_from_entries(F.collect_list(F.struct("file_name", "sha256"))).alias("_there"))
    # each step asks the last one's columns, and no filter stands above the parse, which would move below it and parse again
    joined = markers.join(expected, "set").join(there, "set", "left").withColumn("_m", F.try_parse_json("marker"))
    m = F.col("_m")
    told = joined.withColumns(
        {
            "_object": F.startswith(kind(m), F.lit("OBJECT")),
            "_keys": exactly(F.col("marker"), MARKER_KEYS),
            "_entries": F.when(F.startswith(kind(get(m, "batches", "variant")), F.lit("ARRAY")), get(m, "batches", "array<variant>")),
            "_there": F.coalesce("_there", F.create_map().cast("map<string,string>")),
        }
    )
    whole = F.col("_object") & F.col("_keys")
    listed = F.coalesce(F.size("_entries") == F.col("batch_count"), F.lit(False))
    own = [
        F.when(~F.col("_object"), "not_an_object"),
        F.when(F.col("_object") & ~F.col("_keys"), "marker_keys"),
        F.when(whole & (differs(get(m, "schema_version"), F.lit(VERSION)) | differs(get(m, "complete", "variant").cast("string"), F.lit("true")) | (kind(get(m, "complete", "variant")) != "BOOLEAN")), "not_complete"),
        F.when(whole & differs(get(m, "baseline_sha256"), F.col("baseline_sha256")), "baseline_sha256"),
        F.when(whole & differs(get(m, "baseline_count", "long"), F.col("baseline_count")), "baseline_count"),
        F.when(whole & differs(get(m, "batch_count", "long"), F.col("batch_count")), "batch_count"),
        F.when(whole & differs(get(m, "field_union_sha256"), F.col("fields_sha256")), "field_union_sha256"),
        F.when(whole & ((kind(get(m, "generated_at", "variant")) != "STRING") | (F.trim(F.coalesce(get(m, "generated_at"), F.lit(""))) == "")), "generated_at"),
        F.when(whole & ~listed, "batches"),
    ]

    def entry(e: Column, i: Column) -> Column:
        name, size = F.format_string("batch-%02d", i + 1), F.col("size").cast("long")
        file = F.concat(name, F.lit(".json"))
        wanted = (("batch_id", "string", name), ("file_name", "string", file), ("product_count", "long", size), ("source_order_start", "long", i * size + 1), ("source_order_end", "long", (i + 1) * size))
        wrong = F.array(*[F.when(differs(get(e, key, how), value), key) for key, how, value in wanted])
        return F.struct(
            (i + 1).cast("string").alias("n"),
            exactly(F.to_json(e), ENTRY_KEYS).alias("fine"),
            F.filter(wrong, lambda k: k.isNotNull()).alias("wrong"),
            get(e, "sha256").alias("stated"),
            F.try_element_at("_there", file).alias("actual"),
        )

    found = told.select(
        "set",
        "baseline_sha256",
        F.when(whole, get(m, "set_id")).alias("set_id"),
        F.filter(F.array(*own), lambda c: c.isNotNull()).alias("own"),
        (whole & listed).alias("listed"),
        F.when(whole & listed, F.transform("_entries", entry)).otherwise(F.array()).alias("entries"),
    )
    named = lambda *parts: F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else p for p in parts])
    none = F.array().cast("array<string>")
    entry_codes = lambda e: F.when(~e["fine"], F.array(named("entry_keys", e["n"]))).otherwise(
        F.concat(
            F.transform(e["wrong"], lambda k: named("entry", e["n"], k)),
            F.when(e["actual"].isNull(), F.array(named("missing_file", e["n"]))).when(differs(e["stated"], e["actual"]), F.array(named("changed_file", e["n"]))).otherwise(none),
        )
    )
    complete = F.col("listed") & (F.size("entries") > 0) & F.forall("entries", lambda e: e["fine"] & e["actual"].isNotNull())
    other_id = differs(F.col("set_id"), set_hash(F.col("baseline_sha256"), F.transform("entries", lambda e: e["actual"])))
    codes = F.concat("own", F.flatten(F.transform("entries", entry_codes)), F.when(complete & other_id, F.array(F.lit("set_id"))).otherwise(none))
    return found.select("set", F.explode(codes).alias("code"))
