"""Benchmark decontamination: windows of benchmark words, looked up in every document.

The benchmark's word windows form a hash set. Its size is counted first: up to ``broadcast_windows`` windows it is
sent to all executors, so that documents are scanned where they lie and only hits are shuffled; beyond that the same
join runs as a shuffled one. Each hit is verified word by word, so hash collisions cost time, never correctness.

Defined results: null or empty text has no words and no hits; an item without words never hits; an item shorter than
a window is one window of its own length; null item ids hit but are not listed; repeated rows each get their result;
an empty benchmark leaves every document clean. Only ``doc_id``, ``text``, ``item_id`` are read, extra columns may
have any name; rows with a null ``doc_id`` are kept and judged like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelmart.llm.common import LOWER, UPPER, row_key

# ASCII characters that are neither letters nor digits end a word; all others, accented ones included, belong to words.
BREAKS = "".join(c for c in map(chr, range(128)) if not c.isalnum())


def words(text: Column) -> Column:
    """Lower-cased words. One character table and one split: several times faster than matching a word pattern."""
    spaced = F.translate(text, UPPER + BREAKS, LOWER + " " * len(BREAKS))
    return F.coalesce(F.array_remove(F.split(spaced, " "), ""), F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    return F.size(words(text)).cast("long")


def _window_hashes(column: str, length: int) -> Column:
    """One hash per window of ``length`` words, in order of the window's start.

    The words are picked by index: ``slice`` would copy the whole array for each window.
    """
    starts = F.sequence(F.lit(0), F.size(column) - length)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col(column), i + k) for k in range(length)]))
    return F.when(F.size(column) >= length, hashes).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(benchmark: DataFrame, n: int) -> DataFrame:
    """Distinct windows: ``window`` (words), ``length``, ``hash`` and the ``items`` that hold it, as strings."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("w")).where(
        F.size("w") > 0
    )
    length = F.least(F.size("w"), F.lit(n))
    windows = items.select(
        "item",
        F.explode(
            F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice(F.col("w"), i, length))
        ).alias("window"),
    )
    picked = F.xxhash64(*[F.get("window", F.lit(k)) for k in range(n)])  # a hash skips nulls: as over the words there are
    return windows.groupBy("window").agg(F.collect_set("item").alias("items")).select(
        "window", F.size("window").alias("length"), picked.alias("hash"), "items"
    )


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = 10, broadcast_windows: int = 500_000) -> DataFrame:
    """Per row of ``docs``: all its columns, ``_w`` (its words), ``spans`` (start, length), ``n_hit`` and ``items``."""
    windows = benchmark_windows(benchmark, n)
    sizes = {r["length"]: r["n"] for r in windows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    lengths = sorted(sizes)  # n different lengths at most
    keyed = docs.select("doc_id", row_key("text").alias("_key"), words(F.col("text")).alias("_w"))
    keyed = keyed.withColumn("_n", F.size("_w"))
    hashes = F.concat(*[_window_hashes("_w", k) for k in lengths]) if lengths else F.array().cast("array<bigint>")
    # Only numbers are exploded: a row that carried its words along would copy them for every window.
    # (Exploding a named column would make the optimiser repeat its expression, words and all, in a pushed filter.)
    placed = keyed.select("doc_id", "_key", "_n", F.posexplode(hashes).alias("_at", "_hash"))
    if sum(sizes.values()) <= broadcast_windows:
        windows = F.broadcast(windows)
    # The windows of all lengths follow each other in one array: those of a length begin behind the shorter ones.
    before = F.lit(0)
    for k in lengths:
        shorter = [F.greatest(F.col("_n") - x + 1, F.lit(0)) for x in lengths if x < k]
        before = F.when(F.col("length") == k, sum(shorter, F.lit(0))).otherwise(before)
    candidates = (
        placed.join(windows, F.col("_hash") == F.col("hash"))
        .select(
            F.col("doc_id").alias("_doc"),
            F.col("_key").alias("_text_key"),
            F.struct((F.col("_at") - before).alias("start"), "length", "window", "items").alias("hit"),
        )
        .groupBy("_doc", "_text_key")
        .agg(F.collect_set("hit").alias("_found"))  # at most a few for each word of one document
    )
    rows = docs.withColumn("_key", row_key("text"))
    met = rows.join(
        candidates, rows["doc_id"].eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_text_key")), "left"
    ).select(*[rows[c] for c in docs.columns], words(rows["text"]).alias("_w"), "_found")

    def same_words(hit: Column) -> Column:
        return (hit["start"] >= 0) & F.forall(
            F.sequence(F.lit(0), hit["length"] - 1),
            lambda k: F.get(F.col("_w"), hit["start"] + k) == F.get(hit["window"], k),
        )

    verified = F.when(F.col("_found").isNotNull() & (F.size("_w") > 0), F.filter("_found", same_words))
    spans = F.array_sort(F.array_distinct(F.transform("_hits", lambda h: F.struct(h["start"], h["length"]))))
    covered = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda seen, s: F.struct(
            (
                seen["n"] + F.greatest(s["start"] + s["length"] - F.greatest(s["start"], seen["end"]), F.lit(0))
            ).cast("long").alias("n"),
            F.greatest(seen["end"], s["start"] + s["length"]).alias("end"),
        ),
        lambda seen: seen["n"],
    )
    items = F.array_sort(F.array_distinct(F.flatten(F.transform("_hits", lambda h: h["items"]))))
    own = docs.columns
    return (
        met.select(*own, "_w", verified.alias("_hits"))
        .select(*own, "_w", spans.alias("spans"), items.alias("items"))
        .select(*own, "_w", "spans", F.coalesce(covered, F.lit(0)).cast("long").alias("n_hit"), "items")
    )


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Per document row: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans``."""
    items = F.coalesce("items", F.array().cast("array<string>"))
    return find_hits(docs.select("doc_id", "text"), benchmark, n).select(
        "doc_id",
        F.size("_w").cast("long").alias("n_words"),
        "n_hit",
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
        "spans",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """The documents without a hit, all their columns unchanged."""
    packed = docs.select("doc_id", "text", F.struct(*docs.columns).alias("_row"))
    return find_hits(packed, benchmark, n).where("n_hit = 0").select("_row.*")


def cut_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """All documents; in those with hits ``text`` becomes the normalised words outside the hit spans."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    packed = docs.select("doc_id", "text", F.struct(F.lit(0).alias("_"), *others).alias("_row"))
    kept = F.array_join(
        F.filter("_w", lambda w, i: ~F.exists("spans", lambda s: i.between(s["start"], s["start"] + s["length"] - 1))),
        " ",
    )
    text = F.when(F.col("n_hit") > 0, kept).otherwise(F.col("text"))
    met = find_hits(packed, benchmark, n).select("doc_id", text.alias("text"), "_row")
    return met.select(*[F.col(c) if c in ("doc_id", "text") else F.col("_row")[c].alias(c) for c in docs.columns])
