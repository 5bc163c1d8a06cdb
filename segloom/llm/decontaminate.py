"""Benchmark decontamination by template windows, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segloom.llm.common import packed, quoted, text_or_empty, unpacked

WINDOW = 8
#: Items with fewer tokens are looked for as whole documents only: their words come in any text.
SHORTEST = 4
#: Share of an item's windows that a document must hold, or else so many tokens of it in a row, word for word.
COVERAGE = 0.5
RUN = 13
#: Benchmark windows that are sent to every executor; a row takes some 100 bytes.
BROADCAST_ROWS = 500_000

#: Words that are units after a number.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons tonne tonnes oz lb lbs ml cl l "
    "liter liters litre litres second seconds minute minutes hour hours day days week weeks month months year years "
    "cent cents dollar dollars euro euros pound pounds percent degree degrees kmh mph watt watts volt volts"
).split()

#: Marks that are dropped at once; those that can end a sentence go word by word.
MARKS = r"[^\p{L}\p{M}\p{N}.!?: \t\n\x0B\f\r]+"
BREAK = r"[ \t\x0B\f\r]*\n[ \t\n\x0B\f\r]*"
SPACE = r"[ \t\x0B\f\r]+"
ENDS = ".!?:"


def with_template(rows: DataFrame) -> DataFrame:
    """``rows`` with ``text`` turned into ``tokens``, its template form: array of (``h``, ``kind``, ``value``).

    Marks are left out; a line end ends a sentence. A token that begins with a digit is ``<num>``, a unit
    after it ``<unit>``, and a capitalised word that does not begin a sentence ``<name>``: these have
    their type in ``kind`` and their lower-case text in ``value``. ``h`` is the hash of the type, or of the
    lower-case word. Each step is a projection of its own, as a shared argument of array functions
    would be evaluated once per use.
    """
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", MARKS, ""), BREAK, ". "), SPACE, " ")
    others = [c for c in rows.columns if c != "text"]
    rows = rows.select(*others, F.split(plain, " ", -1).alias("raw"))
    rows = rows.select(*others, "raw", F.array_insert("raw", 1, F.lit("")).alias("before"))
    units = F.array(*[F.lit(u) for u in UNITS])

    def is_number(x: Column) -> Column:
        return (x >= "0") & (x < ":")

    def token(x: Column, before: Column) -> Column:
        second = F.substring(x, 2, 1)
        begins = F.substring(before, -1, 1).isin("", *ENDS)
        name = (F.lower(x) != x) & ~begins & (F.lower(F.substring(x, 1, 1)) != F.substring(x, 1, 1)) & (F.upper(second) != second)
        value = F.lower(F.rtrim(x, F.lit(ENDS)))
        kind = F.when(is_number(x), "<num>").when(is_number(before) & F.array_contains(units, value), "<unit>").when(name, "<name>")
        return F.when(x.isNotNull(), F.struct(kind.alias("kind"), value.alias("value")))

    rows = rows.select(*others, F.zip_with("raw", "before", token).alias("typed"))
    return rows.select(
        *others,
        F.transform(
            F.filter("typed", lambda t: t["value"] != ""),
            lambda t: F.struct(
                F.xxhash64(F.coalesce(t["kind"], t["value"])).alias("h"),
                t["kind"].alias("kind"),
                F.when(t["kind"].isNotNull(), t["value"]).alias("value"),
            ),
        ).alias("tokens"),
    )


def windows(tokens: DataFrame, keep: list[str], width: int) -> DataFrame:
    """A row per run of ``width`` tokens: ``keep``, ``at``, ``h`` (hash of their hashes) and ``slots``.

    Only hashes are exploded; the token array goes along by reference within generated code, and ends there. What leaves
    it are the runs that a join finds, all those of a text before the next step takes one: with the array in each, they
    would take the text's length times their number.
    """
    runs = F.greatest(F.size("tokens") - (width - 1), F.lit(0))
    # as columns of their own below the explode, else they would be built again for every run
    rows = tokens.select(*keep, "tokens", F.transform("tokens", lambda t: t["h"]).alias("hs"))
    rows = rows.select(*keep, "tokens", "hs", F.slice("hs", F.lit(1), runs).alias("first"))
    # the outer form infers no filter that would be pushed below and evaluate the template twice
    rows = rows.select(*keep, "tokens", "hs", F.posexplode_outer("first").alias("at", "h0")).where("h0 is not null")
    run = [F.col("h0"), *[F.get("hs", F.col("at") + k) for k in range(1, width)]]
    return rows.select(*keep, "at", F.xxhash64(*run, F.lit(width)).alias("h"), slots(width).alias("slots"))


def slots(width: int) -> Column:
    """Type and value of the placeholders of a run, in order.

    Without functions that take a function: those leave generated code, and the token array would go with them.
    """
    run = [F.get("tokens", F.col("at") + k) for k in range(width)]
    placed = [F.array(F.struct(t["kind"].alias("kind"), t["value"].alias("value"))) for t in run]
    return F.flatten(F.array(*[F.when(t["kind"].isNotNull(), one).otherwise(F.slice(one, 1, 0)) for t, one in zip(run, placed)]))


def _verbatim(pairs: Column) -> Column:
    return F.forall(pairs, lambda p: p["old"] == p["new"])


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    run: int = RUN,
    width: int = WINDOW,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """Pairs of a document and a benchmark item whose text it holds, word for word or with other values.

    Both sides are brought into template form (see ``template``) and cut into runs of ``width`` tokens,
    which meet by an equi-join on their hash; items shorter than that are one run as long as they are.
    A pair counts if the runs found cover at least ``coverage`` of the item's runs, where slots have to agree: along
    the same alignment a value of the item always stands for the same value of the document (several of the item's
    may stand for one of the document's). Runs with a slot whose value stands for two are left out, the others
    count. A pair also counts if ``run`` tokens of the item in a row are in the document word for word, however long
    the item is. Items of fewer than ``SHORTEST`` tokens are found only where they are the whole document, word for word.

    Returns ``id``, ``text_hash``, ``item_id``, ``n_windows`` (runs of the item found), ``item_windows``,
    ``coverage``, ``n_slots`` (slot values compared) and ``n_changed`` (those that differ; over zero for a
    re-parameterised question).

    Runs of documents are formed, hashed and joined in one pass over the texts, and only those of the
    benchmark leave it; the benchmark's runs are broadcast if a count has shown that there are few
    (else both sides are shuffled). What is grouped is bounded by the length of an item.

    Defined cases: null and empty texts hold nothing and are not looked for; texts of any length are searched
    whole; items with the same id are looked for as one; repeated rows are found once per id and text; rows
    without id are found with a null id; empty tables give an empty table.
    """
    rows = with_template(
        packed(docs, id_column, text_column).select("id", F.xxhash64("text").alias("text_hash"), "text")
    )
    items = with_template(
        benchmark.select(F.col(quoted(item_column)).cast("bigint").alias("item_id"), text_or_empty(item_text_column).alias("text"))
    ).where(F.col("item_id").isNotNull())
    size = F.size("tokens")
    parts = []
    value_pairs = F.zip_with("item_slots", "slots", lambda a, b: F.struct(a["kind"].alias("kind"), a["value"].alias("old"), b["value"].alias("new")))
    for n in range(1, width + 1):
        right = windows(items.where(size >= n) if n == width else items.where(size == n), ["item_id"], n)
        right = right.select("item_id", F.col("at").alias("item_at"), "h", F.col("slots").alias("item_slots"))
        # a benchmark is small and read again here; its count decides how it travels
        many = right.count()
        if not many and n < width:
            continue
        right = F.broadcast(right) if many <= BROADCAST_ROWS else right
        left = windows(rows.where(size == n) if n < SHORTEST else rows, ["id", "text_hash"], n)
        met = left.join(right, "h").select("id", "text_hash", "item_id", "at", "item_at", value_pairs.alias("pairs"))
        parts.append(met.where(_verbatim(F.col("pairs"))) if n < SHORTEST else met)
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    key = ["id", "text_hash", "item_id"]
    found = found.select(*key, (F.col("at") - F.col("item_at")).alias("shift"), F.struct("item_at", "pairs").alias("window"))
    # the same run of an item may be found in several places; each alignment is judged by itself
    aligned = found.groupBy(*key, "shift").agg(F.collect_set("window").alias("windows"))
    aligned = aligned.select(*key, "windows", F.array_distinct(F.flatten(F.transform("windows", lambda w: w["pairs"]))).alias("pairs"))
    other = lambda p: lambda q: (q["kind"] == p["kind"]) & (q["old"] == p["old"]) & (q["new"] != p["new"])
    slot = lambda p: F.struct(p["kind"], p["old"])
    twisted = F.transform(F.filter("pairs", lambda p: F.exists("pairs", other(p))), slot)
    aligned = aligned.select(*key, "windows", twisted.alias("twisted"))
    agreeing = F.filter("windows", lambda w: ~F.exists(w["pairs"], lambda p: F.array_contains("twisted", slot(p))))
    word_for_word = F.array_sort(F.transform(F.filter("windows", lambda w: _verbatim(w["pairs"])), lambda w: w["item_at"]))
    judged = aligned.select(*key, agreeing.alias("good"), word_for_word.alias("same"))
    judged = judged.select(*key, "good", F.transform("same", lambda x, i: x - i).alias("islands"))
    longest = F.array_max(F.transform(F.array_distinct("islands"), lambda v: F.size(F.filter("islands", lambda x: x == v))))
    judged = judged.select(
        *key,
        F.transform("good", lambda w: w["item_at"]).alias("at"),
        F.array_distinct(F.flatten(F.transform("good", lambda w: w["pairs"]))).alias("pairs"),
        F.coalesce(longest, F.lit(0)).alias("same"),
    )
    totals = items.groupBy("item_id").agg(
        F.sum(F.when(size >= width, size - width + 1).when(size >= 1, 1).otherwise(0)).alias("item_windows")
    )
    covered = judged.groupBy(*key).agg(
        F.size(F.array_distinct(F.flatten(F.collect_set("at")))).cast("bigint").alias("n_windows"),
        F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        F.max("same").alias("same"),
    )
    share = F.col("n_windows") / F.col("item_windows")
    return (
        covered.join(totals, "item_id")
        .where((share >= coverage) | (F.col("same") >= max(run - width + 1, 1)))
        .select(
            *key,
            "n_windows",
            F.col("item_windows").cast("bigint"),
            share.alias("coverage"),
            F.size("pairs").cast("bigint").alias("n_slots"),
            F.size(F.filter("pairs", lambda p: p["old"] != p["new"])).cast("bigint").alias("n_changed"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text_column: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that ``find_contamination`` finds with any item.

    Repeated rows go or stay together; rows without id, null and empty texts are judged like any; an empty table gives
    an empty one, an empty benchmark leaves all documents.
    """
    bad = find_contamination(docs, benchmark, id_column=id_column, text_column=text_column, **options)
    bad = bad.select(F.col("id").alias("bad_id"), F.col("text_hash").alias("bad_hash")).distinct().hint("shuffle_hash")
    rows = packed(docs, id_column, text_column).withColumn("text_hash", F.xxhash64("text"))
    same = F.col("id").eqNullSafe(F.col("bad_id")) & (F.col("text_hash") == F.col("bad_hash"))
    return unpacked(rows.join(bad, same, "left_anti"))
