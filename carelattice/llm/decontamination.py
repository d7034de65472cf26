"""Benchmark decontamination by template canonicalisation.

Numbers, units behind a number and capitalised names inside a sentence become typed placeholders, everything else is
lower-cased: a question whose numbers or names were exchanged keeps its template. Windows of template tokens are hashed and
hash-joined with those of the benchmark; hits are counted per (document, item, offset), so that only windows in one and the
same alignment add up. Before a pair is reported its slots are compared: along the alignment every value of the item must
stand for one value of the document and the other way round, as a re-parameterised copy has it, and a chance overlap of
templates has not. Only slots inside the windows met are compared.

Beside them go windows of the lower-cased tokens themselves, whatever they are made of: they find copies of items that are mostly
slots, copies in other letter case, and whole items shorter than a window. They agree in every token, so no slot is compared.

All of it is column expressions. The only wide intermediate, one row per window of a document, is consumed by the join in
the stage that makes it when the benchmark's windows are within ``BROADCAST_WINDOWS``; beyond that it is a shuffled join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from carelattice.llm.words import let, windows
from carelattice.runtime import cut_lineage

WIDTH = 8
#: Items of fewer tokens than this are no evidence inside a text: only a document that is nothing else holds them.
LEAST = 4
#: Windows with fewer literal tokens are no evidence.
LITERALS = 4
#: Benchmark windows up to which the hash table is broadcast (about 24 bytes each).
BROADCAST_WINDOWS = 1_000_000
#: Share of an item's windows that must be met in one alignment, in percent.
COVERED = 50
#: Or so many windows in one alignment, whatever the item's length: a common run of WIDTH + RUN - 1 tokens.
RUN = 13

UNITS = (
    "mm", "cm", "m", "km", "mg", "g", "kg", "t", "ml", "l", "s", "sec", "min", "h", "hr", "hz", "khz", "mhz", "ghz", "w", "kw", "v", "a", "j", "kj", "cal", "kcal",
    "inch", "inches", "foot", "feet", "ft", "yard", "yards", "mile", "miles", "pound", "pounds", "lb", "lbs", "ounce", "ounces", "oz", "gallon", "gallons", "litre",
    "litres", "liter", "liters", "metre", "metres", "meter", "meters", "kilometre", "kilometres", "kilometer", "kilometers", "gram", "grams", "kilogram", "kilograms",
    "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros",
    "cent", "cents", "percent", "degree", "degrees", "kmh", "mph", "kb", "mb", "gb", "tb",
)
NUMBER, UNIT, NAME = "<number>", "<unit>", "<name>"
TOKEN = r"\d+(?:[.,]\d+)*|[\p{L}\p{M}]+|[.!?:\n]"


def tokens(text: Column) -> Column:
    """Array of (raw, template) of a text; sentence ends only tell where a sentence begins and are left out."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), 0)

    def typed(raw: Column, previous: Column) -> Column:
        first = F.substring(raw, 1, 1)
        low = F.lower(raw)
        starts = previous.isNull() | previous.isin(".", "!", "?", ":", "\n")
        template = (
            F.when(first.between("0", "9"), F.lit(NUMBER))
            .when(F.substring(previous, 1, 1).between("0", "9") & low.isin(*UNITS), F.lit(UNIT))
            .when(~starts & (low != raw) & (F.lower(first) != first), F.lit(NAME))
            .otherwise(low)
        )
        return F.struct(raw.alias("raw"), template.alias("template"))

    each = let(found, lambda a: F.transform(a, lambda raw, i: typed(raw, F.get(a, i - 1))))
    return F.filter(each, lambda t: ~t["template"].isin(".", "!", "?", ":", "\n"))


def token_windows(rows: DataFrame, key: str, short: tuple[int, ...] | None = None) -> DataFrame:
    """(key, pos, h, typed, plain) of every window; ``rows`` has ``_tokens``.

    typed: a window of template tokens with enough literal ones; plain: one of the lower-cased tokens. A window without slots is
    both in one row. ``short``: further widths of plain windows, LEAST at least; a whole sequence below LEAST is one window. By default a
    whole sequence below WIDTH is one.
    """
    literal = F.transform("_tokens", lambda t: (~t["template"].isin(NUMBER, UNIT, NAME)).cast("int"))
    low = F.transform("_tokens", lambda t: F.xxhash64(F.lower(t["raw"])))
    hashed = rows.select(key, F.transform("_tokens", lambda t: F.xxhash64(t["template"])).alias("_h"), low.alias("_p"), literal.alias("_lit"))
    slots = F.aggregate("_lit", F.lit(0), lambda a, x: a + x) < F.size("_lit")
    hashed = hashed.select(key, "_p", "_lit", slots.alias("_slots"), windows(F.col("_h"), WIDTH).alias("_w"))
    typed = F.when(F.col("_slots"), _enough(F.col("_w"), F.col("_lit"))).otherwise(F.col("_w"))
    plain = F.when(F.col("_slots"), windows(F.col("_p"), WIDTH)).otherwise(F.col("_w"))
    both = F.zip_with(typed, plain, lambda t, p: F.struct(t.alias("t"), p.alias("p")))
    alone = F.transform(_whole(F.col("_p")), lambda h: F.struct(F.lit(None).cast("long").alias("t"), h.alias("p")))
    if not short:
        fewer = F.when((F.size("_p") > 0) & (F.size("_p") < (WIDTH if short is None else LEAST)), alone)
        each = hashed.select(key, F.posexplode(F.coalesce(fewer, both)).alias("pos", "x"))
    else:
        placed = lambda a: F.transform(a, lambda x, i: F.struct(i.alias("pos"), x["t"].alias("t"), x["p"].alias("p")))
        narrow = [F.transform(windows(F.col("_p"), w), lambda h: F.struct(F.lit(None).cast("long").alias("t"), h.alias("p"))) for w in short]
        fewer = F.when((F.size("_p") > 0) & (F.size("_p") < LEAST), placed(alone))
        each = hashed.select(key, F.explode(F.coalesce(fewer, F.concat(placed(both), *map(placed, narrow)))).alias("x")).select(key, "x.pos", "x")
    one = lambda h, t, p: F.struct(h.alias("h"), F.lit(t).alias("typed"), F.lit(p).alias("plain"))
    t, p = F.col("x.t"), F.col("x.p")
    kinds = F.when(t == p, F.array(one(p, True, True))).when(t.isNull(), F.array(one(p, False, True))).otherwise(F.array(one(t, True, False), one(p, False, True)))
    return each.select(key, "pos", F.inline(kinds))


def _whole(hashes: Column) -> Column:
    """The only window of a sequence below WIDTH, as ``windows`` of its length hashes it."""
    found = F.lit(None).cast("array<long>")
    for width in range(1, WIDTH):
        found = F.when(F.size(hashes) == width, windows(hashes, width)).otherwise(found)
    return found


def _enough(hashes: Column, literal: Column) -> Column:
    def kept(h: Column, i: Column) -> Column:
        n = F.get(literal, i)
        for k in range(1, WIDTH):
            n = n + F.get(literal, i + k)
        return F.when(n >= LITERALS, h)

    return F.transform(hashes, kept)


def alignments(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row, item, shift, hits, places, n_windows, n_plain): item windows met per document, item and offset.

    hits counts typed windows, places are those of the plain ones; n_windows and n_plain are what the item has of either.
    ``docs`` (row, text) and ``items`` (item, text), row and item unique. A hash that many documents share is not grouped
    by; rows are counted per (row, item, shift) with partial aggregates.
    """
    listed = items.select("item", tokens(F.col("text")).alias("_tokens"))
    sizes = listed.select(F.size("_tokens").alias("n")).where(F.col("n").between(LEAST, WIDTH - 1)).distinct()
    short = tuple(sorted(r[0] for r in sizes.collect()))  # at most WIDTH - LEAST
    windows_of_items = cut_lineage(token_windows(listed, "item"), "item-windows")
    number = lambda flag: F.sum(F.col(flag).cast("long"))
    of_item = windows_of_items.groupBy("item").agg(number("typed").alias("n_windows"), number("plain").alias("n_plain"))
    side = windows_of_items.select("item", F.col("pos").alias("at"), "h", F.col("typed").alias("item_typed"), F.col("plain").alias("item_plain"))
    if side.count() <= BROADCAST_WINDOWS:
        side = F.broadcast(side)
    found = token_windows(docs.select("row", tokens(F.col("text")).alias("_tokens")), "row", short).join(side, "h")
    typed, plain = F.col("typed") & F.col("item_typed"), F.col("plain") & F.col("item_plain")
    votes = found.where(typed | plain).groupBy("row", "item", (F.col("pos") - F.col("at")).alias("shift"))
    return votes.agg(F.sum(typed.cast("long")).alias("hits"), F.collect_set(F.when(plain, F.col("at"))).alias("places")).join(of_item, "item")


def consistent(doc: Column, item: Column, shift: Column) -> Column:
    """(slots, changed, clash) of two token arrays aligned by ``shift``.

    slots are the placeholders of equal type at aligned places inside typed windows that both have, changed those whose values differ, and clash those that
    contradict the first pairing of either value: the values must map one to one.
    """
    aligned = F.transform(item, lambda t, i: F.struct(t["template"].alias("type"), t["raw"].alias("from"), F.get(doc, i + shift).alias("to")))

    def met(a: Column) -> Column:
        same = F.transform(a, lambda p: F.coalesce(p["to"]["template"] == p["type"], F.lit(False)).cast("int"))
        literal = F.transform(a, lambda p: (~p["type"].isin(NUMBER, UNIT, NAME)).cast("int"))

        def window(both: Column, i: Column) -> Column:
            equal, literals = (sum((F.coalesce(F.get(both[c], i + k), F.lit(0)) for k in range(1, WIDTH)), F.get(both[c], i)) for c in ("same", "literal"))
            return (equal == WIDTH) & (literals >= LITERALS)

        hit = let(F.struct(same.alias("same"), literal.alias("literal")), lambda both: F.transform(both["same"], lambda _, i: window(both, i)))
        inside = lambda h, i: F.exists(F.slice(h, F.greatest(i - (WIDTH - 2), F.lit(1)), F.least(i + 1, F.lit(WIDTH))), lambda x: x)
        return let(hit, lambda h: F.filter(a, lambda p, i: p["type"].isin(NUMBER, UNIT, NAME) & (p["to"]["template"] == p["type"]) & inside(h, i)))

    pairs = let(aligned, met)
    pairs = F.transform(pairs, lambda p: F.struct(p["type"].alias("type"), p["from"].alias("from"), p["to"]["raw"].alias("to")))

    def weigh(p: Column) -> Column:
        distinct = F.array_distinct(p)
        one = lambda *names: F.size(F.array_distinct(F.transform(distinct, lambda x: F.struct(*[x[n].alias(n) for n in names]))))
        clash = F.greatest(F.size(distinct) - one("type", "from"), F.size(distinct) - one("type", "to"))
        return F.struct(F.size(p).alias("slots"), F.size(F.filter(p, lambda x: x["from"] != x["to"])).alias("changed"), clash.alias("clash"))

    return let(pairs, weigh)


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(row, item, hits, n_windows, slots, changed, clash, kind) of every document that holds an item, one row per pair.

    ``docs`` (row, text) and ``items`` (item, text). A pair is reported when its best alignment meets COVERED percent of the
    item's typed windows, or RUN windows, and its slots are consistent: a clash is allowed only where all literal windows agree
    and no more than a fifth of the slots clash. kind is "verbatim" when no slot was changed, else "reparameterised".
    It is also reported, as verbatim, when as large a share of the plain windows is met at different places, whatever their case
    and slots; hits and n_windows are those of the plain windows then. An item of fewer than WIDTH tokens is one plain window; one of
    fewer than LEAST ("yes", "the sea") is held only by a document that has these tokens and no others.
    Null or empty texts and items without a token are never reported; empty tables give none.
    """
    votes = alignments(docs, items)
    # an insertion or a repeated passage makes several offsets; the best one is compared, ties go to the earliest
    best = votes.groupBy("row", "item", "n_windows", "n_plain").agg(
        F.max_by(F.struct("shift", "hits"), F.struct("hits", F.size("places"), -F.col("shift"))).alias("top"),
        F.sum("hits").alias("all_hits"),
        F.flatten(F.collect_list("places")).alias("at"),
        F.flatten(F.collect_list(F.transform("places", lambda at: at + F.col("shift")))).alias("pos"),
    )
    # a window that an item or a document repeats counts as often as both have it
    met = F.least(F.size(F.array_distinct("at")), F.size(F.array_distinct("pos"))).cast("long")
    best = best.select("row", "item", "n_windows", "n_plain", F.col("top.shift").alias("shift"), F.least("all_hits", "n_windows").alias("hits"), met.alias("met"))
    enough = lambda hits, n: (F.col(n) > 0) & ((100 * F.col(hits) >= COVERED * F.col(n)) | (F.col(hits) >= RUN))
    likely = best.withColumn("typed", enough("hits", "n_windows")).withColumn("plain", enough("met", "n_plain")).where("typed OR plain")
    likely = cut_lineage(likely, "likely-leaks")
    theirs = docs.join(likely.select("row").distinct(), "row", "left_semi").select("row", tokens(F.col("text")).alias("_doc"))
    pairs = likely.join(items.select("item", tokens(F.col("text")).alias("_item")), "item").join(theirs, "row")
    checked = pairs.select(*likely.columns, consistent(F.col("_doc"), F.col("_item"), F.col("shift")).alias("c")).select(*likely.columns, "c.*")
    sound = (F.col("clash") == 0) | ((F.col("hits") >= F.col("n_windows")) & (5 * F.col("clash") <= F.col("slots"))) | (F.col("changed") == 0)
    told = checked.withColumn("sound", F.col("typed") & sound).where("sound OR plain")
    verbatim = ~F.col("sound") | (F.col("changed") == 0) | (F.col("met") >= F.col("n_plain"))
    number = lambda typed, plain: F.when(F.col("sound"), F.col(typed)).otherwise(F.col(plain)).alias(typed)
    return told.select(
        "row", "item", number("hits", "met"), number("n_windows", "n_plain"), "slots", "changed", "clash", F.when(verbatim, "verbatim").otherwise("reparameterised").alias("kind")
    )


def leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, item_id, ...) of ``contaminated``; rows that repeat a doc_id are reported once per id, the strongest row.

    Rows of ``docs`` without doc_id and of ``benchmark`` without item_id are ignored.
    """
    plain = docs.select(F.col(f"`{doc_id}`").alias("row"), F.col(f"`{text}`").alias("text")).where("row IS NOT NULL AND text IS NOT NULL")
    items = benchmark.select(F.col("item_id").alias("item"), "text").where("item IS NOT NULL AND text IS NOT NULL")
    found = contaminated(plain, items)
    one = found.groupBy("row", "item").agg(F.max(F.struct("hits", "n_windows", "slots", "changed", "clash", "kind")).alias("x"))
    return one.select(F.col("row").alias(doc_id), F.col("item").alias("item_id"), "x.*")


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item, all columns kept; rows without doc_id stay."""
    gone = cut_lineage(leaks(docs, benchmark).select("doc_id").distinct(), "leaking")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
