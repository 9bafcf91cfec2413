"""Benchmark decontamination by templates: the same question is found also with other numbers, names and units in it.

Text becomes a template: numbers, units after numbers and names (capitalised words inside a sentence) turn into typed
placeholders, all else is lower-cased words without punctuation. Every window of `WINDOW` template words of a document is looked
up by its hash among the windows of the benchmark. Windows that agree on item and offset form one alignment. It counts if it
covers enough of the item, and if its names are consistent: each name of the item stands for one name in the document
throughout, and different names for different ones. Numbers and units may meet: 3 and 5 can both become 4, and a 3 of two
roles can become 3 and 8. `find` wants the same consistency of all slots; `search`, which the query and the pipeline use, does not.

`search` looks the windows up in their plain words too, which stand for themselves, so a copy is found however many numbers and
names it has. A third reading leaves the names as plain words and numbers and units as placeholders, since a copy in lower case
or in capitals shows no names. Each window counts that agrees in one of the readings. Items of less than `WINDOW` words are one window of plain words, of their whole length. If plain windows alone
are enough, nothing has to be consistent. Half of the windows that can be looked up as templates are enough as well.

Only DataFrame functions run. The benchmark's window hashes are broadcast up to `BROADCAST_ROWS` of them, which a count checks;
more of them are joined by a shuffle of the hashes.

Null and empty texts match nothing, on either side. Windows with fewer than `LITERALS` words that are no placeholders are looked
for by their plain words only, and so are items of less than `WINDOW` words; `find` does not look for either. Items of equal text count as the one of least item_id. Repeated
document rows give one result row. A null doc_id is an id like others; items with a null id are left out. Further columns are
not read. An empty benchmark or table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WINDOW = 8
LITERALS = 4
# An alignment counts from half of an item's windows on, or from so many windows that it covers 13 words.
LEAST_SHARE = 0.5
LEAST_WINDOWS = 6
# 16 bytes each: 16 MB at most.
BROADCAST_ROWS = 1_000_000

# Units that are told apart from words when they follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb lbs ml cl l gal ms s sec secs min mins h hr hrs hour hours minute minutes second "
    "seconds day days week weeks month months year years meter meters metre metres mile miles inch inches foot feet gram "
    "grams kilogram kilograms liter liters litre litres pound pounds ounce ounces dollar dollars euro euros cent cents usd eur "
    "gbp percent kmh mph kwh kw mw w v hz khz mhz ghz kb mb gb tb"
)
# A placeholder is followed by its value; the window's hash leaves the value out.
_NAME = r"(?<=[^.!?:\s]\s)\p{Lu}\p{Ll}[\p{L}\p{M}]*"
_NUMBER = r"\d+(?:[.,:/]\d+)*"
_UNIT = rf"(<n>[\d.,:/]+)\s?({'|'.join(sorted(UNITS.split(), key=len, reverse=True))}|[%€£°])(?![\p{{L}}\p{{N}}])"
_MARKS = r"[^\p{L}\p{M}\p{N}<>\s]+"
_VALUE = r"(<[npu]>)\S+"
_PLACEHOLDER = r"<[npu]>(?=\S)"
_BLANK = " \t\n\r\f\v"


def valued(text: Column) -> Column:
    """Lower-case words without punctuation; numbers, units and names carry their placeholder in front."""
    named = F.lower(F.regexp_replace(F.translate(text, "<>", "  "), _NAME, "<p>$0"))
    # Most texts have no digit; one look saves two passes.
    counted = F.regexp_replace(F.regexp_replace(named, _NUMBER, "<n>$0"), _UNIT, "$1 <u>$2 ")
    counted = F.when(text.rlike(r"\d"), counted).otherwise(named)
    return F.btrim(F.regexp_replace(counted, _MARKS, ""), F.lit(_BLANK))


def _read(rows: DataFrame, text: str) -> DataFrame:
    """rows with `values`, their words, and three readings of them: `words`, where all placeholders are bare, `counted`, where
    names are plain words, and `plain`, where all are."""
    rows = rows.withColumn("read", valued(F.coalesce(F.col(text).cast("string"), F.lit(""))))
    read = F.col("read")
    bare = F.when(read.contains("<"), F.regexp_replace(read, _VALUE, "$1")).otherwise(read)
    # A unit that is a mark has no value left, and its placeholder stays: all readings have the same number of words.
    plain = F.when(read.contains("<u>"), F.regexp_replace(read, _PLACEHOLDER, ""))
    plain = plain.otherwise(F.replace(F.replace(read, F.lit("<n>"), F.lit("")), F.lit("<p>"), F.lit("")))
    nameless = F.replace(read, F.lit("<p>"), F.lit(""))
    counted = F.when(read.contains("<n>"), F.regexp_replace(nameless, _VALUE, "$1")).otherwise(nameless)
    split = lambda x, name: F.split(x, r"\s+").alias(name)
    rows = rows.select("*", split(read, "values"), split(bare, "words"), split(counted, "counted"), split(plain, "plain"))
    return rows.drop("read", text)


def _hash(words: str, width: int = WINDOW) -> Column:
    """The hash of the window at `at`; past the end of a text it is that of the words there are."""
    return F.xxhash64(F.slice(words, F.col("at") + 1, width))


def _windows(rows: DataFrame, readings: list[str], widths: list[int]) -> DataFrame:
    """rows once for each window and hash: `at`, and the hash of its words in a reading; plain ones in all widths."""
    # The outer form, since the filter that goes with the other would read every text a second time.
    places = F.when(F.size("words") >= min(widths), F.sequence(F.lit(0), F.size("words") - min(widths)))
    rows = rows.withColumn("at", F.explode_outer(places)).where("at is not null")
    hashes = [_hash(x) for x in readings] + [_hash("plain", n) for n in widths if n != WINDOW]
    if len(hashes) == 1:
        return rows.withColumn("hash", hashes[0])
    return rows.withColumn("hash", F.explode_outer(F.array_distinct(F.array(*hashes))))


def _items(benchmark: DataFrame, readings: list[str]) -> DataFrame:
    """hash, item_id, place, exact, told, item_windows, item_told, width, slots for each window and hash of the benchmark.

    exact: the hash is that of the plain words. told: the window can be looked up as a template; item_told counts these.
    slots: offset and value, as read and plain.
    """
    items = benchmark.select(
        benchmark["item_id"].cast("long").alias("item_id"), F.coalesce(benchmark["text"].cast("string"), F.lit("")).alias("text")
    )
    items = items.where("item_id is not null").groupBy("text").agg(F.min("item_id").alias("item_id"))
    rows = _read(items, "text").withColumn("width", F.least(F.lit(WINDOW), F.size("words"))).where(F.element_at("words", 1) != "")
    if "plain" not in readings:
        rows = rows.where(F.col("width") == WINDOW)
    rows = rows.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("width"))))
    each = F.array(*(
        F.struct(F.lit(k).alias("k"), F.get("values", F.col("at") + k).alias("was"), F.get("plain", F.col("at") + k).alias("said"))
        for k in range(WINDOW)
    ))
    rows = rows.withColumn("slots", F.filter(each, lambda x: x["was"].startswith("<")))
    rows = rows.withColumn("told", (F.col("width") == WINDOW) & (F.size("slots") <= WINDOW - LITERALS))
    told = rows.where("told").groupBy("item_id").agg(F.count("*").alias("item_told"))
    rows = rows.join(told, "item_id", "left").withColumn("item_told", F.coalesce("item_told", F.lit(0)))
    literal = F.size(F.filter("slots", lambda x: ~x["was"].startswith("<p>"))) <= WINDOW - LITERALS
    sought = {"words": F.col("told"), "counted": (F.col("width") == WINDOW) & literal, "plain": F.lit(True)}
    hashes = F.array(*(
        F.struct(_hash(x).alias("hash"), F.lit(x == "plain").alias("exact"), sought[x].alias("sought")) for x in readings
    ))
    rows = rows.withColumn("x", F.explode(hashes)).where("x.sought")
    # A window without placeholders has one hash in all readings.
    return rows.groupBy("item_id", F.col("at").alias("place"), "x.hash").agg(
        F.max("x.exact").alias("exact"),
        *(F.first(c).alias(c) for c in ("told", "item_told", "width", "slots")),
        F.first(F.size("words") - F.col("width") + 1).alias("item_windows"),
    )


def find(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """What `search` gives, by the narrower rule that all slots, numbers too, are consistent."""
    return _best(docs, benchmark, False)


def search(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per contaminated document and item.

    doc_id, item_id, n_windows (of the best alignment), item_windows, first_word (its place in the document), n_slots,
    n_changed (slots whose value is not the item's).
    """
    return _best(docs, benchmark, True)


def _enough(count: str, total: str) -> Column:
    return (F.col(count) >= LEAST_WINDOWS) | (F.col(count) >= F.col(total) * LEAST_SHARE)


def _lines(docs: DataFrame, benchmark: DataFrame, whole: bool) -> DataFrame:
    """doc_id, th (the text's hash), item_id and the alignments that count, as structs of which the largest is the best."""
    readings = ["words", "counted", "plain"] if whole else ["words"]
    items = _items(benchmark, readings)
    known = items.agg(F.count("*").alias("n"), F.collect_set("width").alias("widths")).first()
    widths = sorted({WINDOW, *known["widths"]})
    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = _read(docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text")), "text")
    if known["n"] <= BROADCAST_ROWS:
        items = F.broadcast(items)
    else:
        some = _windows(rows, readings, widths).join(items.select("hash").distinct(), "hash", "left_semi").select("doc_id", "th").distinct()
        some = some.select(F.col("doc_id").alias("id"), F.col("th").alias("text_hash"))
        rows = rows.join(some, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("th") == F.col("text_hash")), "left_semi")
    # A name that stands for itself need not be read as a name in the document.
    was, now = ("said", "plain") if whole else ("was", "values")
    slot = lambda x: F.struct(
        F.substring(x["was"], 1, 3).alias("kind"), x[was].alias("was"), F.get(now, F.col("at") + x["k"]).alias("now")
    )
    met = _windows(rows, readings, widths).join(items, "hash").select(
        "doc_id", "th", "item_id", "item_windows", "item_told", "place", "exact", "told",
        (F.col("at") - F.col("place")).alias("shift"), F.transform("slots", slot).alias("slots"),
    )
    # One alignment has a few rows per window of the item at most, so these sets are no longer than an item.
    places = lambda kind: F.size(F.collect_set(F.when(F.col(kind), F.col("place"))))
    lines = met.groupBy("doc_id", "th", "item_id", "item_windows", "item_told", "shift").agg(
        F.size(F.collect_set("place")).alias("n_windows"), F.min("place").alias("from"),
        places("exact").alias("n_exact"), places("told").alias("n_told"),
        F.array_distinct(F.flatten(F.collect_set("slots"))).alias("slots"),
    )
    lines = lines.withColumn("bound", F.filter("slots", lambda x: x["kind"] == "<p>") if whole else F.col("slots"))
    consistent = (F.size(F.array_distinct("bound.was")) == F.size("bound")) & (F.size(F.array_distinct("bound.now")) == F.size("bound"))
    enough = _enough("n_windows", "item_windows")
    if whole:
        of_told = (F.col("n_told") > 0) & _enough("n_told", "item_told")
        lines = lines.where(_enough("n_exact", "item_windows") | consistent & (enough | of_told))
    else:
        lines = lines.where(enough & consistent)
    return lines.select(
        "doc_id", "th", "item_id",
        F.struct(
            "n_windows", (-(F.col("from") + F.col("shift"))).alias("back"), "item_windows", F.size("slots").alias("n_slots"),
            F.size(F.filter("slots", lambda x: x["was"] != x["now"])).alias("n_changed"),
        ).alias("line"),
    )


def _best(docs: DataFrame, benchmark: DataFrame, whole: bool) -> DataFrame:
    best = _lines(docs, benchmark, whole).groupBy("doc_id", "item_id").agg(F.max("line").alias("line"))
    return best.select(
        "doc_id", "item_id", F.col("line.n_windows").cast("long").alias("n_windows"),
        F.col("line.item_windows").cast("long").alias("item_windows"), (-F.col("line.back")).cast("long").alias("first_word"),
        F.col("line.n_slots").cast("long").alias("n_slots"), F.col("line.n_changed").cast("long").alias("n_changed"),
    )


def drop_found(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, in which no item was found.

    A row is known by its id, null or not, and its text: of one id only the rows go whose own text holds an item.
    """
    found = _lines(docs, benchmark, True).select("doc_id", "th").distinct()
    found = found.select(F.col("doc_id").alias("found_id"), F.col("th").alias("found_text"))
    text = F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit("")))
    same = docs["doc_id"].cast("long").eqNullSafe(found["found_id"]) & (text == found["found_text"])
    return docs.join(found, same, "left_anti")
