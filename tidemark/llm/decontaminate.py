"""Benchmark decontamination by canonical templates, in DataFrame operations only.

Numbers, names (runs of capitalised words) and units become typed placeholders, one for a run. Windows of template words of the
benchmark meet those of the documents by hash, if enough of their words are literal. Where a document follows an item at one
offset, the placeholders' words are compared: a re-parameterised question replaces each value of the item by one value of its
own, so values and words must map one to one. Templates depend on the case of letters. So windows of plain words without regard to case
are sought as well. Items too short for a window are found where they are a document's whole text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, id_text, written

#: Words in a window, and how many of a template's must be literal.
WINDOW, LITERAL = 8, 3
#: Shares of an item's windows that a document must have, and of its slots that must agree with one mapping; and a number of windows that suffices for a long item.
COVERAGE, AGREEMENT, LONG = 0.5, 0.8, 16
#: Windows of a benchmark that are broadcast at most (some 200 bytes each); beyond, the join shuffles.
BROADCAST_WINDOWS = 500_000
#: Units of measure.
UNITS = ["mm", "cm", "km", "mg", "kg", "ml", "kb", "mb", "gb", "meter", "meters", "metre", "metres", "kilometer", "kilometers", "kilometre", "kilometres", "mile", "miles", "inch", "inches", "feet", "gram", "grams", "pound", "pounds", "liter", "liters", "litre", "litres", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months", "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents", "percent", "degree", "degrees"]


_CAPITAL = "[A-ZÀ-ÖØ-Þ]"
_JOINER = "\u02ee"  # a letter to the splitting pattern
PLAIN, TYPED, WHOLE = range(3)


def words(text: Column) -> Column:
    """Runs of letters and digits."""
    return F.array_remove(F.split(text, r"[^\p{L}\p{N}]+"), "")


def joined_runs(text: Column) -> Column:
    """Capitalised words with only spaces between them become one word, and so does a number with its separators."""
    numbers = F.regexp_replace(text, "(?<=[0-9])[.,](?=[0-9])", "")
    return F.regexp_replace(numbers, rf"(?<![\p{{L}}\p{{N}}])({_CAPITAL}[\p{{L}}\p{{N}}]*) +(?={_CAPITAL})", f"$1{_JOINER}")


def is_slot(word: Column) -> Column:
    """Starts with a digit or a capital letter, or is a unit."""
    return (word < "[") | ((word >= "À") & (word < "ß")) | F.lower(word).isin(UNITS)


def template(of: Column) -> Column:
    """A code for each word: 1 for a number, 2 for a name, 3 for a unit, else its hash."""
    return F.transform(of, lambda w: F.when(w < ":", F.lit(1).cast("long")).when(w < "[", F.lit(2).cast("long")).when((w >= "À") & (w < "ß"), F.lit(2).cast("long")).when(F.lower(w).isin(UNITS), F.lit(3).cast("long")).otherwise(F.xxhash64(w)))


def folded(of: Column) -> Column:
    """The hash of each word without regard to case."""
    return F.transform(of, lambda w: F.xxhash64(F.upper(w)))


def windows(codes: Column, n: int) -> Column:
    """A hash of every n codes in a row: of two hashes of half as many each, or of more that overlap."""

    def joined(h: Column, step: int) -> Column:  # h is bound to a name, else it would be computed twice
        return F.transform(F.array(h), lambda x: F.zip_with(F.slice(x, F.lit(1), F.size(x) - step), F.slice(x, F.lit(step + 1), F.size(x) - step), lambda a, b: F.xxhash64(a, b)))[0]

    hashes, width = codes, 1
    while width < n:
        step = min(width, n - width)
        hashes, width = joined(hashes, step), width + step
    return F.when(F.size(codes) >= n, hashes).otherwise(F.array().cast("array<long>"))


def _split(texts: DataFrame, keep: list[str]) -> DataFrame:
    return texts.select(*keep, words(F.col("text")).alias("plain"), words(joined_runs(F.col("text"))).alias("typed"))


def _cut(words: str, pos: str, n: int) -> Column:
    return F.slice(words, F.col(pos) + 1, F.lit(n))


def _windows(texts: DataFrame, n: int, keep: list[str]) -> DataFrame:
    """Every window of n words of texts (text, and the columns to keep): kind, pos, hash, and `of`, all words. A text of fewer words is one of kind WHOLE."""
    coded = _split(texts, keep).select(*keep, "plain", "typed", folded(F.col("plain")).alias("folded"), template(F.col("typed")).alias("codes"))
    kind = lambda k, of, hashes: F.struct(F.lit(k).alias("kind"), F.col(of).alias("of"), hashes.alias("hashes"))
    short = F.when(F.size("plain").between(1, n - 1), F.array(F.xxhash64("folded"))).otherwise(F.array().cast("array<long>"))
    every = F.array(kind(PLAIN, "plain", windows(F.col("folded"), n)), kind(TYPED, "typed", windows(F.col("codes"), n)), kind(WHOLE, "plain", short))
    return coded.select(*keep, F.explode(every).alias("w")).select(*keep, "w.kind", "w.of", F.posexplode("w.hashes").alias("pos", "hash"))


def contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, coverage: float = COVERAGE, agreement: float = AGREEMENT, long: int = LONG, literal: int = LITERAL, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row for each document and benchmark item it holds: doc_id, item_id, windows, coverage, agreement, changed_slots.

    windows counts the item's different windows of n words found in the document, in any case (plain) or as templates at offsets where
    the slots agree one to one (typed), whichever cover more of the item; coverage is their share of the item's. A document
    holds an item with the share `coverage` of its windows, or with `long` of them. Template windows have `literal` words at least
    that are no placeholders. An item of fewer than n words is only found in a document that has the same words
    and no others. changed_slots counts placeholders with another word than the item's. Null and empty texts and items, and rows with a
    null id, give no row. Repeated rows of an id count once. Other columns are ignored.
    """
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("text")).where("item_id IS NOT NULL")
    wanted = _windows(items, n, ["item_id"]).withColumnRenamed("pos", "item_pos").withColumn("item_words", _cut("of", "item_pos", n))
    literals = F.size(F.filter("item_words", lambda w: ~is_slot(w)))
    wanted = wanted.where((F.col("kind") != TYPED) | (literals >= literal))
    wanted = wanted.groupBy("item_id", "kind", "hash").agg(F.min_by(F.struct("item_pos", "item_words"), "item_pos").alias("w")).select("item_id", "kind", "hash", "w.*")
    wanted = written(wanted, "benchmark-windows")
    sought = wanted.select("item_id", "kind", "item_pos", "hash")

    texts = id_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
    seen = _windows(texts, n, ["doc_id"])
    if sought.count() <= BROADCAST_WINDOWS:  # the words of a window are cut out where it is found, in the scan's own stage
        found = seen.join(F.broadcast(sought), ["kind", "hash"]).withColumnRenamed("of", "typed")
    else:  # only hashes are shuffled; documents with a window found are read again, rows that share an id told apart by their text
        keyed = texts.withColumn("text_key", F.sha2("text", 256))
        hits = _windows(keyed, n, ["doc_id", "text_key"]).drop("of").join(sought, ["kind", "hash"])
        hits = written(hits.select("doc_id", "text_key", "kind", "pos", "item_id", "item_pos").distinct(), "template-windows")
        found = _split(keyed, ["doc_id", "text_key"]).select("doc_id", "text_key", "typed").join(hits, ["doc_id", "text_key"])
    found = written(found.select("doc_id", "item_id", "kind", "item_pos", (F.col("pos") - F.col("item_pos")).alias("offset"), F.when(F.col("kind") == TYPED, _cut("typed", "pos", n)).alias("doc_words")), "template-windows")

    typed = found.where(F.col("kind") == TYPED).drop("kind").join(wanted.where(F.col("kind") == TYPED).select("item_id", "item_pos", "item_words"), ["item_id", "item_pos"])
    slots = typed.select("doc_id", "item_id", "offset", "item_pos", F.posexplode(F.arrays_zip("item_words", "doc_words")).alias("k", "z")).where(is_slot(F.col("z.item_words")))
    slots = slots.select("doc_id", "item_id", "offset", (F.col("item_pos") + F.col("k")).alias("at"), F.col("z.item_words").alias("value"), F.col("z.doc_words").alias("word")).distinct()
    place = ["doc_id", "item_id", "offset"]
    mapped = slots.groupBy(*place, "value", "word").agg(F.count(F.lit(1)).alias("times"))
    changed = F.sum(F.when(F.col("value") != F.col("word"), F.col("times")).otherwise(0))
    values = mapped.groupBy(*place, "value").agg(F.max("times").alias("most"), F.sum("times").alias("all"), changed.alias("changed")).withColumn("of_value", F.lit(True))
    per_word = mapped.groupBy(*place, "word").agg(F.max("times").alias("most"), F.lit(0).cast("long").alias("all"), F.lit(0).cast("long").alias("changed")).withColumn("of_value", F.lit(False))
    each = values.drop("value").union(per_word.drop("word")).groupBy(*place).agg(
        F.least(F.sum(F.when(F.col("of_value"), F.col("most"))), F.sum(F.when(~F.col("of_value"), F.col("most")))).alias("agree"), F.sum("all").alias("all"), F.sum("changed").alias("changed")
    )  # the lesser of what a mapping of values to words explains and of what one of words to values does
    at = typed.select(*place, "item_pos").distinct().join(each, place, "left").fillna(0, ["agree", "all", "changed"]).where(F.col("agree") >= agreement * F.col("all"))
    by_offset = at.select(*place, "agree", "all", "changed").distinct().groupBy("doc_id", "item_id").agg(*[F.sum(c).alias(c) for c in ("agree", "all", "changed")])
    covered = at.select("doc_id", "item_id", F.lit(TYPED).alias("kind"), "item_pos").union(found.where(F.col("kind") != TYPED).select("doc_id", "item_id", "kind", "item_pos"))
    covered = covered.groupBy("doc_id", "item_id", "kind").agg(F.countDistinct("item_pos").alias("windows"))
    total = wanted.groupBy("item_id", "kind").agg(F.count(F.lit(1)).alias("total"))
    held = covered.join(total, ["item_id", "kind"]).where((F.col("windows") >= coverage * F.col("total")) | (F.col("windows") >= long))
    held = held.groupBy("doc_id", "item_id").agg(F.max(F.struct((F.col("windows") / F.col("total")).alias("share"), "windows")).alias("best"))
    return (
        held.join(by_offset, ["doc_id", "item_id"], "left")
        .fillna(0, ["agree", "all", "changed"])
        .select(
            "doc_id",
            "item_id",
            F.col("best.windows").alias("windows"),
            F.round("best.share", 6).alias("coverage"),
            F.when(F.col("all") > 0, F.round(F.col("agree") / F.col("all"), 6)).otherwise(1.0).alias("agreement"),
            F.col("changed").cast("long").alias("changed_slots"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = WINDOW) -> DataFrame:
    """docs without those that hold a benchmark item; the columns stay as they are.

    Rows that share an id go together; a row with a null id or text stays. Without items all rows stay.
    """
    name = free_name(docs, "found_id")
    found = contaminated(docs, benchmark, n, id_col=id_col, text_col=text_col).select(F.col("doc_id").alias(name)).distinct()
    return docs.join(found, F.col(id_col).cast("long") == F.col(name), "left_anti")
