"""Operator 7: line dedup by a deletion-neighbourhood join.

Lines are compared as lower-cased words; two are near if one word inserted, deleted
or replaced makes them equal (edit bound 1). A line goes if an earlier one, in order
of (doc_id, line number), is equal or near.

1. Equal lines of any length meet by a 128-bit hash; the earliest of them stands for all.
   Only lines without a word are never compared.
2. Of lines of ``MIN_WORDS`` words or more, near ones are looked for. A single edit leaves one half of the words as it was. Lines whose halves no other
   line has are done; only the rest go on, so few lines emit variants.
3. Each of these emits itself and all variants with one word deleted, as hashed keys:
   words are hashed with their place and combined by XOR, so that running XORs from
   both ends give all variants of a line in one pass.
4. Equal keys join: with the same deleted place two lines differ by a replaced word;
   a variant that equals a whole line, by an inserted one. Every member of a key is
   joined with the earliest only, so a template of a million lines makes as many pairs.
5. The edit distance of each pair is verified on the words; the earliest remains.

Column expressions only. Counts are summed up before shuffles, and no line, key or
document of any number of copies is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.tables import stored
from .common import let, marked_present, running

#: Lines of fewer words are compared for equality only: one edit of few words says little.
MIN_WORDS = 8
LINE = "line"


def plain_lines(text: Column) -> Column:
    """The lines of a text in lower case, with one blank for white space of any length."""
    return F.split(F.regexp_replace(F.lower(text), r"[\x20\x09\x0B-\x0D]+", " "), "\n")


def said(line: Column) -> Column:
    """The words of a plain line, joined by one blank. No word holds a blank, so texts are
    equal where the words are."""
    return F.trim(line)


def _hashes(words: Column) -> tuple[Column, Column]:
    return F.xxhash64(words), F.xxhash64(F.lit(1), words)


#: A line's place. Texts of one doc_id are told apart by their hashes.
PLACE = ("doc_id", "line_no", "text_hash")


def _lines(rows: DataFrame, min_words: int, equal_words: int) -> DataFrame:
    """Lines that take part: place, hash of the words, hashes of halves (null in short lines).

    Words are counted and taken from the text of a line, without a list of them: a lambda
    over such a list is not compiled, and a filter by what it gives computes it twice.
    """
    lines = rows.select("doc_id", "text_hash", F.posexplode(plain_lines(F.col("text"))).alias("line_no", "line"))
    words = F.col("words")
    blanks = F.octet_length(words) - F.octet_length(F.replace(words, F.lit(" "), F.lit("")))
    lines = lines.select(*PLACE, said(F.col("line")).alias("words")).where("words != ''")
    lines = lines.withColumn("size", (blanks + 1).cast("int"))
    if min(min_words, equal_words) > 1:
        lines = lines.where(F.col("size") >= min(min_words, equal_words))
    size = F.col("size")

    def half(length: Column, last: bool) -> Column:
        part = F.call_function("substring_index", words, F.lit(" "), -length if last else length)
        return F.xxhash64(length, F.lit(last), part)

    # For a common part of as many words as the line, and of one less. The first words of
    # an odd line are as many for both, and so are the last words of an even one.
    less = F.floor((size - 1) / 2).cast("int")
    halves = F.array(
        half(F.floor(size / 2).cast("int"), False),
        half(F.ceil(size / 2).cast("int"), True),
        F.when(size % 2 == 0, half(less, False)).otherwise(half(less, True)),
    )
    h, g = _hashes(words)
    return lines.select(*PLACE, h.alias("h"), g.alias("g"), F.when(size >= min_words, halves).alias("halves"))


def _variants(words: Column) -> Column:
    """(key, p): the line without its word p, and the whole line at p = -1."""
    none, xor = F.lit(0).cast("bigint"), Column.bitwiseXOR
    here = F.transform(words, lambda w, i: F.xxhash64(i, w))
    moved = F.transform(words, lambda w, i: F.xxhash64(i - 1, w))

    def keys(left: Column, right: Column) -> Column:
        size = F.size(left)

        def without(upto: Column, p: Column) -> Column:
            after = F.element_at(right, -1).bitwiseXOR(F.get(right, p))
            before = F.when(p > 0, F.get(left, p - 1)).otherwise(none)
            return F.struct(F.xxhash64(before.bitwiseXOR(after), size - 1).alias("key"), p.alias("p"))

        whole = F.struct(F.xxhash64(F.element_at(left, -1), size).alias("key"), F.lit(-1).alias("p"))
        return F.concat(F.array(whole), F.transform(left, without))

    return let(running(here, xor), lambda left: let(running(moved, xor), lambda right: keys(left, right)))


def _near_lines(firsts: DataFrame, rows: DataFrame) -> DataFrame:
    """(first, keeper): first lines with an earlier near one, and the earliest of those."""
    wanted = stored(firsts.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("line_no", "h", "g")).alias("own")), "near-docs")

    def own_lines(lines: Column) -> Column:
        return F.transform(
            "own", lambda o: F.struct(o.line_no.alias("line_no"), o.h.alias("h"), o.g.alias("g"), F.get(lines, o.line_no).alias("line"))
        )

    found = marked_present(rows, "doc_id", wanted.select("doc_id")).where("maybe__").drop("maybe__").join(wanted, ["doc_id", "text_hash"])
    found = found.select("doc_id", "text_hash", F.explode(let(plain_lines(F.col("text")), own_lines)).alias("l"))
    found = found.select("doc_id", "l.line_no", "text_hash", "l.h", "l.g", said(F.col("l.line")).alias("words"))
    h, g = _hashes(F.col("words"))
    texts = found.where((h == F.col("h")) & (g == F.col("g"))).withColumn("words", F.split("words", " "))
    texts = stored(texts.select(*PLACE, "words").dropDuplicates(PLACE), "near-lines")
    keys = texts.select(*PLACE, F.inline(_variants(F.col("words"))))
    bounds = [least(name).alias(f"{kind}_{name}") for name in PLACE for kind, least in (("low", F.min), ("high", F.max))]
    several = " or ".join(f"low_{name} < high_{name}" for name in PLACE)
    met = keys.groupBy("key").agg(*bounds).where(several).select("key")
    place = F.struct(*PLACE).alias("line")
    keys = stored(keys.join(met, "key", "left_semi").select("key", "p", place), "variants")
    deleted, full = keys.where("p >= 0"), keys.where("p < 0").drop("p")
    replaced = deleted.groupBy("key", "p").agg(F.min("line").alias("first"))
    longer = deleted.groupBy("key").agg(F.min("line").alias("first"))
    pairs = (
        deleted.join(replaced, ["key", "p"]).select("line", "first")
        .union(deleted.join(full.withColumnRenamed("line", "first"), "key").select("line", "first"))
        .union(full.join(longer, "key").select("line", "first"))
    )
    pairs = pairs.where("first < line").distinct()
    side = texts.select(place, "words")
    checked = pairs.join(side, "line").join(side.toDF("first", "others"), "first")
    checked = checked.where(_within_one_edit(F.col("words"), F.col("others")))
    return checked.groupBy(F.col("line").alias("first")).agg(F.min("first").alias("keeper"))


def _within_one_edit(a: Column, b: Column) -> Column:
    """Whether all but one word of the longer list are a common start and end."""

    def common(x: Column, y: Column) -> Column:
        differs = F.array_position(F.zip_with(x, y, lambda u, v: u.eqNullSafe(v)), False)
        return F.when(differs > 0, differs - 1).otherwise(F.least(F.size(x), F.size(y)))

    return common(a, b) + common(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def repeated_lines(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, near: bool = True, equal_words: int = 1
) -> DataFrame:
    """(doc_id, line_no, text_hash, keeper_doc_id, keeper_line_no, edits): the lines that go.

    ``keeper`` is the earliest line that is equal (edits 0) or, if that is earlier,
    near (edits 1). Lines count from 0 and end at line feeds. Lines of fewer than
    ``min_words`` words have no near ones, and those of fewer than ``equal_words``
    (and ``min_words``) no equal ones either; a line without a word stays. Repeated rows
    of one document are that document; rows of one doc_id with different texts, which
    ``text_hash`` tells apart, are several, of which a line with the smaller hash is
    earlier at the same number. A row without a doc_id is left as it is. Empty texts and
    tables give no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    rows = rows.where("doc_id is not null and text is not null")
    lines = stored(_lines(rows, min_words, max(1, equal_words)), "lines")
    repeated = lines.groupBy("h").agg(F.count("*").alias("times")).where("times > 1").select("h")
    place = F.struct(*PLACE)
    if near:
        halves = lines.select("h", F.explode("halves").alias("half"))
        met = halves.groupBy("half").agg(F.min("h").alias("low"), F.max("h").alias("high")).where("low < high")
        alike = stored(halves.join(met.select("half"), "half", "left_semi").select("h").distinct(), "alike")
        repeated = repeated.union(alike).distinct()
    own = stored(lines.select(*PLACE, "h", "g").join(repeated, "h", "left_semi"), "own-lines")
    firsts = stored(own.groupBy("h", "g").agg(F.min(place).alias("first")), "first-lines")
    marked = own.join(firsts, ["h", "g"])
    if near:
        chosen = firsts.join(alike, "h", "left_semi").select("h", "g", "first.*")
        marked = marked.join(_near_lines(chosen, rows), "first", "left")
    else:
        marked = marked.withColumn("keeper", F.lit(None).cast(marked.schema["first"].dataType))
    goes = (place != F.col("first")) | F.col("keeper").isNotNull()
    found = marked.where(goes).withColumn("at", F.coalesce("keeper", "first"))
    return found.select(
        *PLACE,
        F.col("at.doc_id").alias("keeper_doc_id"),
        F.col("at.line_no").alias("keeper_line_no"),
        F.when(F.col("keeper").isNotNull(), 1).otherwise(0).alias("edits"),
    ).distinct()


def without_repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Documents with the text of the lines that stay, and ``dropped``: those that go.

    ``dropped`` lists (line_no, keeper_doc_id, keeper_line_no, edits) by line, empty
    if all stay; a column of that name is replaced. Other columns and null texts stay.
    Equal rows of one document are cut alike.
    """
    repeated = repeated_lines(docs, doc_id, text, **options)
    entry = F.struct("line_no", "keeper_doc_id", "keeper_line_no", "edits")
    gone = repeated.groupBy(F.col("doc_id").alias("id__"), F.col("text_hash").alias("hash__")).agg(F.array_sort(F.collect_list(entry)).alias("dropped"))
    gone = stored(gone, "gone-lines")
    nothing = F.array().cast("array<struct<line_no:int,keeper_doc_id:bigint,keeper_line_no:int,edits:int>>")
    both = marked_present(docs.drop("dropped"), doc_id, gone.select("id__"))
    untouched = both.where(~F.coalesce("maybe__", F.lit(False))).withColumn("dropped", nothing)
    same = (F.col(doc_id) == F.col("id__")) & (F.xxhash64(text) == F.col("hash__"))
    joined = both.where("maybe__").join(gone, same, "left").drop("id__", "hash__")
    kept = let(
        F.col("dropped.line_no"),
        lambda numbers: F.filter(F.split(F.col(text), "\n"), lambda _, i: ~F.array_contains(numbers, i)),
    )
    joined = joined.withColumns(
        {
            text: F.when(F.col("dropped").isNull(), F.col(text)).otherwise(F.array_join(kept, "\n")),
            "dropped": F.coalesce("dropped", nothing),
        }
    )
    return untouched.unionByName(joined).drop("maybe__")
