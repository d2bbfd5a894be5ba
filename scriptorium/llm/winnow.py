"""Document fingerprints by winnowing, in DataFrame functions only.

A text's words (runs without the six ASCII blanks) are hashed once each, and a rolling hash joins every k of them: a cyclic polynomial, in which each word's hash is rotated by
its place, so that hashes of a + b words come from those of a and of b words without going back to the text. Of every window of w neighbouring hashes
the smallest is selected, the rightmost of equal ones, with its position. Two texts that share w + k - 1 words in a row
share a selected hash. Some texts have no blanks between words, so a word of over 64 bytes and code points, or with over 8 of scripts written without
blanks, counts as its code points, one word each: shared runs of more than 64, or with more than 8 of such scripts, are found wherever they stand. A hash (32 bits) and its position are held in one long, hash above and position counted down below, so that the
smallest long is the smallest hash at its rightmost place.

Next documents are found without one task seeing all: the order (id, then a hash of the text) is cut into ranges of about equally many rows, each range is a window of its
own, and the first document of a range is put, marked, behind the range before it (the very first behind the very last). Rows of one id, or without one, may be in many ranges.

Defined results: a null text counts as empty. A text with fewer than k words has one hash, of all of them; one without words has an empty
fingerprint. Likeness is the Jaccard likeness of the selected hashes, 1 for two empty fingerprints. Rows with equal ids
follow each other by a hash of their text; a null id comes first. Rows that are equal in both are next to each other. A table of one document has itself as next. Very long
texts are read whole. No rows: no rows. Columns other than the id and the text are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from scriptorium.llm.storage import materialize, reading

K, WINDOW = 5, 4
BLANK = r"\x20\x09-\x0D"
SCRIPTS = r"\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsThai}\p{IsLao}\p{IsKhmer}\p{IsMyanmar}"
#: A word with a match is cut into code points.
UNSPACED = rf"[^{BLANK}]{{65}}|(?:[{SCRIPTS}][^{BLANK}{SCRIPTS}]*+){{9}}"
#: Code points among which those scripts are, to see quickly that a text has none.
FAR = r"[\x{e00}-\x{10ffff}]"
LAST = (1 << 31) - 1
#: More elements than any array has from some place on.
REST = 1 << 30
#: Bits that a word's hash is rotated by for each place.
TURN = 7


def let(value: Column, body) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    def cut(found: Column) -> Column:
        parts = F.flatten(F.transform(found, lambda w: F.when(w.rlike(UNSPACED), F.split(w, "", -1)).otherwise(F.array(w))))
        # the full pattern is looked for only where there may be a match
        odd = F.exists(found, lambda w: F.octet_length(w) > 64) | (text.rlike(FAR) & text.rlike(UNSPACED))
        return F.when(odd, parts).otherwise(found)

    return let(F.array_remove(F.split(text, f"[{BLANK}]+", -1), ""), cut)


def turned(x: Column, places: int) -> Column:
    """x rotated left for so many places."""
    bits = TURN * places % 64
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits)) if bits else x


def rolled(h: Column, k: int, then) -> Column:
    """then(hashes of every k values in a row of h); what has fewer than k after it follows behind, to be cut off."""

    def step(known: dict[int, Column], size: int) -> Column:
        if size == k:
            return then(known[size])
        # known are hashes of 1, 2, 4, ... values in a row: the largest of these that fits comes behind
        more = 1 << min(size, k - size).bit_length() - 1
        joined = F.zip_with(known[size], F.slice(known[more], size + 1, REST), lambda x, y: turned(x, more).bitwiseXOR(y))
        return let(joined, lambda new: step({**known, size + more: new}, size + more))

    return step({1: h}, 1)


def selected(text: Column, k: int = K, window: int = WINDOW) -> Column:
    """The selected hashes with positions, packed, in order of the text."""
    packed = lambda x, at: F.shiftleft(F.shiftrightunsigned(x, 32), 31).bitwiseOR((F.lit(LAST) - at).cast("long"))
    none = F.array().cast("array<long>")

    def grams(w: Column) -> Column:
        each = F.transform(w, lambda x: F.xxhash64(x))
        many = let(each, lambda h: rolled(h, k, lambda r: F.transform(F.slice(r, 1, F.size(w) - (k - 1)), packed)))
        return F.when(F.size(w) >= k, many).when(F.size(w) > 0, F.array(packed(F.xxhash64(w), F.lit(0)))).otherwise(none)

    def minima(g: Column) -> Column:
        def slid(built: Column, size: int) -> Column:
            if size == window:
                return F.array_distinct(F.slice(built, 1, F.size(g) - (window - 1)))
            grow = min(size, window - size)
            return let(F.zip_with(built, F.slice(built, grow + 1, REST), lambda x, y: F.least(x, y)), lambda b: slid(b, size + grow))

        return F.when(F.size(g) > window, slid(g, 1)).when(F.size(g) > 0, F.array(F.array_min(g))).otherwise(g)

    return let(let(let(F.coalesce(text, F.lit("")), words), grams), minima)


def hashes(prints: Column) -> Column:
    return F.array_distinct(F.transform(prints, lambda x: F.shiftright(x, 31)))


def positions(prints: Column) -> Column:
    """array<struct<hash, pos>>: pos is the number of the first word (or code point that counts as one), from 0."""
    return F.transform(prints, lambda x: F.struct(F.shiftright(x, 31).alias("hash"), (F.lit(LAST) - x.bitwiseAND(F.lit(LAST))).cast("int").alias("pos")))


def digest(prints: Column) -> Column:
    """16 hex digits of the selected hashes and positions."""
    return F.lower(F.lpad(F.hex(F.xxhash64(prints)), 16, "0"))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two arrays of distinct hashes."""
    common = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, F.lit(1.0)).otherwise(let(common, lambda n: n / (F.size(a) + F.size(b) - n)))


def fingerprints(docs: DataFrame, text: str = "text", k: int = K, window: int = WINDOW) -> DataFrame:
    """doc_id and prints: array<struct<hash, pos>>."""
    return docs.select("doc_id", positions(selected(F.col(text), k, window)).alias("prints"))


def range_ends(keys: DataFrame, parts: int) -> DataFrame:
    """Cuts the order of column key (a struct, null fields first) into ranges of about equally many rows: a written table of the least key of each."""
    dealt = keys.select("key").repartitionByRange(parts, "key").withColumn("part", F.spark_partition_id())
    return materialize(dealt.groupBy("part").agg(F.min("key").alias("least")).select("least"), "range-ends")


def with_range(rows: DataFrame, ends: DataFrame, parts: int) -> DataFrame:
    """rows with column range, the number of their key's range. The ends are one value of a subquery, looked up by halves: nothing in the plan grows with their number."""
    # the first range begins wherever the order does
    held = rows.withColumn("ends", ends.agg(F.slice(F.array_sort(F.collect_list("least")), 2, REST)).scalar())
    steps = [1 << i for i in range(parts.bit_length() - 1, -1, -1)]
    # as many ends as are no greater than the key
    found = F.aggregate(F.lit(steps), F.lit(0), lambda low, step: F.when(F.get("ends", low + step - 1) <= F.col("key"), low + step).otherwise(low))
    return held.withColumn("range", found).drop("ends")


def with_next(docs: DataFrame, parts: int) -> DataFrame:
    """key (doc_id and the text's hash), text (null: empty) of every row, its range, and whether it's there only as the next one of the range before."""
    rows = docs.select(F.coalesce("text", F.lit("")).alias("text"), F.struct("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).alias("key"))
    ends = range_ends(rows, parts)
    rows = with_range(rows, ends, parts)
    # a row for each range
    least = rows.groupBy("range").agg(F.min("key").alias("first"))
    order = Window.orderBy("range")
    back = least.withColumn("before", F.coalesce(F.lag("range").over(order), F.max("range").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))))
    same = rows.join(F.broadcast(back.withColumnRenamed("range", "own")), (F.col("range") == F.col("own")) & F.col("key").eqNullSafe(F.col("first")))
    ghosts = same.groupBy("before", "first").agg(F.min("text").alias("text")).select("text", F.col("first").alias("key"), F.col("before").alias("range"), F.lit(True).alias("ghost"))
    return reading(rows.withColumn("ghost", F.lit(False)).unionByName(ghosts), ends)


def compare_edits(docs: DataFrame) -> DataFrame:
    """For each row its fingerprint, that of its text with the last quarter taken from the next document, and likenesses."""
    parts = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("range").orderBy("ghost", "key", "text")
    found = with_next(docs, parts)
    rows = found.withColumn("next", F.lead("text").over(order)).withColumn("place", F.row_number().over(order)).withColumn("n", F.char_length("text"))
    cut = F.floor(F.col("n") / 4).cast("int")
    edited = F.concat(F.left("text", F.col("n") - cut), F.left(F.coalesce("next", F.lit("")), cut))
    prints = rows.select("range", "place", "ghost", "key.doc_id", F.col("n").cast("long").alias("n_chars"), F.sha2(edited, 256).alias("edited_sha256"), selected(F.col("text")).alias("p"), selected(edited).alias("e"))
    own = prints.select("range", "place", "ghost", "doc_id", "n_chars", "edited_sha256", digest(F.col("p")).alias("fingerprint"), digest(F.col("e")).alias("edited_fingerprint"), F.size("p").cast("long").alias("n_prints"), hashes(F.col("p")).alias("ph"), hashes(F.col("e")).alias("eh"))
    # the same order by number: no text goes into the second window
    out = own.withColumn("nh", F.lead("ph").over(Window.partitionBy("range").orderBy("place"))).where(~F.col("ghost"))
    out = out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("ph"), F.col("eh")).alias("near_edited"), likeness(F.col("ph"), F.col("nh")).alias("near_next"), "n_prints")
    return reading(out, found)
