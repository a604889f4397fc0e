"""Document fingerprints by winnowing: hashes of word k-grams, the minimum of each window, and its position.

The hash of a k-gram of words is folded from the hashes of its halves, so that each step passes once over the text's
array of hashes; the minimum of a window is doubled up the same way. Of equal minima in a window the rightmost is
chosen. Two texts that share ``K + WINDOW - 1`` words in a row share at least one fingerprint of them (match
guarantee), and no k-gram shorter than ``K`` words can match. Everything is made of DataFrame functions.

Defined cases: a NULL text counts as empty; a text without words has the empty fingerprint, which is like another
empty one (1.0) and unlike any other (0.0); a text of fewer than ``K`` words is one k-gram; documents follow each
other by descending id, rows of one id by text, NULL ids last; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlake.llm.common import WORD, prepare

K = 5                      # words of a k-gram
WINDOW = 16                # k-grams of a window
POSITION_BITS = 31
MAX_BUCKETS = 4096         # ranges of ids that are put in order separately


def _paired(name: str, other: str, ahead: int, fold) -> Column:
    """``fold`` of each element of array ``name`` and the one ``ahead`` places on in array ``other`` (NULL past its end)."""
    return F.zip_with(name, F.slice(other, ahead + 1, F.greatest(F.size(other), F.lit(1))),
                      lambda a, b: fold(a, b))


def fingerprints(rows: DataFrame, text_col: str, out: str) -> DataFrame:
    """``rows`` with ``out``: the chosen (hash, position) pairs in order of position, each packed into one long.

    The upper 32 bits hold the hash, the lower 31 the distance of the position from the largest one, so that the
    least long of a window has the least hash and, among equals, the rightmost position.
    """
    keep = rows.columns
    top = (1 << POSITION_BITS) - 1
    hashed = rows.withColumn("_h1", F.transform(F.regexp_extract_all(
        F.coalesce(F.col(text_col), F.lit("")), F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)))
    hashed = hashed.withColumn("_h2", _paired("_h1", "_h1", 1, F.xxhash64))
    hashed = hashed.withColumn("_h4", _paired("_h2", "_h2", 2, F.xxhash64))
    hashed = hashed.withColumn("_h5", _paired("_h4", "_h1", 4, F.xxhash64))
    grams = F.greatest(F.size("_h1") - (K - 1), F.least(F.size("_h1"), F.lit(1)))
    packed = F.transform(F.slice("_h5", F.lit(1), grams), lambda h, i: F.shiftleft(
        h.bitwiseAND(F.lit(0xFFFFFFFF)), POSITION_BITS).bitwiseOR(F.lit(top) - i))
    step = hashed.select(*keep, packed.alias("_m1"))
    for width in (1, 2, 4, 8):
        step = step.withColumn(f"_m{2 * width}", _paired(f"_m{width}", f"_m{width}", width, F.least))
    windows = F.greatest(F.size("_m1") - (WINDOW - 1), F.least(F.size("_m1"), F.lit(1)))
    return step.select(*keep, F.array_distinct(F.slice(f"_m{WINDOW}", F.lit(1), windows)).alias(out))


def written(packed: str) -> Column:
    """hash:position pairs, comma-joined; the hash in hexadecimal."""
    top = (1 << POSITION_BITS) - 1
    return F.array_join(F.transform(packed, lambda v: F.concat(
        F.lower(F.hex(F.shiftright(v, POSITION_BITS))), F.lit(":"),
        (F.lit(top) - v.bitwiseAND(F.lit(top))).cast("string"))), ",")


def hashes(packed: str | Column) -> Column:
    return F.array_distinct(F.transform(packed, lambda v: F.shiftright(v, POSITION_BITS)))


def likeness(a: str, b: str) -> Column:
    """Share of common hashes among all hashes of two arrays of distinct hashes."""
    common = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - common
    return F.when(either == 0, F.lit(1.0)).otherwise(common / either)


def _below(value: Column, borders: list[int]) -> Column:
    """How many of the sorted ``borders`` are below ``value``: first among the last ones of each block, then inside a
    block, so that a row is compared with some 2 * sqrt(borders) of them."""
    block = max(1, round(len(borders) ** 0.5))
    blocks = F.size(F.filter(F.lit(borders[block - 1::block]), lambda x: x < value))
    inside = F.slice(F.lit(borders), blocks * block + 1, F.lit(block))
    return blocks * block + F.size(F.filter(inside, lambda x: x < value))


def with_next(rows: DataFrame, id_col: str, tie: str, values: list[str]) -> DataFrame:
    """``rows`` with ``next_<value>`` of the row that follows by descending id (after the last: the first).

    Ids are cut at approximate quantiles, which are ids of rows; each range is put in order by a window of its own.
    The row at the head of a range is also sent, as a guest, to the end of the range before it.
    """
    n = min(MAX_BUCKETS, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = rows.agg(F.percentile_approx(id_col, [i / n for i in range(1, n)] or [0.5], 100 * n).alias("q"),
                     F.max(id_col).alias("top")).first()
    borders = sorted({*(found.q or []), *([found.top] if found.top is not None else [])})
    last = len(borders)
    below = _below(F.col(id_col), borders) if borders else F.lit(0)
    own = F.when(F.col(id_col).isNull(), F.lit(last)).otherwise(F.lit(last) - F.col("_below"))
    heads = F.get(F.lit(borders), F.col("_below")) == F.col(id_col) if borders else F.lit(False)
    before = F.when(F.col("_own") == 1, F.lit(last)).otherwise(F.col("_own") - 1)
    home = F.struct(F.col("_own").alias("_bucket"), F.lit(False).alias("_guest"))
    guest = F.struct(before.alias("_bucket"), F.lit(True).alias("_guest"))
    placed = rows.withColumn("_below", below).withColumn("_own", own).withColumn("_head", heads).select(
        *rows.columns, F.inline(F.when(F.col("_head"), F.array(home, guest)).otherwise(F.array(home))))
    order = Window.partitionBy("_bucket").orderBy("_guest", F.col(id_col).desc_nulls_last(), tie)
    placed = placed.select("*", *[F.lead(v).over(order).alias(f"next_{v}") for v in values])
    return placed.where(~F.col("_guest")).drop("_bucket", "_guest")


def fingerprint_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (its second half replaced by the next document's start)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = with_next(fingerprints(rows, "text", "chosen"), "id", "text", ["text", "chosen"])
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half),
                      F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), half))
    rows = rows.select("id", "n_chars", "chosen", hashes("chosen").alias("own"), hashes(F.coalesce(
        "next_chosen", F.array().cast("array<bigint>"))).alias("next_own"), edited.alias("edited"))
    rows = fingerprints(rows, "edited", "edited_chosen").withColumn("edited_own", hashes("edited_chosen"))
    return rows.select(
        F.col("id").alias(id_col), "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        written("chosen").alias("fingerprint"), written("edited_chosen").alias("edited_fingerprint"),
        likeness("own", "edited_own").alias("near_edited"), likeness("own", "next_own").alias("near_next"))
