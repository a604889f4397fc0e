"""Personal data: patterns with checks, and terms that disclose a found entity by how they co-occur with it.

Base: e-mail addresses, IP addresses, card and phone numbers, each found from left to right without overlap; a match
that fails its check is dropped. Method: every distinct base value is a protected entity with information content
IC(e) = -log2 P(e). A term is a word outside the base spans. Over the whole corpus, with n_e, n_t and n_te the numbers
of different texts that hold the entity, the term and both,

    PMI(t; e) = log2(P(e|t) / P(e)),    left(t, e) = IC(e) - PMI(t; e) = -log2 P(e|t)

are the bits that a term tells about an entity and the bits that stay hidden. P(e|t) is the lower end of its 95 % credible
interval (Wilson's formula for n_te of n_t): a single meeting leaves 1.9 bits, three out of three 0.9, and neither depends
on the size of the corpus. A term is generalised where at most ``GENERALISE`` bits are left of an entity of which it tells
at least ``GAIN`` bits, and removed where at most ``REMOVE`` bits are left, wherever it stands: in every document, also in
those without base spans. Copies of a text count once, so they lose the same terms as one.

Everything is made of DataFrame functions. Only texts with base spans make pairs of entities and terms, and of these only
pairs that could reach the threshold if they met as often as n_e and n_t allow (the bound rises with n_te, so nothing is
lost). Term counts shuffle combined. The disclosing terms go to the texts as a bitmap of hashes, of a size that does not
exceed ``MOST_BITS``; words whose bit is set get their places inside the row, and only these few meet the terms themselves
in a join. Texts are exchanged only where they may have copies or are rewritten.

Defined cases: a NULL or empty text has no spans and stays as it is; equal rows have equal spans; an empty table has no
rows; NULL ids are kept; other columns are carried along.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.llm.common import materialise, prepare

GENERALISE = 1.0           # bits of an entity that a term may leave hidden, at most, to be generalised
REMOVE = 0.15              # and to be removed
GAIN = 1.0                 # bits that it tells, at least: an entity in most texts is no secret
Z = 1.6448536269514722     # quantile of the normal distribution for a one-sided level of 95 %

LEAST_BITS, MOST_BITS = 1 << 20, 1 << 27       # of a bitmap of hashes: 16 MB at most
BITS_PER_HASH = 8192
STRETCH = 1000             # matches in a text whose places are found in one fold

KINDS = ("email", "ip", "card", "phone")       # fixed values, in the order of the contract
# The contract's patterns with the same matches. Loops are possessive, which Java runs without recursion, and a run of
# name characters or digits is entered at its start or where the last match ended, so that long runs are read once.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
MARKS = {"email": "@", "phone": "+"}           # a text without the mark has no match
TERM = r"\p{L}[\p{L}\p{N}'-]{2,}+"
TERM_KIND = "term"

Span = "struct<start:int,kind:int,end:int,value:string>"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def passes(kind: str, value: Column) -> Column:
    """The check of one kind on a match."""
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike(
            "^([0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        digits = _digits(value)
        return F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(F.lit(False))
    if kind == "phone":
        return F.length(_digits(value)).between(10, 15)
    return F.lit(True)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, also inside other lambdas."""
    return F.transform(F.array(value), use)[0]


def located(text: Column, pattern: str, matches: Column, wanted: Callable[[Column], Column]) -> Column:
    """(start, end, value) of the ``wanted`` ones of ``matches`` of ``pattern`` in ``text``: the pieces between matches give
    their places. Stretches of matches are folded one by one, so that a long list of places is not copied for each."""
    none = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + x["skip"]
        end = begin + F.length(x["match"])
        place = F.struct(begin.alias("start"), end.alias("end"), x["match"].alias("value"))
        return F.struct(end.alias("at"), F.when(wanted(x["match"]), F.array_append(acc["found"], place)).otherwise(
            acc["found"]).alias("found"))

    def stretches(steps: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), none.alias("found"))
        return F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / STRETCH).cast("int")), lambda i: F.aggregate(
            F.slice(steps, i * STRETCH + 1, F.lit(STRETCH)), start, step))

    def offsets(parts: Column) -> Column:
        start = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("before"))
        return F.aggregate(parts, start, lambda acc, x: F.struct(
            (acc["at"] + x["at"]).alias("at"), F.array_append(acc["before"], acc["at"]).alias("before")), lambda acc: acc["before"])

    def shifted(part: Column, by: Column) -> Column:
        return F.transform(part["found"], lambda f: F.struct(
            (f["start"] + by).alias("start"), (f["end"] + by).alias("end"), f["value"].alias("value")))

    steps = let(matches, lambda found: F.zip_with(F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found)), found,
                                                  lambda p, m: F.struct(F.length(p).alias("skip"), m.alias("match"))))
    return let(steps, lambda every: F.when(F.size(every) > 0, let(stretches(every), lambda parts: F.flatten(
        F.zip_with(parts, offsets(parts), shifted)))).otherwise(none))


def _count(spans: Column, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def with_base(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with ``out``, the base spans sorted by start and kind (NULL for none)."""
    keep = rows.columns
    for kind in KINDS:
        found = F.regexp_extract_all(F.col(text), F.lit(PATTERNS[kind]), F.lit(0))
        rows = rows.withColumn(f"_{kind}", F.when(F.contains(F.col(text), F.lit(MARKS[kind])), found)
                               if kind in MARKS else found)
    none = F.array().cast(f"array<{Span}>")

    def checked(kind: str, number: int) -> Column:
        def good(match: Column) -> Column:
            return passes(kind, match)

        matches = F.col(f"_{kind}")
        spans = F.transform(located(F.col(text), PATTERNS[kind], matches, good), lambda s: F.struct(
            s["start"].alias("start"), F.lit(number).alias("kind"), s["end"].alias("end"), s["value"].alias("value")))
        return F.when(F.coalesce(F.exists(matches, good), F.lit(False)), spans).otherwise(none)

    for i, kind in enumerate(KINDS):
        rows = rows.withColumn(f"_{kind}", checked(kind, i))
    every = F.array_sort(F.concat(*[F.col(f"_{kind}") for kind in KINDS]))
    return rows.select(*keep, F.when(F.size(every) > 0, every).alias(out))


def named(spans: Column) -> Column:
    """kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, (*KINDS, TERM_KIND)))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def blanked(text: Column, spans: Column) -> Column:
    """``text`` with every character of ``spans`` replaced by a space: other places stay as they are."""
    def part(s: Column, i: Column) -> Column:
        at = F.when(i == 0, 0).otherwise(F.array_max(F.slice(spans["end"], F.lit(1), i)))
        return F.concat(F.substring(text, at + 1, F.greatest(F.lit(0), s["start"] - at)),
                        F.repeat(F.lit(" "), F.greatest(F.lit(0), s["end"] - F.greatest(at, s["start"]))))

    return F.concat(F.array_join(F.transform(spans, part), ""),
                    F.substring(text, F.array_max(spans["end"]) + 1, F.length(text)))


def _clean(text: str, base: str) -> Column:
    return F.when(F.col(base).isNull(), F.col(text)).otherwise(blanked(F.col(text), F.col(base)))


def _distinct(values: Column) -> Column:
    return F.array_distinct(F.transform(F.array_distinct(values), F.lower))


def places(text: Column, wanted: Callable[[Column], Column]) -> Column:
    """(start, end, value) of the words of ``text`` whose lower case is ``wanted``."""
    return located(text, TERM, F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), lambda w: wanted(F.lower(w)))


def likely(met: Column, of: Column) -> Column:
    """Lower end of the credible interval of P(e|t), from ``met`` of ``of`` texts."""
    met, of = met.cast("double"), of.cast("double")
    return (met + Z * Z / 2 - Z * F.sqrt(met * (of - met) / of + Z * Z / 4)) / (of + Z * Z)


def disclosing(met: DataFrame, words: DataFrame, n: int) -> DataFrame:
    """(term, hidden): the terms to generalise or remove and the fewest bits that they leave hidden. ``met`` has text_key,
    entities and terms of every different text with base spans, ``words`` one row per different text and term; ``n`` is
    the number of different texts."""
    could = lambda k, of: likely(F.least(k, of), of) >= 2.0 ** -GENERALISE  # noqa: E731  the bound rises with the meetings
    count = F.count(F.lit(1))
    n_t = words.groupBy("term").agg(count.alias("n_t")).where(could(F.col("n_t"), F.col("n_t")))
    n_e = met.select(F.explode("entities").alias("entity")).groupBy("entity").agg(count.alias("n_e"))
    n_e = n_e.where(could(F.col("n_e"), F.col("n_e")))
    held = met.select("text_key", F.explode("entities").alias("entity")).join(n_e, "entity").groupBy("text_key").agg(
        F.collect_list(F.struct("entity", "n_e")).alias("known"), F.max("n_e").alias("most"))
    told = met.join(held, "text_key").select("known", "most", F.explode("terms").alias("term")).join(n_t, "term")
    pairs = told.where(could(F.col("most"), F.col("n_t"))).select("term", "n_t", F.explode("known").alias("e"))
    pairs = pairs.where(could(F.col("e.n_e"), F.col("n_t"))).groupBy("e.entity", "term").agg(
        count.alias("n_te"), F.max("n_t").alias("n_t"), F.max("e.n_e").alias("n_e"))
    hidden = -F.log2(likely(F.col("n_te"), F.col("n_t")))
    scored = pairs.select("term", hidden.alias("hidden"), (F.log2(F.lit(float(max(1, n))) / F.col("n_e")) - hidden).alias("gain"))
    return scored.where((F.col("hidden") <= GENERALISE) & (F.col("gain") >= GAIN)).groupBy("term").agg(F.min("hidden").alias("hidden"))


class Bitmap:
    """A set of 64-bit hashes as one row with a list of words of 64 bits, whose length follows the number of hashes up to
    ``MOST_BITS``: ``of`` joins it to rows that have ``doc``, ``holds`` tells if a hash's bit is set."""

    def __init__(self, hashes: DataFrame, column: str, name: str):
        self.size = min(MOST_BITS, max(LEAST_BITS, 1 << math.ceil(math.log2(max(1, hashes.count() * BITS_PER_HASH)))))
        slots = hashes.select(F.col(column).bitwiseAND(F.lit(self.size - 1)).alias("slot"))
        words = slots.groupBy(F.shiftright("slot", 6).alias("id")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(slot & 63 AS INT))")).alias("word"))
        every = hashes.sparkSession.range(self.size // 64).join(words, "id", "left")
        each = F.struct("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
        whole = every.agg(F.transform(F.array_sort(F.collect_list(each)), lambda x: x["word"]).alias("bits"))
        self.row = materialise(whole.withColumn("every", F.lit(0).cast("long")), name)

    def of(self, rows: DataFrame) -> DataFrame:
        return rows.join(F.broadcast(self.row), F.col("doc") % 1 == F.col("every"))        # a key that every row has

    def holds(self, value: Column) -> Column:
        word = F.get(F.col("bits"), F.shiftright(value.bitwiseAND(F.lit(self.size - 1)), 6).cast("int"))
        return F.getbit(word, value.bitwiseAND(F.lit(63)).cast("int")) == 1


def different_texts(rows: DataFrame) -> tuple[DataFrame, int]:
    """(text_key, t, base) of one row of each different text, and their number. Only texts that may have copies, by a
    bitmap of the keys that occur more than once, are exchanged."""
    known = rows.where("t IS NOT NULL").select("text_key", "doc", "t", "base")
    keys = materialise(known.groupBy("text_key").agg(F.count(F.lit(1)).alias("n"), F.min("doc").alias("first")), "pii-texts")
    copied = keys.where("n > 1").select("text_key", "first")
    bitmap = Bitmap(copied, "text_key", "pii-copied")
    marked, shared = bitmap.of(known), bitmap.holds(F.col("text_key"))
    found = marked.where(shared).drop("bits", "every").join(copied, "text_key", "left").where("first IS NULL OR first = doc")
    return marked.where(~shared).select("text_key", "t", "base").union(found.select("text_key", "t", "base")), keys.count()


def likely_places(rows: DataFrame, telling: DataFrame) -> DataFrame:
    """(doc, start, end, term) of the words of ``rows`` (doc, t, base) whose bit is set in a bitmap of the terms."""
    bitmap = Bitmap(telling.select(F.xxhash64("term").alias("hash")), "hash", "pii-bits")

    def wanted(word: Column) -> Column:
        return bitmap.holds(F.xxhash64(word))

    clean = _clean("t", "base")
    some = F.exists(F.regexp_extract_all(clean, F.lit(TERM), F.lit(0)), lambda w: wanted(F.lower(w)))
    found = bitmap.of(rows).select("doc", F.when(some, let(clean, lambda c: places(c, wanted))).alias("likely"))
    return found.select("doc", F.explode_outer("likely").alias("w")).select(
        "doc", "w.start", "w.end", F.lower("w.value").alias("term")).where("term IS NOT NULL")


def find_personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``rest`` (its columns but the text), ``id``, ``t`` (the text), ``base`` spans and
    ``terms``, the disclosing terms as (start, kind, end, value) with value ``generalise`` or ``remove``; both spans NULL
    for none."""
    prepare(docs.sparkSession)
    rest = F.struct(*[c for c in docs.columns if c != text_col])
    texts = docs.select(rest.alias("rest"), F.col(id_col).alias("id"), F.col(text_col).alias("t"))
    rows = with_base(texts, "t", "base").withColumn("text_key", F.xxhash64("t")).withColumn("doc", F.monotonically_increasing_id())
    rows = materialise(rows, "pii-base")
    single, n = different_texts(rows)
    terms = _distinct(F.regexp_extract_all(_clean("t", "base"), F.lit(TERM), F.lit(0)))
    met = materialise(single.where("base IS NOT NULL").select(
        "text_key", _distinct(F.col("base")["value"]).alias("entities"), terms.alias("terms")), "pii-met")
    # an outer explode: for an inner one Spark adds a filter, for which the words are looked for twice
    words = single.select(F.explode_outer(terms).alias("term"))
    telling = materialise(disclosing(met, words, n), "pii-telling")
    found = likely_places(rows.select("doc", "t", "base"), telling).join(telling, "term")
    action = F.when(F.col("hidden") <= REMOVE, F.lit("remove")).otherwise(F.lit("generalise"))
    spans = materialise(found.groupBy("doc").agg(F.array_sort(F.collect_list(F.struct(
        "start", F.lit(len(KINDS)).alias("kind"), "end", action.alias("value")))).alias("terms")), "pii-spans")
    return rows.join(spans, "doc", "left").select("rest", "id", "t", "base", "terms")


def pii_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, counts per kind, digest of the base spans, all spans."""
    found = find_personal_data(docs, id_col, text_col)
    none = F.array().cast(f"array<{Span}>")
    base, terms = F.coalesce("base", none), F.coalesce("terms", none)
    counts = [_count(base, i).alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select(F.col("id").alias(id_col), *counts, F.sha2(named(base), 256).alias("base_sha256"),
                        named(F.array_sort(F.concat(base, terms))).alias("spans"))


def sanitised(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced: base kinds by their name in brackets, terms by [TERM] or nothing."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in (*KINDS, TERM_KIND)])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        instead = F.when(s["value"] == "remove", F.lit("")).otherwise(F.element_at(names, s["kind"] + 1))
        between = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(
            s["start"] >= acc["at"], F.concat(acc["out"], between, instead)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(spans, start, step, lambda acc: F.concat(
        acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))


def sanitise_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       length_col: str | None = "n_chars") -> DataFrame:
    """``docs`` with personal data replaced in ``text_col`` and ``length_col``, where there is one, brought up to date."""
    none = F.array().cast(f"array<{Span}>")
    spans = F.array_sort(F.concat(F.coalesce("base", none), F.coalesce("terms", none)))
    touched = F.col("base").isNotNull() | F.col("terms").isNotNull()
    rows = find_personal_data(docs, id_col, text_col).select("rest", touched.alias("touched"), F.when(
        touched, let(spans, lambda s: sanitised(F.col("t"), s))).otherwise(F.col("t")).alias("new"))
    columns = {c: (F.col("new") if c == text_col else F.col("rest")[c]).alias(c) for c in docs.columns}
    if length_col in columns:
        kind = dict(docs.dtypes)[length_col]
        columns[length_col] = F.when(F.col("touched"), F.length("new").cast(kind)).otherwise(
            F.col("rest")[length_col]).alias(length_col)
    return rows.select(*columns.values())
