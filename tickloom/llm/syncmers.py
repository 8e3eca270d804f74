"""Document fingerprints from closed syncmers, in DataFrame expressions only.

A k-mer of tokens is chosen when the least of its inner pairs stands at its first or last place.
That depends on the k-mer alone, so an edit changes only the choices that touch it.  The chosen
k-mers of least hash, with their positions, are the fingerprint; two fingerprints are alike by the
share of anchors that meet at one common displacement.  Tokens are words; short texts use code
points, as do texts of any length without enough words, and texts of middle length carry both, so a
text that an edit makes shorter still compares.  A short text's word anchors are kept beside for
comparing it with a long one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sources.writers import stored

#: Tokens of a k-mer; its inner pairs number one less.
K = 6
#: Anchors of a fingerprint: those of least hash over the whole text.
ANCHORS = 64
#: Texts from WORDS_FROM code points have word anchors, texts under CHARS_TO code point anchors.
WORDS_FROM, CHARS_TO = 400, 800
#: Tokens by which two anchors may be off their common displacement.
SLACK = 64
#: Code points for each word from which a text is not taken as words only.
LONG_WORDS = 40
#: Documents between two bounds of the order by id, and the most bounds.
BUCKET_ROWS, MOST_BUCKETS = 1_000, 4_096
#: A range of more rows than so many ranges should hold is cut again, by ids and first code points.
HOT_BUCKET, HEAD_CHARS = 4, 64
_BITS = 31


def _bound(value: Column, f) -> Column:
    """``f`` of a value that is computed once."""
    return F.transform(F.array(value), f)[0]


def _chosen(pairs: Column) -> Column:
    last = K - 2

    def edge(i: Column) -> Column:
        at = [F.get(pairs, i + j if j else i) for j in range(K - 1)]
        return F.least(at[0], at[last]) <= F.least(*at[1:last])

    return F.filter(F.sequence(F.lit(0), F.size(pairs) - (K - 1)), edge)


def _anchors(tokens: Column) -> Column:
    """Sorted ``hash << 31 | position`` of the chosen k-mers of least hash; empty if there are none."""

    def of_pairs(pairs: Column) -> Column:
        def cell(i: Column) -> Column:
            parts = [F.get(pairs, i + j if j else i) for j in range(0, K - 1, 2)]
            return F.shiftleft(F.shiftrightunsigned(F.xxhash64(*parts), 64 - _BITS), _BITS).bitwiseOR(i.cast("long"))

        def distinct(cells: Column) -> Column:
            fresh = lambda x, j: (j == 0) | (F.shiftright(x, _BITS) != F.shiftright(F.get(cells, j - 1), _BITS))
            return F.slice(F.filter(cells, fresh), 1, ANCHORS)

        return _bound(F.sort_array(F.transform(_chosen(pairs), cell)), distinct)

    def of_hashes(hashes: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(hashes) - 2), lambda i: F.xxhash64(F.get(hashes, i), F.get(hashes, i + 1)))
        return F.when(F.size(hashes) >= K, _bound(pairs, of_pairs)).otherwise(F.array().cast("array<long>"))

    return _bound(F.transform(tokens, lambda w: F.xxhash64(w)), of_hashes)


def anchors(text: Column) -> Column:
    """``words``, ``chars``, ``terms``: the anchors of a text by unit, null where the unit is not used.

    A unit without a chosen k-mer has one anchor, the whole text; ``by_words`` and ``by_chars`` tell
    whether it has real ones.  ``terms`` are the real word anchors of a text too short for ``words``.
    """

    def whole(cells: Column) -> Column:
        one = F.shiftleft(F.shiftrightunsigned(F.xxhash64(text), 64 - _BITS), _BITS)
        return F.when(F.size(cells) > 0, cells).otherwise(F.array(one))

    n = F.length(text)

    def units(tokens: Column) -> Column:
        def of_words(own: Column) -> Column:
            wordless = (F.size(own) == 0) | (n > F.size(tokens) * LONG_WORDS)
            chars = F.when((n < CHARS_TO) | wordless, _anchors(F.split(text, "")))

            def of_chars(points: Column) -> Column:
                return F.struct(
                    F.when(n >= WORDS_FROM, whole(own)).alias("words"),
                    F.when(points.isNotNull(), whole(points)).alias("chars"),
                    F.when((n < WORDS_FROM) & (F.size(own) > 0), own).alias("terms"),
                    (F.size(own) > 0).alias("by_words"),
                    F.coalesce(F.size(points) > 0, F.lit(False)).alias("by_chars"),
                )

            return _bound(chars, of_chars)

        return _bound(_anchors(tokens), of_words)

    return _bound(F.split(text, "\\s+"), units)


def fingerprint(found: Column) -> Column:
    """Text of ``anchors``: unit, then hash and position of each anchor in hexadecimal."""

    def unit(mark: str, cells: Column) -> Column:
        return F.concat(F.lit(mark), F.array_join(F.transform(cells, lambda x: F.lower(F.hex(x))), "."))

    return F.concat_ws("|", unit("w", F.coalesce(found["words"], found["terms"])), unit("c", found["chars"]))


def _alike(one: Column, other: Column) -> Column:
    key = lambda x: F.shiftright(x, _BITS)
    place = lambda x: x.bitwiseAND((1 << _BITS) - 1)

    def common(a: Column, b: Column) -> Column:
        """Displacements of the anchors in both, sorted."""
        heads = lambda x: F.transform(x, key)
        shift = lambda x, y: F.transform(
            F.array_intersect(x, y), lambda h: place(F.get(b, F.array_position(y, h).cast("int") - 1)) - place(F.get(a, F.array_position(x, h).cast("int") - 1))
        )
        return F.sort_array(_bound(heads(a), lambda x: _bound(heads(b), lambda y: shift(x, y))))

    def within(a: Column, b: Column) -> Column:
        met = lambda d: F.size(F.filter(d, lambda x: F.abs(x - F.get(d, F.floor(F.size(d) / 2).cast("int"))) <= SLACK))
        return _bound(common(a, b), met) * 2.0 / (F.size(a) + F.size(b))

    def cut(a: Column, b: Column) -> Column:
        top = lambda x: F.when(F.size(x) >= ANCHORS, key(F.get(x, F.lit(ANCHORS - 1)))).otherwise(F.lit(1 << _BITS))
        both = lambda t: _bound(F.filter(a, lambda x: key(x) <= t), lambda p: _bound(F.filter(b, lambda x: key(x) <= t), lambda q: within(p, q)))
        return _bound(F.least(top(a), top(b)), both)

    return _bound(one, lambda a: _bound(other, lambda b: cut(a, b)))


def likeness(one: Column, other: Column) -> Column:
    """0 to 1: anchors that meet, out of all whose hash both fingerprints could hold.

    They are compared in a unit in which both have real anchors: words, else code points, else words
    of which one text has few.  Without one, texts are alike when they are equal.
    """

    def by(unit: str, real: str) -> Column:
        return F.when(one[unit].isNotNull() & other[unit].isNotNull() & one[real] & other[real], _alike(one[unit], other[unit]))

    either = lambda x: F.coalesce(x["words"], x["terms"])
    mixed = F.when(one["by_words"] & other["by_words"], _alike(either(one), either(other)))
    equal = F.when((one["words"] == other["words"]) | (one["chars"] == other["chars"]), F.lit(1.0))
    return F.coalesce(by("words", "by_words"), by("chars", "by_chars"), mixed, equal, F.lit(0.0))


def with_next(docs: DataFrame, view: Callable[[Column], Column]) -> DataFrame:
    """Each row of ``doc_id, text`` with ``own`` and ``next``: the view of its text and of the next row's.

    Rows follow one another by id, which must be numeric, null ids first, then by text; the last
    row's next is the first.  Rows are dealt to ranges of the id by approximate quantiles, so no window
    holds the whole order; the first row of each range follows the last of the range before it, and
    only the views of these first texts are computed twice.  A range that holds several ranges' rows
    (one id or no id on many of them) is cut again, at about every ``n``-th of its distinct rows, and
    rows equal in both, which follow one another, take part once.
    """
    n = docs.count()
    parts = min(MOST_BUCKETS, n // BUCKET_ROWS)
    bounds = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)])).first()[0] if parts > 1 else None
    if bounds:
        edges = F.array(*(F.lit(x) for x in sorted(set(bounds))))
        bucket = F.coalesce(F.size(F.filter(edges, lambda b: b < F.col("doc_id"))), F.lit(0))
    else:
        bucket = F.lit(0)
    docs = docs.withColumns({"_bucket": bucket, "_sub": F.lit(0)})
    each = max(1, n // max(1, parts))
    # One number for each range at most.
    hot = [r["_bucket"] for r in docs.groupBy("_bucket").count().where(F.col("count") > HOT_BUCKET * each).collect()]
    full = docs.where(F.col("_bucket").isin(hot))
    docs = docs.where(~F.col("_bucket").isin(hot)) if hot else docs

    order = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"))
    least = docs.groupBy("_bucket").agg(F.min(order).alias("_least"))
    at_head = docs.join(F.broadcast(least), "_bucket").where(F.col("doc_id").eqNullSafe(F.col("_least.id")))
    heads = at_head.groupBy("_bucket", "_sub").agg(F.min("text").alias("_text"))
    if hot:
        full = _cut_again(full, each)
        first = full.groupBy("_bucket", "_sub").agg(F.min(F.struct(order, "text")).alias("_least"))
        heads = heads.unionByName(first.select("_bucket", "_sub", F.col("_least.text").alias("_text")))
        docs = docs.unionByName(full.drop("_copies"))
    ring = Window.orderBy("_bucket", "_sub")  # a row for each range
    ends = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = heads.withColumn("_after", F.coalesce(F.lead("_text").over(ring), F.first("_text").over(ends)))
    heads = heads.select("_bucket", "_sub", view(F.col("_after")).alias("_after"))
    inside = Window.partitionBy("_bucket", "_sub").orderBy("doc_id", "text")
    rows = docs.withColumn("own", view(F.col("text")))
    rows = rows.withColumn("_next", F.lead("own").over(inside))
    rows = rows.join(heads, ["_bucket", "_sub"], "left").withColumn("next", F.coalesce("_next", "_after"))
    rows = rows.select("doc_id", "text", "own", "next")
    return rows.unionByName(_repeats(full, view, each)) if hot else rows


def _cut_again(rows: DataFrame, each: int) -> DataFrame:
    """Distinct rows of overfull ranges with ``_copies``, and ``_sub`` by places in their order."""
    rows = rows.groupBy("_bucket", "doc_id", "text").agg(F.count(F.lit(1)).alias("_copies"))
    rows = stored(rows, "syncmers-overfull")
    # Texts that begin alike stay together, so their first code points do.
    place = F.struct(F.col("doc_id").isNotNull().alias("known"), F.col("doc_id").alias("id"), F.substring("text", 1, HEAD_CHARS).alias("head"))
    picked = rows.where(F.pmod(F.xxhash64("doc_id", "text"), F.lit(each)) == 0)
    cuts = picked.groupBy("_bucket").agg(F.collect_set(place).alias("_cuts"))
    below = F.filter(F.coalesce("_cuts", F.array()), lambda c: c <= place)
    return rows.join(cuts, "_bucket", "left").withColumn("_sub", F.size(below)).drop("_cuts")


def _repeats(rows: DataFrame, view: Callable[[Column], Column], each: int) -> DataFrame:
    """All copies but one of repeated rows, dealt out in runs of ``each``; their next is their like."""
    more = F.col("_copies") - 1
    runs = rows.where(more > 0).select("doc_id", "text", more.alias("_more"), F.explode(F.sequence(F.lit(0), F.expr(f"cast((_copies - 2) div {each} as int)"))).alias("_run"))
    runs = runs.repartition("doc_id", "_run")
    some = F.least(F.lit(each).cast("long"), F.col("_more") - F.col("_run") * each)
    own = view(F.col("text"))
    out = runs.select("doc_id", "text", F.explode(F.sequence(F.lit(1).cast("long"), some)).alias("_no")).drop("_no")
    return out.select("doc_id", "text", own.alias("own"), own.alias("next"))


def compare_edits(documents: DataFrame) -> DataFrame:
    """Fingerprints of each text, of an edit of it, and their likeness; a row for each input row.

    The edit replaces the last quarter of the code points by the first as many of the next
    document in id order.  A null text is empty; rows of one id follow one another by text; null
    ids come first.  Other columns are not read.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = documents.select("doc_id", text.alias("text"))
    docs = with_next(docs, lambda x: F.struct(x.alias("text"), anchors(x).alias("found")))
    quarter = F.expr("cast(length(text) div 4 as int)")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - quarter), F.substring(F.col("next.text"), F.lit(1), quarter))
    docs = docs.select("doc_id", F.length("text").cast("long").alias("n_chars"), edited.alias("edited"), F.col("own.found").alias("found"), F.col("next.found").alias("next_found"))
    docs = docs.withColumn("edited_found", anchors(F.col("edited")))
    return docs.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint(F.col("found")).alias("fingerprint"),
        fingerprint(F.col("edited_found")).alias("edited_fingerprint"),
        likeness(F.col("found"), F.col("edited_found")).alias("near_edited"),
        likeness(F.col("found"), F.col("next_found")).alias("near_next"),
    )
