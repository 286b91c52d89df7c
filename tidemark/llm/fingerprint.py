"""Order MinHash fingerprints, with DataFrame functions only.

A text's k-mers are two neighbouring words each (words are cut after 16 characters, which also serves scripts
without blanks); a single word is a k-mer of its own. It is one kind of k-mer for texts of any length. Equal k-mers are numbered by
occurrence, so repeats count. Hashes of (k-mer, occurrence) fall into ``TUPLES * WIDTH`` ranges; the least of
each range is selected, the ``WIDTH`` selected ones of a tuple are put back into text order, and the
tuple is hashed with its number. Two fingerprints agree in a tuple if the same k-mers were selected
in the same order, so moving text about counts as a change. Likeness is the share of agreeing
tuples among those that either text fills.

Everything about one text happens inside its row: no explode and no shuffle. 64-bit words hold hash, range and
place together, so that sorting is sorting of numbers. Comparing with the next document takes one
shuffle of the texts by id range; a copy of each range's first row closes the range before it.

Cases: a NULL text is an empty one; two empty texts are alike (1.0), an empty and a filled one are not; a NULL id
sorts below all others; rows that repeat an id follow one another, by text. A single document is
its own next one. Ids are integers. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TUPLES, WIDTH = 64, 2
#: Bits of a k-mer's place in the text. Places from 2**24 on (texts of some 100 MB) count as one, so that there the order of
#: hashes stands in for the order of the text, in equal texts alike.
_PLACE = 24
_RANGE = 7  # bits of TUPLES * WIDTH
#: Text bytes of one id range.
RANGE_BYTES = 16 << 20


def _stages(text: str, out: str) -> list[dict[str, Column]]:
    """Columns to add one after another; each list is referred to by name so that it is made once."""
    w, h, p, q, m = (f"__{out}_{x}" for x in "whpqm")
    low = F.lit((1 << _PLACE) - 1)
    high = F.lit(((1 << 63) - 1) ^ ((1 << _PLACE) - 1))
    pieces = F.regexp_extract_all(text, F.lit(r"(\S{1,16})"), F.lit(1))
    follow = F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0)))
    hashed = F.zip_with(w, follow, lambda a, b: F.xxhash64(a, b))
    hashed = F.when(F.size(w) > 1, F.slice(hashed, F.lit(1), F.size(w) - 1)).otherwise(hashed)
    placed = F.sort_array(F.transform(h, lambda x, i: x.bitwiseAND(high).bitwiseOR(F.least(i, low))))

    def same(i, x):  # the entry at i holds the same k-mer as x
        return F.shiftright(F.get(p, i), _PLACE) == F.shiftright(x, _PLACE)

    def occurrence(x, i):
        """Equal k-mers lie side by side; how many precede is found by halving."""
        steps = F.array(*[F.lit(1 << b) for b in range(_PLACE - 1, -1, -1)])
        count = F.aggregate(steps, F.lit(0), lambda o, d: F.when((i >= o + d) & same(i - o - d, x), o + d).otherwise(o))
        return F.when((i == 0) | ~same(i - 1, x), F.lit(0)).otherwise(count)

    numbered = F.sort_array(
        F.transform(p, lambda x, i: F.xxhash64(F.shiftright(x, _PLACE), occurrence(x, i)).bitwiseAND(high).bitwiseOR(x.bitwiseAND(low)))
    )
    least = F.filter(q, lambda x, i: (i == 0) | (F.shiftright(F.get(q, i - 1), 63 - _RANGE) != F.shiftright(x, 63 - _RANGE)))

    def tuple_hash(x, i):
        other = F.get(m, i + 1)
        number = F.shiftright(x, 64 - _RANGE)
        first, second = F.shiftright(x, _PLACE), F.shiftright(other, _PLACE)
        paired = other.isNotNull() & (F.shiftright(other, 64 - _RANGE) == number)
        ordered = (
            F.when(~paired, F.xxhash64(first))
            .when(x.bitwiseAND(low) <= other.bitwiseAND(low), F.xxhash64(first, second))
            .otherwise(F.xxhash64(second, first))
        )
        return F.shiftleft(number, 24).bitwiseOR(ordered.bitwiseAND(F.lit(0xFFFFFF)))

    heads = F.filter(
        F.transform(m, lambda x, i: F.when(
            (i > 0) & (F.shiftright(F.get(m, i - 1), 64 - _RANGE) == F.shiftright(x, 64 - _RANGE)), F.lit(None).cast("long")
        ).otherwise(tuple_hash(x, i))),
        lambda x: x.isNotNull(),
    )
    return [{w: pieces}, {h: hashed}, {p: placed}, {q: numbered}, {m: least}, {out: heads}]


def with_fingerprints(df: DataFrame, texts: dict[str, str]) -> DataFrame:
    """``df`` with an array of tuple hashes for each text column: ``{new column: text column}``. Texts must not be NULL."""
    for columns in zip(*[_stages(text, out) for out, text in texts.items()], strict=True):
        df = df.withColumns({k: v for c in columns for k, v in c.items()})
    return df.drop(*[f"__{out}_{x}" for out in texts for x in "whpqm"])


def likeness(a: str, b: str) -> Column:
    """Share of agreeing tuples; 1 for two empty texts."""
    number = lambda c: F.transform(c, lambda x: F.shiftright(x, 24))
    filled = F.size(F.array_union(number(a), number(b)))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def as_text(a: str) -> Column:
    return F.array_join(F.transform(a, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def id_ranges(docs: DataFrame, range_bytes: int) -> Column:
    """A number for each row that grows with doc_id, for ranges of about equal text."""
    total, lo = docs.agg(F.sum(F.octet_length("text")), F.min("doc_id")).first()
    if lo is None:
        return F.lit(-1).cast("long")
    ranges = max(1, -(-(total or 0) // range_bytes))
    coarse = min(ranges, 128)
    fine = -(-ranges // coarse)
    cuts = docs.agg(F.percentile_approx("doc_id", [k / coarse for k in range(coarse + 1)], 10_000)).first()[0]
    borders = F.array(*[F.lit(c).cast("long") for c in cuts[1:-1]]) if coarse > 1 else F.array().cast("array<long>")
    at = F.size(F.filter(borders, lambda c: F.col("doc_id") > c))
    ends = F.array(*[F.lit(c).cast("double") for c in cuts])
    share = (F.col("doc_id") - F.get(ends, at)) / F.greatest(F.get(ends, at + 1) - F.get(ends, at), F.lit(1.0))
    inner = F.greatest(F.least(F.floor(share * fine), F.lit(fine - 1)), F.lit(0))
    return F.coalesce(at * F.lit(fine).cast("long") + inner, F.lit(-1).cast("long"))


def compared(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last third is the next document's start."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("__range", id_ranges(rows, range_bytes))
    # The first row of each range, in descending order, once more at the end of the range before.
    tops = rows.groupBy("__range").agg(F.max("doc_id").alias("__top"))
    by_range = Window.orderBy("__range")
    tops = tops.withColumn("__to", F.coalesce(F.lead("__range").over(by_range), F.min("__range").over(by_range)))
    first = (
        rows.join(tops, (rows["__range"] == tops["__range"]) & rows["doc_id"].eqNullSafe(tops["__top"]))
        .groupBy("__to", "__top").agg(F.max("text").alias("text"))
        .select(F.col("__top").alias("doc_id"), "text", F.col("__to").alias("__range"), F.lit(1).alias("__copy"))
    )
    order = Window.partitionBy("__range").orderBy("__copy", F.col("doc_id").desc_nulls_last(), F.col("text").desc())
    both = rows.withColumn("__copy", F.lit(0)).unionByName(first).withColumn("__next", F.coalesce(F.lead("text").over(order), F.lit("")))
    keep = F.length("text") - F.floor(F.length("text") / 3).cast("int")
    both = both.withColumns({
        "n_chars": F.length("text").cast("long"),
        "__edited": F.concat(F.substring("text", F.lit(1), keep), F.substring("__next", F.lit(1), F.length("text") - keep)),
    })
    both = with_fingerprints(both, {"__own": "text", "__changed": "__edited"})
    both = both.withColumn("__following", F.lead("__own").over(order)).where("__copy = 0")
    return both.select(
        "doc_id", "n_chars", F.sha2("__edited", 256).alias("edited_sha256"),
        as_text("__own").alias("fingerprint"), as_text("__changed").alias("edited_fingerprint"),
        likeness("__own", "__changed").alias("near_edited"), likeness("__own", "__following").alias("near_next"),
    )
