"""Order MinHash fingerprints: sensitive to edit distance, not only to shared parts.

A text is a row of symbols: words of at most SYMBOL code points, pieces of longer words and
runs, and single code points of scripts that are written without spaces.  Where a long run is cut
depends on the code points there, not on the distance from its beginning, so that an edit changes
only the symbols around it.
Its k-mers, numbered by occurrence (the second time a k-mer comes it is another
item), are hashed, and the hash deals each to one of TUPLES x SIZE slots; the least hash of
a slot is selected.  The SIZE selected k-mers of a tuple are put back into their text
order and hashed together.  Texts that share k-mers in another order thus differ.
The likeness of two fingerprints is the share of equal tuples, out of those that
either has.

All in Spark's own functions.  The text is shuffled once, by a bucket of
neighbouring ids; every later step groups within the bucket, so it needs no
further exchange.  Buckets are cut by quantiles of the ids and sized by the text's
bytes; the first document of each is also sent to the bucket that it follows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SYMBOL, K, TUPLES, SIZE = 8, 3, 32, 2
BUCKET_BYTES = 4_000_000
#: Also bounds the one broadcast, of a row of two numbers per bucket.
MAX_BUCKETS = 1 << 17
_CUTS = 64

#: Scripts written without spaces (Thai to Burmese, Khmer, Chinese, Japanese and Yi with their signs and wide forms).
_SINGLE = r"\x{0E00}-\x{109F}\x{1780}-\x{17FF}\x{2E80}-\x{A4CF}\x{F900}-\x{FAFF}\x{FF00}-\x{FFEF}\x{1B000}-\x{1B16F}\x{20000}-\x{3FFFF}"
_OTHER = rf"[^\s{_SINGLE}]"
#: Long runs are cut behind these (every eighth code point of ASCII).
_CUT = r"[%\-5=EMU\]emu}]"
_SYMBOLS = "|".join((
    rf"[{_SINGLE}]",
    rf"(?<!{_OTHER}){_OTHER}{{1,{SYMBOL}}}+(?!{_OTHER})",  # a whole word
    rf"{_OTHER}{{3,31}}?{_CUT}",  # of a longer one: up to a cut
    rf"{_OTHER}{{1,32}}+(?!{_OTHER})",  # its end
    rf"({_OTHER})\1{{31}}",  # far from a cut: one code point again and again
    _OTHER))


def _bucket(docs: DataFrame) -> tuple[Column, int]:
    """A number that grows with ``doc_id``, and how many there are at most."""
    at = [i / _CUTS for i in range(_CUTS + 1)]
    cuts, size = docs.agg(F.percentile_approx("doc_id", at, 10_000), F.sum(F.octet_length("text"))).first()
    if cuts is None:
        return F.lit(0).cast("long"), 1
    low, high = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    cuts = sorted({low, *cuts, high})
    parts = min(MAX_BUCKETS, -(-int(size or 0) // BUCKET_BYTES))
    each = max(1, -(-parts // max(1, len(cuts) - 1)))
    number = F.lit(0).cast("long")
    for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
        width = max(1, -(-(b - a) // each))
        if b - a < 1 << 63:
            inside = F.call_function("div", F.col("doc_id") - F.lit(a), F.lit(width))
        else:  # the difference of two ids does not fit a long
            wide = F.col("doc_id").cast("decimal(20,0)") - F.lit(Decimal(a))
            inside = F.call_function("div", wide, F.lit(Decimal(width))).cast("long")
        number = F.when(F.col("doc_id") >= a, F.lit(i * each).cast("long") + F.least(inside, F.lit(each - 1))).otherwise(number)
    return number, each * max(1, len(cuts) - 1)


def _ordered(docs: DataFrame) -> DataFrame:
    """``bucket, rn, guest, doc_id, text, next`` - rows of a bucket in descending id, with the next row's text.

    A guest is the first row of the bucket below (after the lowest: of the highest).
    """
    bucket, parts = _bucket(docs)
    placed = docs.withColumn("bucket", bucket)
    first = placed.groupBy("bucket").agg(F.max("doc_id").alias("doc_id"))
    line = Window.orderBy("bucket")  # a row per bucket, MAX_BUCKETS at most
    above = F.coalesce(F.lead("bucket").over(line), F.min("bucket").over(line.rowsBetween(Window.unboundedPreceding,
                                                                                         Window.unboundedFollowing)))
    guests = first.select("doc_id", above.alias("above"))
    sent = placed.join(F.broadcast(guests), "doc_id", "left").select(
        "doc_id", "text", F.explode(F.when(F.col("above").isNull(), F.array(F.struct("bucket", F.lit(False).alias("guest")))).otherwise(
            F.array(F.struct("bucket", F.lit(False).alias("guest")), F.struct(F.col("above").alias("bucket"), F.lit(True).alias("guest"))))).alias("to")) \
        .select("doc_id", "text", "to.bucket", "to.guest").repartition(max(1, parts), "bucket")
    own = Window.partitionBy("bucket").orderBy("guest", F.desc("doc_id"), "text")
    return sent.select("bucket", F.row_number().over(own).alias("rn"), "guest", "doc_id", "text", F.lead("text").over(own).alias("next"))


def _kmers(body: Column, k: int) -> Column:
    symbols = F.regexp_extract_all(body, F.lit(_SYMBOLS), F.lit(0))
    return F.explode(F.array(symbols)), F.arrays_zip(*(
        F.col("symbols") if i == 0 else F.slice("symbols", F.lit(i + 1), F.greatest(F.size("symbols"), F.lit(1))) for i in range(k)))


def order_minhash(docs: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text has the last third of the code points (rounded down) replaced by as
    many from the beginning of the next document (or all it has), in descending
    order of id; the last is followed by the first.  A fingerprint lists its
    tuples as ``number:hash``; texts without a symbol have an empty one.

    Defined cases: a null text counts as empty; two empty fingerprints have the
    likeness 1, an empty and another one 0; a single document is its own next;
    rows that repeat an id come in the order of their texts; rows without an id
    have no place in the order and are left out; an empty table gives no rows;
    other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")) \
        .filter("doc_id is not null")
    n = F.length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - third), F.substring(F.coalesce("next", F.lit("")), F.lit(1), third))
    rows = _ordered(docs).select("bucket", "rn", "guest", "doc_id", "text", n.alias("n"), F.explode(F.array(edited)).alias("edited"))
    said = F.concat_ws("|", "doc_id", "n", "guest", F.sha2("edited", 256))
    none = F.lit(None).cast("string")
    bodies = rows.select("bucket", F.explode(F.array(
        F.struct((F.col("rn") * 4).cast("long").alias("id"), F.col("text").alias("body"), none.alias("said")),
        F.struct((F.col("rn") * 4 + 1).cast("long").alias("id"),
                 F.when(~F.col("guest"), F.col("edited")).alias("body"), none.alias("said")),
        F.struct((F.col("rn") * 4 + 2).cast("long").alias("id"), none.alias("body"), said.alias("said")))).alias("x")) \
        .select("bucket", "x.id", "x.body", "x.said")
    symbols, zipped = _kmers(F.col("body"), k)
    items = bodies.select("bucket", "id", "said", symbols.alias("symbols")) \
        .select("bucket", "id", "said", F.posexplode_outer(zipped).alias("pos", "kmer")) \
        .select("bucket", "id", "said", "pos", F.when(F.col("pos").isNotNull(), F.xxhash64("kmer")).alias("kmer"))
    again = F.row_number().over(Window.partitionBy("bucket", "id", "kmer").orderBy("pos"))
    hashed = items.select("bucket", "id", "said", "pos", F.when(F.col("pos").isNotNull(), F.xxhash64("kmer", again)).alias("h"))
    slot = F.pmod(F.col("h"), F.lit(TUPLES * SIZE))
    rank = F.shiftleft(F.shiftrightunsigned(F.col("h"), 33), 32).bitwiseOR(F.col("pos").cast("long"))
    held = hashed.select("bucket", "id", "said", F.floor(slot / SIZE).cast("int").alias("tuple"), F.pmod(slot, F.lit(SIZE)).alias("of"),
                         rank.alias("rank")).groupBy("bucket", "id", "said", "tuple").agg(
        *(F.min(F.when(F.col("of") == i, F.col("rank"))).alias(f"r{i}") for i in range(SIZE)))
    place = [F.coalesce(F.col(f"r{i}").bitwiseAND(F.lit(0xFFFFFFFF)), F.lit(1 << 40)) for i in range(SIZE)]
    chosen = [F.shiftright(F.col(f"r{i}"), 32) for i in range(SIZE)]
    ordered = F.when(place[0] <= place[1], F.xxhash64(F.lit(0), chosen[0], F.lit(1), chosen[1])) \
        .otherwise(F.xxhash64(F.lit(1), chosen[1], F.lit(0), chosen[0]))
    tuples = held.select("bucket", F.floor(F.col("id") / 4).alias("rn"), F.pmod("id", F.lit(4)).alias("which"), "said", "tuple",
                         ordered.alias("hash"))
    word = F.concat_ws(":", F.lpad(F.col("tuple").cast("string"), 2, "0"), F.lower(F.hex("hash")))
    listed = tuples.groupBy("bucket", "rn").agg(
        F.max("said").alias("said"),
        *(F.collect_list(F.when((F.col("which") == i) & F.col("tuple").isNotNull(), word)).alias(f) for i, f in enumerate(("own", "edited"))))
    sorted_ = listed.select("bucket", "rn", F.split("said", r"\|").alias("said"), F.array_sort("own").alias("own"),
                            F.array_sort("edited").alias("edited"))
    final = sorted_.withColumn("next", F.lead("own").over(Window.partitionBy("bucket").orderBy("rn"))).filter(F.col("said")[2] == "false")

    def likeness(a: str, b: str) -> Column:
        same = F.size(F.array_intersect(a, b))
        either = F.size(F.array_union(F.transform(a, lambda x: F.substring(x, 1, 2)), F.transform(b, lambda x: F.substring(x, 1, 2))))
        return F.when(either == 0, F.lit(1.0)).otherwise(same / either)

    return final.select(
        F.col("said")[0].cast("long").alias("doc_id"), F.col("said")[1].cast("long").alias("n_chars"), F.col("said")[3].alias("edited_sha256"),
        F.array_join("own", " ").alias("fingerprint"), F.array_join("edited", " ").alias("edited_fingerprint"),
        likeness("own", "edited").alias("near_edited"), likeness("own", F.coalesce("next", F.array().cast("array<string>"))).alias("near_next"))
