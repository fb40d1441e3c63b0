"""Personal data: fixed patterns, and identifiers of no fixed shape learned from the words around known ones.

The fixed patterns' matches are the seeds.  The words before and behind them induce
lexical patterns; these also fill their slot with other identifier-like strings
(candidates).  Patterns and what fills them are a two-sided graph that is scored in
ROUNDS rounds: a pattern by the share of its fillers that are known identifiers of
one kind, a filler by the patterns of CONFIDENCE or more that it fills.  Candidates
that reach CONFIDENCE are found, wherever they occur.  A filler counts once per
pattern, so copies of a text add no weight.

All of it is Spark's own functions.  Texts are scanned once and never shuffled: only
matches, with some words around them, move on.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusflow.llm.common import staged

KINDS = ("email", "ip", "card", "phone")
CONFIDENCE, ROUNDS = 0.8, 3
#: Code points of context, and of the longest candidate.
BEFORE, BEHIND, LONGEST = 60, 40, 64

# The fixed patterns.  Starts within a run of their first characters fail where the run's start
# fails, so a match starts at a run or right behind the last match: long runs take one try.
_PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    # runs without white space, and number groups behind, of six digits or with an @
    "candidate": r"(?<![^\x20\x09-\x0D])"
                 r"(?=[^\x20\x09-\x0D0-9]*+[0-9](?:(?:[^\x20\x09-\x0D0-9]|\x20(?=[(+]?[0-9]))*+[0-9]){5}|[^\x20\x09-\x0D@]*+@)[^\x20\x09-\x0D]++"
                 r"(?:\x20[(+]?+[0-9][0-9()./+-]*+(?![^\x20\x09-\x0D]))*+(?:\x20[(+]?+[0-9][0-9()./+-]*+[^\x20\x09-\x0D0-9A-Za-z]++(?![^\x20\x09-\x0D]))?+",
}
_NEEDS = {"email": "@", "ip": ".", "phone": "+"}
#: What a candidate of each kind looks like.
_SHAPES = {
    "email": r"^[^@]+@[^@]+$",
    "ip": r"^[0-9A-Fa-f]*(?:[:.][0-9A-Fa-f]*){2,}$",
    "card": r"^[0-9](?:[\x20-]?[0-9]){11,18}$",
    "phone": r"^[+(]?[0-9](?:[\x20()./-]*[0-9]){5,14}$",
}
_BYTE = "(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]?[0-9])"


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Is the checksum of a string of digits right?"""
    own = F.transform(F.split(F.reverse(digits), ""),
                      lambda c, i: F.when(i % 2 == 1, F.translate(c, "0123456789", "0246813579")).otherwise(c).cast("int"))
    return F.aggregate(own, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    size = F.length(_digits(value))
    return (F.when(kind == "ip", value.rlike(rf"^0*{_BYTE}(?:\.0*{_BYTE}){{3}}$"))
            .when(kind == "card", F.when(size.between(12, 19), luhn(_digits(value))).otherwise(False))
            .when(kind == "phone", size.between(9, 15)).otherwise(True))


def _scan(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(row, doc_id, found): every document's matches of all patterns, in order per kind, with the length of the gap before."""
    text = F.col("text")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    none = F.array().cast("array<string>")

    def hits(kind: str) -> Column:
        found = F.regexp_extract_all(text, F.lit(_PATTERNS[kind]), F.lit(0))
        return F.when(F.contains(text, F.lit(_NEEDS[kind])), found).otherwise(none) if kind in _NEEDS else found

    # an exploded single value is worked out once, however often it is used afterwards
    rows = rows.select("row", "doc_id", "text", F.explode(F.array(F.struct(*[hits(k).alias(k) for k in _PATTERNS]))).alias("hits"))
    both = [F.when(F.size(F.col("hits")[k]) > 0, F.struct(F.col("hits")[k].alias("hits"), F.split(text, p).alias("gaps"))).alias(k)
            for k, p in _PATTERNS.items()]
    rows = rows.select("row", "doc_id", F.explode(F.array(F.struct(*both))).alias("found"))

    def matches(kind: str) -> Column:
        hits, gaps = F.col("found")[kind]["hits"], F.col("found")[kind]["gaps"]
        n = F.size(hits)
        zipped = F.arrays_zip(hits.alias("hit"), F.slice(gaps, F.lit(1), n).alias("before"), F.slice(gaps, F.lit(2), n).alias("behind"))
        each = F.transform(zipped, lambda x, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("place"), x["hit"].alias("value"), F.length(x["before"]).cast("long").alias("gap"),
            F.right(x["before"], F.lit(BEFORE)).alias("before"), F.left(x["behind"], F.lit(BEHIND)).alias("behind")))
        return F.when(F.col("found")[kind].isNotNull(), each)

    return rows.select("row", "doc_id", F.flatten(F.array_compact(F.array(*[matches(k) for k in _PATTERNS]))).alias("found"))


def _spans(scanned: DataFrame) -> DataFrame:
    """(row, kind, start, end, value, before, behind) of all valid matches, and of the candidates beside them."""
    each = scanned.select("row", F.explode("found").alias("f")).select("row", "f.*")
    size = F.length("value").cast("long")
    end = F.sum(F.col("gap") + size).over(Window.partitionBy("row", "kind").orderBy("place"))
    each = each.withColumn("end", end).withColumn("start", F.col("end") - size).filter(_valid(F.col("kind"), F.col("value")))
    # a candidate begins behind its label, brackets and quotes, and ends before closing marks
    label = F.regexp_extract("value", r"^(?:[^0-9@:=]{1,30}[:=])?(?:[\"'\[{<]|\((?![0-9]+\)))*", 0)
    body = F.substr("value", F.length(label) + 1)
    body = F.regexp_replace(body, r"[^0-9A-Za-z]+$", "")
    own = F.col("kind") == "candidate"
    each = each.withColumn("label", F.when(own, label).otherwise("")).withColumn("body", F.when(own, body).otherwise(F.col("value")))
    each = each.select("row", "kind", (F.col("start") + F.length("label")).alias("start"),
                       (F.col("start") + F.length("label") + F.length("body")).alias("end"), F.col("body").alias("value"),
                       F.concat("before", "label").alias("before"), "behind")
    each = each.filter(~own | F.length("value").between(1, LONGEST))
    # candidates that overlap a match of a fixed pattern go
    base = ~own
    row, second = Window.partitionBy("row"), F.when(base, 0).otherwise(1)
    before = F.max(F.when(base, F.col("end"))).over(row.orderBy("start", second).rowsBetween(Window.unboundedPreceding, -1))
    behind = F.min(F.when(base, F.col("start"))).over(row.orderBy(F.desc("start"), F.desc(second)).rowsBetween(Window.unboundedPreceding, -1))
    return each.withColumn("last", before).withColumn("next", behind) \
        .filter(base | ((F.coalesce("last", F.lit(0)) <= F.col("start")) & (F.coalesce("next", F.col("end")) >= F.col("end")))) \
        .drop("last", "next")


def _words(line: Column) -> Column:
    return F.filter(F.split(F.regexp_replace(F.lower(line), "[0-9]", "0"), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def lexical_patterns(before: Column, behind: Column) -> Column:
    """The last word before a slot, the last two, and the words on both sides; of the same line, in lower case, digits as 0."""
    own = _words(F.regexp_extract(before, r"[^\n\r]*\z", 0))
    after = F.coalesce(F.get(_words(F.regexp_extract(behind, r"^[^\n\r]*", 0)), 0), F.lit("$"))
    last = F.coalesce(F.try_element_at(own, F.lit(-1)), F.lit("^"))
    other = F.coalesce(F.try_element_at(own, F.lit(-2)), F.lit("^"))
    return F.array(F.concat_ws(" ", F.lit("1"), last), F.concat_ws(" ", F.lit("2"), other, last), F.concat_ws(" ", F.lit("b"), last, after))


def _score(edges: DataFrame) -> DataFrame:
    """(filler, kind, score) of known and found fillers, from the edges (pattern, filler, kind, seed)."""
    edges = staged(edges.groupBy("pattern", "filler", "kind").agg(F.max("seed").alias("seed")), "pii-edges")
    # by the smoothing, no pattern of fewer fillers can reach the confidence
    least = int(CONFIDENCE / (1 - CONFIDENCE) + 1e-9)
    totals = edges.groupBy("pattern", "filler").agg(F.lit(1).alias("one")).groupBy("pattern").agg(F.count("one").alias("fillers")) \
        .filter(F.col("fillers") >= least)
    seeds = staged(edges.filter("seed").select("filler", "kind").distinct().withColumn("score", F.lit(1.0)), "pii-seeds")
    graph = staged(edges.join(totals, "pattern"), "pii-graph")
    known = seeds
    for _ in range(ROUNDS):
        patterns = graph.join(known, ["filler", "kind"]).groupBy("pattern", "kind", "fillers").agg(F.sum("score").alias("sum")) \
            .select("pattern", "kind", F.round(F.col("sum") / (F.col("fillers") + 1), 9).alias("confidence")) \
            .filter(F.col("confidence") >= CONFIDENCE)
        found = graph.filter(~F.col("seed")).join(patterns, ["pattern", "kind"]).groupBy("filler", "kind") \
            .agg(F.round(1 - F.exp(F.sum(F.log1p(-F.col("confidence")))), 9).alias("score")).join(seeds, ["filler", "kind"], "left_anti")
        known = staged(seeds.unionByName(found), "pii-known")
    return known


def personal_data(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, n_email, n_ip, n_card, n_phone, n_found, base, spans``.

    ``base`` and ``spans`` list the spans of the fixed patterns and all spans, as
    ``kind:start:end`` in code points (end exclusive), by start, then in the order of KINDS,
    joined by commas.  Found identifiers have the kinds ``found_email`` and so on; they overlap
    no span of a fixed pattern and have at most LONGEST code points.  A candidate that differs
    from a match of a fixed pattern of its kind only in marks is one as well.

    Defined cases: a null or empty text has none; rows with a null id and repeated rows are
    scanned like any others; an empty table gives no rows; other columns are ignored.
    """
    scanned = staged(_scan(docs, id_col, text_col), "pii-scan")
    spans = staged(_spans(scanned), "pii-spans")
    own = F.col("kind") != "candidate"
    shapes = [F.when(F.col("value").rlike(p), F.lit(k)) for k, p in _SHAPES.items()]
    fillers = spans.withColumn("kinds", F.when(own, F.array("kind")).otherwise(F.array_compact(F.array(*shapes)))) \
        .withColumn("filler", F.regexp_replace(F.lower("value"), "[^a-z0-9@]", "")) \
        .select("row", "start", "end", (~own).alias("open"), "filler", lexical_patterns(F.col("before"), F.col("behind")).alias("patterns"),
                # a string that is like no kind still fills its slot
                F.explode(F.when(F.size("kinds") > 0, F.col("kinds")).otherwise(F.array(F.lit("other")))).alias("kind"))
    edges = fillers.select(F.explode("patterns").alias("pattern"), "filler", "kind", (~F.col("open")).alias("seed"))
    known = _score(edges).filter(F.col("score") >= CONFIDENCE)
    rank = reduce(lambda c, k: c.when(F.col("kind") == k, KINDS.index(k)), KINDS[1:], F.when(F.col("kind") == KINDS[0], 0))
    found = fillers.filter("open").join(known, ["filler", "kind"]).groupBy("row", "start", "end") \
        .agg(F.max(F.struct("score", (-rank).alias("order"), "kind"))["kind"].alias("kind")) \
        .select("row", F.struct("start", F.lit(len(KINDS)).alias("rank"), F.concat(F.lit("found_"), "kind").alias("kind"), "end").alias("span"))
    every = spans.filter(own).select("row", F.struct("start", rank.alias("rank"), "kind", "end").alias("span")).unionByName(found)

    def said(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    per_row = every.groupBy("row").agg(F.array_sort(F.collect_list("span")).alias("own"))
    out = scanned.select("row", "doc_id").join(per_row, "row", "left").withColumn("own", F.coalesce("own", F.array().cast(per_row.schema["own"].dataType)))

    def count(rank: int) -> Column:
        return F.size(F.filter("own", lambda s: s["rank"] == rank)).cast("long")

    counts = [count(i).alias(f"n_{k}") for i, k in enumerate((*KINDS, "found"))]
    return out.select("doc_id", *counts, said(F.filter("own", lambda s: s["rank"] < len(KINDS))).alias("base"), said(F.col("own")).alias("spans"))
