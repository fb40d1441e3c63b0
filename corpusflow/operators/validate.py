"""Corpus checks (P18, A3-A5, J5, V3-V7) over FILE rows
``(name, length, file_id, kind)``.

All checks are aggregates or joins: nothing is collected except the single
maximum id that sizes the id range of ``missing_ids``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.functions.paths import article_id_from_name, corpus_file_kind

# --- fixed values -----------------------------------------------------------
# Rule order of the corpus check: the first violation in this order is the
# one raised.
RULE_ORDER = ["V3_empty_file", "V4_empty_directory", "V5_no_raw_files", "V5_no_meta_files",
              "V6_unequal_counts", "V7_raw_id_gaps", "V7_meta_id_gaps"]
# ---------------------------------------------------------------------------


def file_rows(listing: DataFrame, name_col: str = "name", length_col: str = "length") -> DataFrame:
    """FILE rows from a listing: recognised kind (null if not a corpus file) and id."""
    n = F.col(name_col)
    return listing.select(n.alias("name"), F.col(length_col).cast("bigint").alias("length"),
                          article_id_from_name(n).alias("file_id"), corpus_file_kind(n).alias("kind"))


def files_by_kind(files: DataFrame) -> DataFrame:
    """A3: count of recognised files per kind."""
    return files.filter(F.col("kind").isNotNull()).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n_files"))


def id_stats(files: DataFrame) -> DataFrame:
    """A4: per kind: count, distinct ids, min, max, and whether ids are exactly 1..N."""
    g = files.filter(F.col("kind").isNotNull()).groupBy("kind").agg(
        F.count(F.lit(1)).alias("n"), F.countDistinct("file_id").alias("n_distinct"),
        F.min("file_id").alias("min_id"), F.max("file_id").alias("max_id"))
    exact = (F.col("n") == F.col("max_id")) & (F.col("n_distinct") == F.col("n")) & (F.col("min_id") == 1)
    return g.withColumn("has_gaps", ~exact)


def missing_ids(ids: DataFrame, id_col: str = "file_id") -> DataFrame:
    """A5: every id in 1..max(id) that is absent.

    The id range is a distributed ``spark.range``; only the maximum (one
    number) goes through the driver.
    """
    spark = ids.sparkSession
    mx = ids.agg(F.max(id_col)).first()[0]
    if mx is None or mx < 1:
        return spark.range(0).select(F.col("id").alias("missing_id"))
    want = spark.range(1, int(mx) + 1).select(F.col("id").alias("missing_id"))
    have = ids.select(F.col(id_col).alias("missing_id")).distinct()
    return want.join(have, on="missing_id", how="left_anti")


def raw_meta_balance(files: DataFrame) -> DataFrame:
    """Ids that have a raw file but no meta file or the reverse."""
    raw = files.filter(F.col("kind") == "raw").select(F.col("file_id").alias("article_id")).distinct() \
        .withColumn("has_raw", F.lit(True))
    meta = files.filter(F.col("kind") == "meta").select(F.col("file_id").alias("article_id")).distinct() \
        .withColumn("has_meta", F.lit(True))
    j = raw.join(meta, on="article_id", how="full_outer")
    return j.select("article_id", F.coalesce("has_raw", F.lit(False)).alias("has_raw"),
                    F.coalesce("has_meta", F.lit(False)).alias("has_meta")).filter(
        ~(F.col("has_raw") & F.col("has_meta")))


def validate_corpus(files: DataFrame) -> DataFrame:
    """V3-V7: every violation as ``(rule, kind, detail)``.

    One global aggregate (partial per task) gives the counts; empty files are
    listed one row each.
    """
    rec = files.filter(F.col("kind").isNotNull())
    empty = rec.filter(F.col("length") == 0).select(
        F.lit("V3_empty_file").alias("rule"), "kind", F.col("name").alias("detail"))

    def cnt(kind):
        return F.count_if(F.col("kind") == kind)

    def stat(fn, kind):
        return fn(F.when(F.col("kind") == kind, F.col("file_id")))

    agg = rec.agg(
        F.count(F.lit(1)).alias("n_all"), cnt("raw").alias("n_raw"), cnt("meta").alias("n_meta"),
        stat(F.max, "raw").alias("max_raw"), stat(F.max, "meta").alias("max_meta"),
        stat(F.min, "raw").alias("min_raw"), stat(F.min, "meta").alias("min_meta"),
        F.count_distinct(F.when(F.col("kind") == "raw", F.col("file_id"))).alias("d_raw"),
        F.count_distinct(F.when(F.col("kind") == "meta", F.col("file_id"))).alias("d_meta"))

    def gaps(n, d, mn, mx):
        return (F.col(n) > 0) & ~((F.col(mx) == F.col(n)) & (F.col(d) == F.col(n)) & (F.col(mn) == 1))

    def check(rule, kind, detail, bad):
        return F.struct(F.lit(rule).alias("rule"), F.lit(kind).cast("string").alias("kind"),
                        detail.alias("detail"), bad.alias("bad"))

    def id_detail(n, mx):
        return F.concat(F.lit("n="), F.col(n).cast("string"), F.lit(" max="),
                        F.coalesce(F.col(mx).cast("string"), F.lit("")))

    checks = F.array(
        check("V4_empty_directory", None, F.lit("no corpus files"), F.col("n_all") == 0),
        check("V5_no_raw_files", "raw", F.lit("no raw files"),
              (F.col("n_all") > 0) & (F.col("n_raw") == 0)),
        check("V5_no_meta_files", "meta", F.lit("no meta files"),
              (F.col("n_all") > 0) & (F.col("n_meta") == 0)),
        check("V6_unequal_counts", None,
              F.concat(F.lit("raw="), F.col("n_raw").cast("string"), F.lit(" meta="),
                       F.col("n_meta").cast("string")),
              F.col("n_raw") != F.col("n_meta")),
        check("V7_raw_id_gaps", "raw", id_detail("n_raw", "max_raw"),
              gaps("n_raw", "d_raw", "min_raw", "max_raw")),
        check("V7_meta_id_gaps", "meta", id_detail("n_meta", "max_meta"),
              gaps("n_meta", "d_meta", "min_meta", "max_meta")),
    )
    summary = agg.select(F.explode(checks).alias("c")).filter(F.col("c.bad")).select(
        F.col("c.rule").alias("rule"), F.col("c.kind").alias("kind"), F.col("c.detail").alias("detail"))
    return empty.unionByName(summary)


def raise_on_violation(violations: DataFrame) -> None:
    """Raise ``ValueError`` for the first violation in rule order (driver-side
    check on an already-aggregated, tiny result)."""
    order = F.array_position(F.array(*[F.lit(r) for r in RULE_ORDER]), F.col("rule"))
    first = violations.orderBy(order, "detail").limit(1).collect()
    if first:
        r = first[0]
        kind = "EmptyDirectory" if r["rule"].startswith("V4") else "InconsistentDataset"
        raise ValueError(f"{kind}: {r['rule']} {r['detail']}")


def duplicate_ids(meta: DataFrame, id_col: str = "id") -> DataFrame:
    """A7 on metadata: ids that several records hold -> ``(id, n)`` (a partial count before the shuffle)."""
    return (meta.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
            .agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1))


def id_mismatches(meta: DataFrame) -> DataFrame:
    """Records whose file id (``article_id``, the key) is not the id written inside (``id``)."""
    return meta.filter(~F.col("article_id").eqNullSafe(F.col("id"))).select("article_id", "id")
