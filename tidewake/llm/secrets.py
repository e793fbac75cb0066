"""Secret scan by corpus-wide ownership frequency, in DataFrame functions only.

Candidates are found by pattern, hashed by value, and counted over the corpus by distinct owners and
repositories. A value that many owners have, or that lies in many repositories, is a copied example; one
that few owners have in few repositories looks live.
Live-looking values outside the patterned kinds are added to the spans; the patterned ones stay.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewake.session import stage

# The kinds in order, their patterns and least lengths. Runs of a minimum length are the
# same runs as those of any length that reach it, so the minimum stands in the pattern where it can.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_HINT = r"(?i:password|passwd|secret|token|api_?key)"
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
MIXED = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "live")
MIN_ASSIGNED = 12


def _found(text: Column, kind: int, pattern: str, hint: str) -> Column:
    """Matches of a pattern with the length of the text between each and the one before."""
    between = F.transform(F.split(text, pattern, -1), F.length)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(between, matches, lambda gap, m: F.struct(gap.alias("gap"), m.alias("match")))
    rows = F.transform(
        F.filter(pairs, lambda p: p["match"].isNotNull()),
        lambda p, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), p["gap"].alias("gap"), p["match"].alias("match")),
    )
    none = F.array().cast("array<struct<kind:int,place:int,gap:int,match:string>>")
    return F.when(text.rlike(hint), rows).otherwise(none)


def candidates(docs: DataFrame, owner_col: str, repository_col: str, id_col: str, text_col: str) -> DataFrame:
    """One row per candidate, at least one per document: row, doc_id, owner, kind, start, end, value's hash.

    The text does not leave the scan: only lengths and matches are exploded, and the offsets are running
    sums over the matches of one document and kind.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    found = F.concat(
        _found(text, 0, ASSIGN, ASSIGN_HINT),
        _found(text, 1, ACCESS, "AKIA"),
        _found(text, 2, HEX, HEX),
        _found(text, 3, MIXED, MIXED),
    )
    rows = (
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.col(owner_col).cast("string").alias("owner"),
            F.col(repository_col).cast("string").alias("repository"),
            F.col(text_col).cast("string").alias("text"),
        )
        .withColumn("row", F.monotonically_increasing_id())
        .select("row", "doc_id", "owner", "repository", F.explode_outer(found).alias("f"))
        .select("row", "doc_id", "owner", "repository", "f.*")
    )
    size = F.length("match")
    before = Window.partitionBy("row", "kind").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("gap") + F.coalesce(F.sum(F.col("gap") + size).over(before), F.lit(0))
    value = F.when(F.col("kind") == 0, F.regexp_extract("match", ASSIGN, 2)).otherwise(F.col("match"))
    fits = (
        F.when(F.col("kind") == 0, F.length("value") >= MIN_ASSIGNED)
        .when(F.col("kind") == 3, F.col("value").rlike(r"(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])"))
        .otherwise(F.lit(True))
    )
    rows = rows.select("row", "doc_id", "owner", "repository", "kind", start.alias("start"), size.alias("size"), value.alias("value"))
    # A match that does not fit stays as an empty row, so that its document keeps one.
    rows = rows.withColumn("fits", F.col("kind").isNotNull() & fits)
    return rows.select(
        "row",
        "doc_id",
        "owner",
        "repository",
        F.when(F.col("fits"), F.col("kind")).alias("kind"),
        F.col("start").cast("long").alias("start"),
        (F.col("start") + F.col("size")).cast("long").alias("end"),
        F.when(F.col("fits"), F.xxhash64("value")).alias("hash"),
    )


def ownership(found: DataFrame) -> DataFrame:
    """Distinct owners and repositories of each candidate hash; null owners count as one.

    Owner and repository are reduced one after the other, each with a partial aggregate before its
    shuffle, so that a value copied everywhere is a few rows per task.
    """
    per_owner = (
        found.filter(F.col("hash").isNotNull())
        .groupBy("hash", "owner", "repository")
        .agg(F.lit(1).alias("one"))
        .groupBy("hash", "owner")
        .agg(F.count(F.lit(1)).alias("repositories"))
    )
    return per_owner.groupBy("hash").agg(
        F.count(F.lit(1)).alias("owners"), F.sum("repositories").alias("repositories")
    )


def scan_secrets(
    docs: DataFrame,
    max_owners: int = 2,
    max_repositories: int = 5,
    owner_col: str = "source",
    repository_col: str = "doc_id",
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Secrets of every text: counts per patterned kind, their spans' digest, all spans, and live-looking ones.

    A value with at most ``max_owners`` distinct owners and ``max_repositories`` distinct repositories in
    the corpus is live-looking (``n_live``), any other a copied example (``n_example``). A mixed-character value that is live-looking and meets no
    patterned span becomes a span of kind ``live``. Offsets are code points, the end exclusive. A null
    or empty text has no spans; a null id or owner is kept as null; repeated rows give a row each, and
    count once per owner and repository; other columns are not read; an empty table gives no rows.
    """
    found = stage(candidates(docs, owner_col, repository_col, id_col, text_col), "secret-candidates")
    # Rows without a candidate only keep their document; they have nothing to look up.
    candidate = F.col("hash").isNotNull()
    judged = found.filter(candidate).join(ownership(found), "hash")
    judged = judged.unionByName(found.filter(~candidate), allowMissingColumns=True)
    live = (F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)
    base_end = F.when(F.col("kind") < 3, F.col("end"))
    base_start = F.when(F.col("kind") < 3, F.col("start"))
    order = Window.partitionBy("row").orderBy("start", "kind")
    ended = F.max(base_end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    follows = F.min(base_start).over(order.rowsBetween(1, Window.unboundedFollowing))
    alone = F.coalesce(ended <= F.col("start"), F.lit(True)) & F.coalesce(follows >= F.col("end"), F.lit(True))
    shown = (F.col("kind") < 3) | ((F.col("kind") == 3) & live & alone)
    names = F.array(*[F.lit(k) for k in KINDS])
    label = F.concat_ws(":", F.get(names, F.col("kind")), F.col("start"), F.col("end"))
    entry = F.struct("start", "kind", label.alias("label"))

    def joined(which: Column) -> Column:
        entries = F.array_sort(F.collect_list(F.when(which, entry)))
        return F.concat_ws(",", F.transform(entries, lambda e: e["label"]))

    return (
        judged.withColumn("shown", F.coalesce(shown, F.lit(False)))
        .groupBy("row")
        .agg(
            F.first("doc_id").alias("doc_id"),
            *[F.count_if(F.col("kind") == i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])],
            F.sha2(joined(F.col("kind") < 3), 256).alias("base_sha256"),
            joined(F.col("shown")).alias("spans"),
            F.count_if(F.col("shown") & live).alias("n_live"),
            F.count_if(F.col("shown") & ~live).alias("n_example"),
        )
        .drop("row")
    )
