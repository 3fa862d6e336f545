"""Secret scanning with corpus-wide ownership, in DataFrame expressions only.

Candidates are found by pattern in every text. Their values, hashed, are then
counted over the corpus: a value that many owners or many repositories hold is a
copied example; one that stays with few of both looks like a live credential.
Base spans are always reported; the count adds further spans (kind ``blob``: long
mixed strings that no keyword announces) only where the value is owner-specific.

Functions give the matches of a pattern, but no offsets. The text between the
matches has the missing lengths: each match becomes a row, and a running sum over
a text's rows gives the starts. All work is linear in the number of matches, but
for sorting them within a text.

Defined results
    null text            the empty text: no spans
    null owner or repo   counts as one owner or repository of its own
    repeated rows        each row is scanned on its own; they count once per owner
    empty table          no rows
    very long texts      patterns run over the whole text; its matches meet in one task, as many as it has
    ties                 spans that start together are in the order of their kinds
    extra columns        ignored
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrane.llm.common import stage

#: The patterns of the base kinds, in the order of the kinds. Letters of the
#: keywords stand in classes, so that only ASCII case is folded.
ASSIGN = (
    r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
#: A run of 24 or more characters of the usual encodings; lower, upper and digit must all occur.
BLOB = r"[A-Za-z0-9+/_-]{24,}"
KINDS = ("assign", "access", "hex", "blob")


def _matches(text: Column, pattern: str, rank: int, value_group: int = 0, keep=None) -> Column:
    """Leftmost, non-overlapping matches: ``rank, gap`` (characters since the match before), ``len``, ``hash`` of the value, ``ok``.

    Values go no further than this. Matches that ``keep`` refuses stay for their lengths' sake."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(value_group))
    zipped = F.slice(F.arrays_zip(F.split(text, pattern, -1).alias("gap"), found.alias("m"), value.alias("v")), F.lit(1), F.size(found))
    ok = keep or (lambda v: F.lit(True))
    one = lambda z: F.struct(
        F.lit(rank).alias("rank"), F.length(z["gap"]).alias("gap"), F.length(z["m"]).alias("len"), F.sha2(z["v"], 256).alias("hash"), ok(z["v"]).alias("ok")
    )
    return F.when(text.rlike(pattern), F.transform(zipped, one)).otherwise(F.array().cast("array<struct<rank:int,gap:int,len:int,hash:string,ok:boolean>>"))


def all_matches(text: Column) -> Column:
    """One array for each kind."""
    text = F.coalesce(text, F.lit(""))
    mixed = lambda v: v.rlike("[a-z]") & v.rlike("[A-Z]") & v.rlike("[0-9]")
    return F.array(
        _matches(text, ASSIGN, 0, 2, lambda v: F.length(v) >= 8),
        _matches(text, ACCESS, 1),
        _matches(text, HEX, 2),
        _matches(text, BLOB, 3, 0, mixed),
    )


def spans_of(found: DataFrame) -> DataFrame:
    """``_rid, start, rank, kind, end, hash`` of the spans; from rows ``_rid, _matches``. Blobs that overlap a base span are left out."""
    rows = found.select("_rid", F.explode("_matches").alias("_of_kind")).select("_rid", F.posexplode("_of_kind").alias("_k", "m")).select("_rid", "_k", "m.*")
    line = Window.partitionBy("_rid", "rank").orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("end", F.sum(F.col("gap") + F.col("len")).over(line).cast("int")).where("ok")
    placed = placed.select("_rid", (F.col("end") - F.col("len")).alias("start"), "rank", F.get(F.array(*map(F.lit, KINDS)), F.col("rank")).alias("kind"), "end", "hash")
    # A blob meets a base span that begins before or with it and ends in it or after, or one that begins in it.
    up_to = lambda order: Window.partitionBy("_rid").orderBy(order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    base_end, base_start = F.when(F.col("rank") < 3, F.col("end")), F.when(F.col("rank") < 3, F.col("start"))
    before = F.max(base_end).over(up_to(F.asc("start")))
    after = F.min(base_start).over(up_to(F.desc("start")))
    clear = (F.coalesce(before, F.lit(0)) <= F.col("start")) & (F.coalesce(after, F.col("end")) >= F.col("end"))
    return placed.withColumn("_clear", clear).where("rank < 3 OR _clear").drop("_clear")


def render(spans: str | Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(spans: str | Column) -> Column:
    return F.sha2(render(spans), 256)


def ownership(candidates: DataFrame) -> DataFrame:
    """``hash, n_owners, n_repos`` of candidates ``hash, owner, repo``.

    Both steps sum before they shuffle, so a value that holds a third of all
    candidates still reaches each reducer as one row per task.
    """
    per_owner = candidates.groupBy("hash", "owner", "repo").agg(F.count(F.lit(1)).alias("n")).groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("repos"))
    return per_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"))


def scan_secrets(
    docs: DataFrame,
    owner_col: str,
    repo_col: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_owners: int = 2,
    max_repos: int = 4,
) -> DataFrame:
    """One row per document: base counts, ``base_spans``, ``spans`` (base and added), ``n_live`` and ``n_example``.

    A value held by more than ``max_owners`` owners, or in more than ``max_repos`` repositories, is a copied example.
    """
    found = docs.select(
        F.monotonically_increasing_id().alias("_rid"),
        F.col(id_col).alias("_id"),
        F.coalesce(F.col(owner_col).cast("string"), F.lit("\0")).alias("_owner"),
        F.coalesce(F.col(repo_col).cast("string"), F.lit("\0")).alias("_repo"),
        all_matches(F.col(text_col)).alias("_matches"),
    )
    found = stage(found, "secrets")
    some = found.where(F.exists("_matches", lambda m: F.size(m) > 0))
    spans = stage(spans_of(some.select("_rid", "_matches")).join(some.select("_rid", "_owner", "_repo"), "_rid"), "secret-spans")
    owners = ownership(spans.select("hash", F.col("_owner").alias("owner"), F.col("_repo").alias("repo")))
    # Written first: a join of two plain shuffles can be split where one value holds very many candidates.
    owners = stage(owners, "owners")
    live = (F.col("n_owners") <= max_owners) & (F.col("n_repos") <= max_repos)
    span = F.struct("start", "rank", "kind", "end", "hash")
    count = lambda rank: F.count_if(F.col("rank") == rank)
    judged = (
        spans.join(owners, "hash")
        .groupBy("_rid")
        .agg(
            *(count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:3])),
            F.sort_array(F.collect_list(F.when(F.col("rank") < 3, span))).alias("base_spans"),
            F.sort_array(F.collect_list(F.when((F.col("rank") < 3) | live, span))).alias("spans"),
            F.count_if(live).alias("n_live"),
            F.count_if(~live).alias("n_example"),
        )
    )
    none = F.array().cast("array<struct<start:int,rank:int,kind:string,end:int,hash:string>>")
    long_ = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return found.select("_rid", "_id").join(judged, "_rid", "left").select(
        F.col("_id").alias(id_col),
        *(long_(f"n_{k}") for k in KINDS[:3]),
        *(F.coalesce(c, none).alias(c) for c in ("base_spans", "spans")),
        long_("n_live"),
        long_("n_example"),
    )
