"""Exact dedup (native): combine locally, then per salted digest group, then over the salts, always by full content."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, without_spaces, write_table

SALTS = 16


def _keyed(docs: DataFrame, salts: int) -> DataFrame:
    base = docs.select("doc_id", F.char_length("text").alias("chars"), without_spaces(F.col("text")).alias("norm"))
    return base.select("doc_id", "chars", "norm", F.unhex(F.sha2("norm", 256)).alias("digest"), F.pmod(F.xxhash64("doc_id"), F.lit(salts)).cast("int").alias("salt"))


def _best() -> Column:
    """Of equal texts: most code points, then smallest id (null ids last)."""
    return F.max(F.struct(F.col("chars"), (-F.coalesce("doc_id", F.lit(2**63 - 1))).alias("neg"))).alias("best")


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if identical without white space (space, 0x09-0x0D). The row with the most code points, then the
    smallest id, stays. Null texts count as empty and are equal to each other; a row with a null id stays only if all
    ids of its group are null, and keep_id is then null. Repeated rows of one id share its verdict. An empty table
    gives no rows.

    1. Local: the map side of the first aggregate combines equal texts of one partition, before anything is shuffled.
    2. Salted: (digest, salt, full text) groups; a text that a third of the rows share is spread over `salts` tasks.
    3. Global: at most `salts` winners of each text meet by (digest, full text).
    The text itself is a grouping key in each, so two texts with one digest never merge. Rows then take their group by
    digest and the salts that it has, so a group of one row is one row of that join; digests that stand for more than one text (none known for SHA-256) take it by full text.
    """
    keyed = _keyed(id_and_text(docs, id_col, text_col), salts)
    salted = keyed.groupBy("digest", "salt", "norm").agg(_best(), F.count("*").alias("n"))
    whole = salted.groupBy("digest", "norm").agg(F.max("best").alias("best"), F.sum("n").alias("n"), F.collect_set("salt").alias("salts"))
    # A digest's texts, nearly always one: the text itself is carried on only by digests that stand for several.
    per_digest = whole.groupBy("digest").agg(F.count("*").alias("texts"), F.first("best").alias("best"), F.first("n").alias("n"), F.first("salts").alias("salts"))
    groups = write_table(per_digest, "exact-groups")
    ones = groups.where("texts = 1").select("digest", F.explode("salts").alias("salt"), "best", "n")
    rows = keyed.select("doc_id", "digest", "salt")
    found = rows.join(ones, ["digest", "salt"])
    if not groups.where("texts > 1").isEmpty():
        clash = groups.where("texts > 1").select("digest")
        several = whole.join(clash, "digest", "left_semi").select("digest", F.explode("salts").alias("salt"), "norm", "best", "n")
        more = keyed.join(several, ["digest", "salt", "norm"])
        found = found.select("doc_id", "digest", "best", "n").unionByName(more.select("doc_id", "digest", "best", "n"))
    keep = F.nullif(-F.col("best.neg"), F.lit(2**63 - 1))
    return found.select("doc_id", keep.alias("keep_id"), F.col("n").alias("group_size"), F.col("doc_id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256"))


def drop_exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = SALTS) -> DataFrame:
    """One row of docs for each text, with all its columns: that of exact_duplicates' choice, by the same two aggregates.

    The row itself is carried to the choice, so repeated ids and null ids leave one row too. Rows alike in code points
    and id are told apart by a hash of their columns.
    """
    plain = [docs[f.name] for f in docs.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"), F.xxhash64(*plain).alias("hash"), F.struct(*[docs[c] for c in docs.columns]).alias("row"))
    rank = F.struct(F.char_length("text").alias("chars"), (-F.coalesce("doc_id", F.lit(2**63 - 1))).alias("neg"), "hash")
    keyed = rows.select(without_spaces(F.col("text")).alias("norm"), rank.alias("rank"), F.pmod("hash", F.lit(salts)).cast("int").alias("salt"), "row")
    keyed = keyed.withColumn("digest", F.unhex(F.sha2("norm", 256)))
    salted = keyed.groupBy("digest", "salt", "norm").agg(F.max("rank").alias("rank"), F.max_by("row", "rank").alias("row"))
    return salted.groupBy("digest", "norm").agg(F.max_by("row", "rank").alias("row")).select("row.*")


ORACLE = r"""
with k as (select doc_id, length(coalesce(text, '')) chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') norm from documents),
g as (select norm, count(*) n, arg_min(doc_id, (-chars, doc_id)) keep_id from k group by norm)
select k.doc_id, g.keep_id, g.n group_size, k.doc_id = g.keep_id kept, sha256(k.norm) text_sha256 from k join g on k.norm = g.norm
"""
